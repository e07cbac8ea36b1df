"""Language identification: interpolated Kneser-Ney character models, one per language, in sorted hash arrays.

A text's words are its stretches of letters, lower-cased. A model predicts each letter of a word and the
word's end from the up to ``ORDER - 1`` symbols before it within the word; a pad stands for what lies before.

Fitting reads a bounded sample: texts are cut into blocks of ``BLOCK`` characters, and a block is taken
with the chance, by a hash of its id, number and text, that gives about ``blocks`` blocks for each language (all, where there
are fewer). Spark counts the sample's words by language; the driver makes the models from those counts, at most
``blocks * BLOCK`` characters a language. Highest orders count occurrences, lower ones the different symbols
that stand before (those that begin with a pad: occurrences). Every order has the discount n1 / (n1 + 2 n2) and
hands what it takes off to the order below, the lowest one to all symbols alike. Keys are 64-bit hashes of n-grams; per
order, one sorted array holds the keys of all languages, with a row of discounted shares each, and another the contexts with
what they hand down.

A text's language is that of the lowest cross-entropy per symbol, ties to the first in order of names. ``score`` is
the softmax of ``-heat * symbols ** 0.5 * entropy``, whose ``heat`` is fitted by maximum likelihood on blocks that
the models haven't seen, cut into pieces of several lengths. ``rejected`` says that the entropy is beyond what all but
``1 - keep`` of such pieces of its language and length have: text of no learned language.

Every row is scored by itself over its whole text, by the different words of many texts at once, so nothing is shuffled
and repeated rows score alike. A text that is null or has no letter is ``und`` with score 0 and no entropy, as is every
text where nothing was learned. Null languages are not learned from; the empty string is a language like any other. A null id
counts as empty where a fold is drawn. An empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderspan.llm.arrow import texts

ORDER = 5
BLOCK = 2_000
#: Blocks of each language that the models and the calibration are made from.
BLOCKS, CALIBRATION = 1_000, 300
#: Words of the texts that are scored at once.
WORDS = 300_000
#: Lengths, in characters, of the pieces that calibration scores; classes of symbols that share a threshold.
PIECES = (25, 100, 400, BLOCK)
CLASSES = np.array([40, 160, 640])

#: Alphanumeric characters but digits; what of them is no letter is taken out of the different words.
LETTERS = re.compile(r"[^\W\d_]+")
_ODD = np.array([int(xxhash.xxh3_64_intdigest(bytes([j]))) | 1 for j in range(ORDER + 1)], np.uint64)


def words_of(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The symbols that end each position's n-gram, newest first (``ORDER`` columns), and each word's first position."""
    pad = "\0" * (ORDER - 1)
    codes = np.frombuffer((pad + pad.join(words) + "\0").encode("utf-32-le", "surrogatepass"), "<u4")
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    first = np.concatenate([[0], np.cumsum(sizes + 1)])
    # A word's positions: its letters, and the pad after it.
    where = np.arange(first[-1]) + np.repeat(np.arange(len(words)) * (ORDER - 2) + ORDER - 1, sizes + 1)
    return np.stack([codes[where - j] for j in range(ORDER)], axis=1), first[:-1]


def keys(symbols: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n newest symbols."""
    out = np.full(len(symbols), int(_ODD[ORDER]) * n % 2**64, np.uint64)
    for j in range(n):
        out += symbols[:, j].astype(np.uint64) * _ODD[j]
    return (out ^ (out >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)


def kneser_ney(words: list[str], counts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """By order, from 1: n-gram keys and discounted shares, context keys and the share they hand down."""
    symbols, first = grams(words)
    occurs = np.repeat(counts, np.diff(np.concatenate([first, [len(symbols)]])))
    out = []
    for n in range(ORDER, 0, -1):
        # From the second turn on, ``symbols`` has each different (n + 1)-gram once.
        key, row, place = np.unique(keys(symbols, n), return_index=True, return_inverse=True)
        before, occurs, symbols = np.bincount(place), np.bincount(place, weights=occurs), symbols[row]
        padded = (symbols[:, n - 1] == 0) & (n > 1)
        count = np.where(padded | (n == ORDER), occurs, before)
        n1, n2 = (count == 1).sum(), (count == 2).sum()
        discount = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        context, of = np.unique(keys(symbols[:, 1:], n - 1), return_inverse=True)
        total, kinds = np.bincount(of, weights=count), np.bincount(of)
        out.append((key, (count - discount) / total[of], context, discount * kinds / total))
    return out[::-1]


def merged(parts: list[tuple[np.ndarray, np.ndarray]], empty: float) -> tuple[np.ndarray, np.ndarray]:
    """One sorted array of all keys, and a column for each part."""
    key = np.unique(np.concatenate([k for k, _ in parts]))
    table = np.full((len(key), len(parts)), empty, np.float32)
    for column, (k, value) in enumerate(parts):
        table[np.searchsorted(key, k), column] = value
    return key, table


def looked_up(table: tuple[np.ndarray, np.ndarray], key: np.ndarray, empty: float) -> np.ndarray:
    known, values = table
    at = np.minimum(np.searchsorted(known, key), len(known) - 1)
    return np.where((known[at] == key)[:, None], values[at], np.float32(empty))


@dataclass
class LanguageModels:
    """Models of all ``languages``; ``limits`` has a row of largest entropies for each, by class of length."""

    languages: list[str]
    orders: list[tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]]
    floor: float
    heat: float = 1.0
    limits: np.ndarray = field(default_factory=lambda: np.empty(0))

    @classmethod
    def fit(cls, counts: dict[str, dict[str, int]]) -> LanguageModels | None:
        """From the words of each language and their counts."""
        counts = {k: counts[k] for k in sorted(counts) if counts[k]}
        if not counts:
            return None
        single = [kneser_ney(list(c), np.fromiter(c.values(), np.int64, len(c))) for c in counts.values()]
        orders = [(merged([m[n][:2] for m in single], 0.0), merged([m[n][2:] for m in single], 1.0)) for n in range(ORDER)]
        # All symbols that any language has, and one for those that none has.
        return cls(list(counts), orders, 1 / (len(orders[0][0][0]) + 1))

    def bits(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits of each word in each language, and its symbols."""
        symbols, first = grams(words)
        _, row, place = np.unique(keys(symbols, ORDER), return_index=True, return_inverse=True)
        symbols = symbols[row]
        p = np.full((len(row), len(self.languages)), self.floor)
        for n in range(1, ORDER + 1):
            grams_, contexts = self.orders[n - 1]
            p = looked_up(grams_, keys(symbols, n), 0.0) + looked_up(contexts, keys(symbols[:, 1:], n - 1), 1.0) * p
        return np.add.reduceat(-np.log2(p)[place], first, axis=0), np.diff(np.concatenate([first, [len(place)]]))

    def entropies(self, words: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Bits per symbol of each text in each language (nan without a letter), and its symbols."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        flat = pa.array([w for text in words for w in text], pa.string()).dictionary_encode()
        different = ["".join(filter(str.isalpha, w)) if not w.isalpha() else w for w in flat.dictionary.to_pylist()]
        bits, symbols = np.zeros((len(different), len(self.languages))), np.zeros(len(different), np.int64)
        if real := [k for k, w in enumerate(different) if w]:
            bits[real], symbols[real] = self.bits([different[k] for k in real])
        code, text = flat.indices.to_numpy(zero_copy_only=False), np.repeat(np.arange(len(words)), sizes)
        total = np.stack([np.bincount(text, weights=column[code], minlength=len(words)) for column in bits.T], axis=1)
        n = np.bincount(text, weights=symbols[code], minlength=len(words)).astype(np.int64)
        return np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], np.nan), n

    def posterior(self, entropy: np.ndarray, n: np.ndarray, heat: float | None = None) -> np.ndarray:
        logit = -(self.heat if heat is None else heat) * np.sqrt(n)[:, None] * entropy
        p = np.exp(logit - logit.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    def calibrate(self, blocks: list[tuple[str, str]], keep: float = 0.999) -> LanguageModels:
        """``heat`` and ``limits`` from texts with their languages."""
        place = {x: k for k, x in enumerate(self.languages)}
        cut = [(t[a : a + size], place[lang]) for t, lang in sorted(blocks) if lang in place for size in PIECES for a in range(0, min(len(t), 4 * size), size)]
        entropy, n = self.entropies([words_of(t) for t, _ in cut])
        true = np.array([k for _, k in cut], np.int64)
        real = n > 0
        entropy, n, true = entropy[real], n[real], true[real]
        self.limits = np.full((len(self.languages), len(CLASSES) + 1), np.inf)
        if not len(n):
            return self
        heats = np.geomspace(0.05, 20, 61)
        fit = [np.log(np.maximum(self.posterior(entropy, n, h)[np.arange(len(n)), true], 1e-12)).mean() for h in heats]
        self.heat = float(heats[int(np.argmax(fit))])
        group = np.searchsorted(CLASSES, n, side="right")
        for k in range(len(self.languages)):
            for c in range(len(CLASSES) + 1):
                own = entropy[(true == k) & (group == c), k]
                if len(own):
                    # A margin for what so few pieces do not show.
                    self.limits[k, c] = np.quantile(own, keep) + 3 * own.std() / np.sqrt(len(own)) + 0.1
        return self

    def judge(self, words: list[list[str]]) -> dict[str, list]:
        """Language, score, entropy and rejection of each text."""
        entropy, n = self.entropies(words)
        safe = np.nan_to_num(entropy, nan=1.0)
        best = safe.argmin(axis=1)
        row = np.arange(len(best))
        score = self.posterior(safe, n)[row, best]
        limit = self.limits[best, np.searchsorted(CLASSES, n, side="right")] if self.limits.size else np.full(len(best), np.inf)
        return {
            "lang_pred": [self.languages[k] if m else "und" for k, m in zip(best.tolist(), n.tolist())],
            "score": np.where(n > 0, score, 0.0).tolist(),
            "entropy": [h if m else None for h, m in zip(safe[row, best].tolist(), n.tolist())],
            "rejected": ((n == 0) | (safe[row, best] > limit)).tolist(),
        }


def fold(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 4 (null: as empty)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 4


def held_out(id_col: Column) -> Column:
    """Rows that training never reads."""
    return fold(id_col) == 2


def sampled(known: DataFrame, blocks: int) -> DataFrame:
    """``lang`` and ``block`` text of about ``blocks`` blocks of each language of ``known`` (doc_id, text, lang)."""
    counts = known.groupBy("lang").agg(F.sum(F.ceil(F.length("text") / BLOCK)).alias("n")).where("n > 0").collect()  # one row a language
    rate = {r["lang"]: int(min(1.0, blocks / r["n"]) * 2**64) for r in counts}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[str, str]] = []
            for doc_id, text, lang in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "lang"))):
                for k, at in enumerate(range(0, len(text), BLOCK)):
                    block = text[at : at + BLOCK]
                    if xxhash.xxh3_64_intdigest(f"{doc_id} {k} {block}".encode()) < rate.get(lang, 0):
                        out.append((lang, block))
            yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in out], pa.string()) for j in (0, 1)], ["lang", "block"])

    return known.mapInArrow(work, "lang string, block string")


def word_counts(blocks: DataFrame) -> DataFrame:
    """``lang, word, n`` of the words of ``blocks``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for lang, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found.update((lang, w) for w in words_of(block))
        rows = list(found)
        columns = [pa.array([lang for lang, _ in rows], pa.string()), pa.array([w for _, w in rows], pa.string()), pa.array(found.values(), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "n"])

    return blocks.mapInArrow(work, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, blocks: int = BLOCKS, calibration: int = CALIBRATION, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModels | None:
    """Models of the languages of ``docs``; None where no row has a language and a letter. Fold 2 is not read; fold 3 calibrates."""
    known = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    counts: dict[str, dict[str, int]] = {}
    # The sample's words: at most `blocks` blocks a language.
    for lang, word, n in zip(*(c.to_pylist() for c in word_counts(sampled(known.where(fold(F.col("doc_id")).isin(0, 1)), blocks)).toArrow().columns)):
        if word := "".join(filter(str.isalpha, word)):
            own = counts.setdefault(lang, {})
            own[word] = own.get(word, 0) + n
    models = LanguageModels.fit({lang: dict(sorted(own.items())) for lang, own in counts.items()})
    if models is None:
        return None
    return models.calibrate([(r["block"], r["lang"]) for r in sampled(known.where(fold(F.col("doc_id")) == 3), calibration).collect()])


def language_id(docs: DataFrame, models: LanguageModels | None, reject: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, entropy, rejected`` of each row; with ``reject``, a rejected text is ``und``."""
    wanted = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(models)  # languages * blocks * BLOCK characters' n-grams at most

    def judged(ids: list, words: list[list[str]]) -> pa.RecordBatch:
        if shared.value is None:
            out = {"lang_pred": ["und"] * len(ids), "score": [0.0] * len(ids), "entropy": [None] * len(ids), "rejected": [True] * len(ids)}
        else:
            out = shared.value.judge(words)
        kinds = (pa.string(), pa.float64(), pa.float64(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(v, k) for v, k in zip(out.values(), kinds))], ["doc_id", *out])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, words, total = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
                ids.append(doc_id)
                words.append(words_of(text))
                total += len(words[-1])
                if total >= WORDS:
                    yield judged(ids, words)
                    ids, words, total = [], [], 0
        if ids:
            yield judged(ids, words)

    found = wanted.mapInArrow(work, "doc_id long, lang_pred string, score double, entropy double, rejected boolean")
    return found.withColumn("lang_pred", F.expr("if(rejected, 'und', lang_pred)")) if reject else found
