"""Quality classifier: supervised subword embeddings, trained by numpy stochastic gradient descent.

A text's features are its words, the n-grams of each word (3 to 5 UTF-8 bytes, with word ends)
and its neighbouring word pairs, hashed into ``buckets`` rows of an embedding table; a pair that the text
has had before counts as one more feature, the same for all pairs, as does one that it has not, so that the mean
shows what repeats. A text is the mean of its features' vectors; a softmax layer on top gives the two classes.

Training reads at most ``per_class`` labelled rows of each label, chosen by the smallest hash of
their ids: a bounded sample, so it runs on the driver. It keeps the sample's texts and the table, and makes
a text's features anew, block by block, whenever it comes to it. Scoring is a map over
all texts with the model's per-feature scores (embedding times output layer: the mean is linear)
as one broadcast table of ``buckets`` floats.

Null and empty texts have no features and get the score of the bias alone. A document with
several labels counts with the largest; null labels are ignored. With no label, or labels of one
class only, the model is the prior of what there is (0.5 without labels). Repeated rows score
alike; training takes one of the rows of a repeated id. A text of any length is scored whole, by blocks. An
empty table gives no rows. Columns named ``score`` or ``predicted`` are replaced; others pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinderspan.llm.arrow import texts

BUCKETS = 1 << 18
#: Words whose features are found together.
BLOCK = 20_000
K = 0x9E3779B97F4A7C15


#: Features of a pair that is new in its text, and of one that is not.
FRESH, AGAIN = (np.uint64(xxhash.xxh3_64_intdigest(x)) for x in (b" fresh pair ", b" pair again "))


def _rows(words: list[bytes], after: int | None, buckets: int, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of ``words``, of their pairs and, with the hash of the word ``after`` which they stand, of that pair; the pairs ``seen`` so far."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    raw = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8)
    frame, codes = raw == 32, raw.astype(np.uint64)
    chain = h if after is None else np.concatenate([np.array([after], np.uint64), h])
    pairs = chain[:-1] * np.uint64(K) + chain[1:]
    kinds, first = np.unique(pairs, return_index=True)
    fresh = np.zeros(len(pairs), bool)
    fresh[first[~np.isin(kinds, seen, assume_unique=True)]] = True
    parts = [h, pairs, np.where(fresh, FRESH, AGAIN)]
    for n in (3, 4, 5):
        stop = len(raw) - n + 1
        if stop < 1:
            continue
        gram = np.full(stop, n, np.uint64)
        inner = np.zeros(stop, bool)
        for k in range(n):
            gram += codes[k : stop + k] * np.uint64(pow(K, k + 1, 1 << 64))
            if 0 < k < n - 1:
                inner |= frame[k : stop + k]
        parts.append(gram[~inner])
    found = np.concatenate(parts)
    return ((found ^ (found >> np.uint64(32))) * np.uint64(K) >> np.uint64(20) & np.uint64(buckets - 1)).astype(np.int64), kinds


def feature_blocks(text: str, buckets: int = BUCKETS, size: int = BLOCK) -> Iterator[np.ndarray]:
    """Table rows of all words, word pairs and byte n-grams of ``text``, repeats included, ``size`` words at a time.

    A word is framed by one space at each end; an n-gram may hold a frame but not cross it. So blocks of
    words have between them just what the whole text has, in memory that only a single long word and the different pairs can raise.
    """
    words, seen = text.encode().split(), np.empty(0, np.uint64)
    for at in range(0, len(words), size):
        rows, pairs = _rows(words[at : at + size], xxhash.xxh3_64_intdigest(words[at - 1]) if at else None, buckets, seen)
        seen = np.union1d(seen, pairs)
        yield rows


def feature_shares(text: str, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """The different table rows of ``text``, ascending, and the share of each."""
    blocks = list(islice(feature_blocks(text, buckets), 2))
    if not blocks:
        return np.empty(0, np.int64), np.empty(0, np.float32)
    if len(blocks) == 1:
        found, counts = np.unique(blocks[0], return_counts=True)
    else:
        total = np.zeros(buckets, np.int64)
        for block in feature_blocks(text, buckets):
            total += np.bincount(block, minlength=buckets)
        found = np.flatnonzero(total)
        counts = total[found]
    return found, (counts / counts.sum()).astype(np.float32)


class SubwordModel:
    """Embedding table, output layer and bias."""

    def __init__(self, buckets: int = BUCKETS, dim: int = 16, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.table = rng.uniform(-1 / dim, 1 / dim, (buckets, dim)).astype(np.float32)
        self.out = np.zeros((dim, 2), np.float32)
        self.bias = np.zeros(2, np.float32)

    def fit(self, rows: list[tuple[str, int]], epochs: int = 4, rate: float = 0.3, seed: int = 1, least: int = 3000) -> SubwordModel:
        """Gradient descent, one text at a time, with a falling rate; the classes weigh alike. Few texts are gone over more often, ``least`` steps in all.

        A text's features are found anew at each step: kept, they would take many times the texts' memory.
        """
        rows = [(t, y) for t, y in rows if t.encode().split(None, 1)]
        share = np.bincount([y for _, y in rows], minlength=2) / max(1, len(rows))
        weight = np.where(share > 0, 0.5 / np.maximum(share, 1e-9), 0.0)
        rng, steps = np.random.default_rng(seed), len(rows) * max(epochs, -(-least // max(1, len(rows))))
        for step in range(steps):
            if step % len(rows) == 0:
                order = rng.permutation(len(rows))
            text, label = rows[order[step % len(rows)]]
            found, shares = feature_shares(text, len(self.table))
            vectors = self.table[found]
            mean = shares @ vectors
            logits = mean @ self.out + self.bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            p *= np.float32(rate * weight[label] * (1 - step / steps))
            back = self.out @ p
            self.out -= np.outer(mean, p)
            self.bias -= p
            # A feature's step goes with its share, scaled so that a text moves as one vector.
            self.table[found] = vectors - np.minimum(shares * 50, 1)[:, None] * back
        return self

    def margins(self) -> tuple[np.ndarray, float]:
        """Per-feature difference of the two outputs, and that of the bias."""
        return (self.table @ (self.out[:, 1] - self.out[:, 0])).astype(np.float32), float(self.bias[1] - self.bias[0])


def score_text(text: str, margin: np.ndarray, bias: float) -> float:
    total, n = 0.0, 0
    for rows in feature_blocks(text, len(margin)):
        total += float(margin[rows].sum(dtype=np.float64))
        n += len(rows)
    logit = bias + (total / n if n else 0.0)
    return float(1 / (1 + np.exp(-logit)))


def held_out(id_col: Column) -> Column:
    """Rows that training never reads: crc32 of the id as text, modulo 3, is 1 (null: as empty)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def train(docs: DataFrame, labels: DataFrame, target: str = "quality", id_col: str = "doc_id", text_col: str = "text", per_class: int = 1500) -> SubwordModel | float:
    """A model of ``labels[target]``, or a constant score where labels have fewer than two classes."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("_id"), F.col(target).cast("int").alias("_y")).where("_id IS NOT NULL AND _y IN (0, 1)")
    known = known.where(~held_out(F.col("_id"))).groupBy("_id").agg(F.max("_y").alias("_y"))
    present = docs.select(F.col(id_col).cast("bigint").alias("_id")).where("_id IS NOT NULL")
    known = known.join(present, "_id", "left_semi")
    chosen = [known.where(f"_y = {y}").orderBy(F.xxhash64("_id"), "_id").limit(per_class) for y in (0, 1)]
    ids = chosen[0].unionByName(chosen[1]).collect()  # 2 * per_class pairs at most
    if not ids:
        return 0.5
    label = {r["_id"]: r["_y"] for r in ids}
    # One row of a repeated id is enough; the filter is a set of 2 * per_class ids.
    picked = docs.where(F.col(id_col).isin(list(label))).select(F.col(id_col).cast("bigint").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    rows = {r["_id"]: r["_t"] for r in picked.groupBy("_id").agg(F.min("_t").alias("_t")).collect()}
    pairs = [(rows[i], label[i]) for i in sorted(rows)]
    if len({y for _, y in pairs}) < 2:
        return float(pairs[0][1]) if pairs else 0.5
    return SubwordModel().fit(pairs)


def quality_classifier(docs: DataFrame, model: SubwordModel | float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (probability of label 1) and ``predicted`` (1 if it is 0.5 or more)."""
    docs = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in ("score", "predicted")))
    if not isinstance(model, SubwordModel):
        return docs.withColumn("score", F.lit(float(model))).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    shared = docs.sparkSession.sparkContext.broadcast(model.margins())
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        margin, bias = shared.value
        for batch in batches:
            scores = [score_text(t, margin, bias) for t in texts(batch.column(text_col))]
            out = {f: batch.column(f) for f in batch.schema.names} | {"score": pa.array(scores, pa.float64())}
            yield pa.RecordBatch.from_pydict(out)

    return docs.mapInArrow(work, schema).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
