"""Language-model scores by the difference of two cross-entropies.

Two bigram models are counted over the whole corpus: the background over every text, the target
over the texts that are marked. They are matched: one vocabulary (the corpus's distinct words and
one unknown word), one order, one smoothing, and one size, for the background's counts are scaled
to the target's number of words, so neither is smoother than the other. With c the counts so
scaled, N the target's words and V the vocabulary's size,

    p(w)     = (c(w) + ADD) / (N + ADD V)
    p(w | v) = (c(v w) + PRIOR p(w)) / (c(v) + PRIOR)      c(v): pairs that v begins

and a text's first word has p(w). Both are distributions. Words and pairs are known by the top 56
bits of a 64-bit hash, so each has its own count and the models grow with the corpus.

No table of a model is ever held in one place. Texts are gathered into chunks of about
``CHUNK`` bytes. A chunk sends each of its distinct words and pairs once, with its own counts,
to the bucket of the key's top bits; the bucket adds up the counts of all chunks and sends the
sums back, in the order in which the keys came. A frequent word is thus one key per chunk.

A text's score is the mean over its words of the background's loss less the target's, in nats:
above 0 it is more like the target. Texts without words have the score 0 and no losses; null
texts are empty. Rows are scored one by one, so repeated rows are alike, and each of them counts.
A null id is scored, but never marked. An empty table gives no rows; without a marked word both
models are the prior of the vocabulary and scores are 0. A text longer than a chunk is a chunk of
its own. Only the two named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderspan.llm.arrow import groups, texts
from cinderspan.session import cut

K = np.uint64(0x9E3779B97F4A7C15)
#: The part of a hash that is kept: its low byte is empty.
TOP = ~np.uint64(0xFF)
#: What is added to every word's count, and the weight of the word estimate among pairs.
ADD, PRIOR = 0.5, 2.0
#: Marked ids that are broadcast; more are joined by a shuffle.
MOST_MARKED = 1 << 20
#: Bytes of text in a chunk, and those whose keys share a bucket.
CHUNK, BUCKET = 8 << 20, 16 << 20


def word_and_pair_ids(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words (lower case A-Z), and of each word with the one before it (the first: none)."""
    words = text.encode().lower().split()
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    before = np.concatenate([np.zeros(min(1, len(h)), np.uint64), h[:-1]])
    pairs = (before * K + h) * K
    return h & TOP, (pairs ^ (pairs >> np.uint64(32))) * K & TOP


def chunks(docs: DataFrame, marked: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per chunk: ``chunk, bucket`` (-1), ``payload`` (its rows)."""
    flags = marked.select(F.col("doc_id").cast("bigint").alias("_id"), F.lit(True).alias("_marked")).where("_id IS NOT NULL").distinct()
    # The flags are small beside the texts: up to a bound they go to the texts, beyond it both are shuffled.
    flags = flags.hint("broadcast" if marked.count() <= MOST_MARKED else "merge")
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = rows.join(flags, "_id", "left").select(F.col("_id").alias("doc_id"), "text", F.coalesce("_marked", F.lit(False)).alias("marked"))

    def pack(k: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            for part in held:
                writer.write_batch(part)
        number = (TaskContext.get().partitionId() << 32) + k
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([-1], pa.int32()), pa.array([sink.getvalue().to_pybytes()])], ["chunk", "bucket", "payload"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, k = [], 0, 0
        for batch in batches:
            lengths = [len(t) for t in texts(batch.column(1))]
            start = 0
            for i, n in enumerate(lengths):
                size += n + 16
                if size >= CHUNK:
                    yield pack(k, [*held, batch.slice(start, i + 1 - start)])
                    held, size, k, start = [], 0, k + 1, i + 1
            if start < len(lengths):
                held.append(batch.slice(start))
        if held:
            yield pack(k, held)

    return rows.mapInArrow(work, "chunk long, bucket int, payload binary")


class Keys:
    """The distinct words and pairs of a chunk, ascending, and where its texts hold them."""

    def __init__(self, payload: bytes):
        rows = pa.ipc.open_stream(payload).read_all()
        self.ids = rows.column(0)
        found = [word_and_pair_ids(t) for t in texts(rows.column(1))]
        self.lengths = np.array([len(w) for w, _ in found], np.int64)
        own = np.repeat(np.array(rows.column(2).to_pylist(), bool), self.lengths)
        words, pairs = (np.concatenate([f[k] for f in found]) for k in (0, 1))
        self.words, self.word_at = np.unique(words, return_inverse=True)
        self.pairs, self.pair_at = np.unique(pairs, return_inverse=True)
        self.first = np.zeros(len(words), bool)
        starts = np.cumsum(self.lengths) - self.lengths
        self.first[starts[self.lengths > 0]] = True
        begins = np.ones(len(words), bool)
        begins[(starts + self.lengths - 1)[self.lengths > 0]] = False
        count = lambda at, size, keep: np.bincount(at[keep], minlength=size)
        n, m = len(self.words), len(self.pairs)
        #: Background and target counts of words and contexts (words that begin a pair), then of pairs.
        self.word_counts = np.stack([count(self.word_at, n, k) for k in (slice(None), own, begins, begins & own)])
        self.pair_counts = np.stack([count(self.pair_at, m, k) for k in (slice(None), own)])

    def edges(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Where each bucket's words and pairs begin and end."""
        heads = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
        return tuple(np.append(np.searchsorted(k, heads), len(k)) for k in (self.words, self.pairs))


def _planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte, highest first: all the first bytes, then all the second ones."""
    return np.ascontiguousarray(values.astype(">u8").reshape(-1, 1).view(np.uint8).T).tobytes()


def _from_planes(raw: bytes, n: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, n).T).view(">u8").astype(np.uint64).reshape(n)


def keys_packed(keys: np.ndarray) -> bytes:
    """Ascending keys: their three top bytes hardly change and are compressed, the other four are as they come."""
    raw, n = _planes(keys), len(keys)
    top = zlib.compress(raw[: 3 * n], 1)
    return len(top).to_bytes(4, "little") + top + raw[3 * n : 7 * n]


def keys_unpacked(raw: bytes) -> np.ndarray:
    raw = bytes(raw)
    size = int.from_bytes(raw[:4], "little")
    rest = raw[4 + size :]
    n = len(rest) // 4
    return _from_planes(zlib.decompress(raw[4 : 4 + size]) + rest + bytes(n), n)


def _packed(words: np.ndarray, pairs: np.ndarray) -> bytes:
    return zlib.compress(_planes(words) + _planes(pairs), 1)


def _unpacked(raw: bytes, n: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    data = zlib.decompress(raw)
    words, pairs = _from_planes(data[: 32 * n], 4 * n), _from_planes(data[32 * n :], 2 * m)
    return words.astype(np.int64).reshape(4, n), pairs.astype(np.int64).reshape(2, m)


def sent(held: DataFrame, bits: int) -> DataFrame:
    """What each chunk sends to each bucket: ``chunk, bucket, words, pairs`` (keys), ``counts``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, payload in zip(batch.column(0).to_pylist(), batch.column(2)):
                keys = Keys(payload.as_buffer())
                ws, ps = keys.edges(bits)
                for b in range(1 << bits):
                    w, p = slice(ws[b], ws[b + 1]), slice(ps[b], ps[b + 1])
                    if w.start == w.stop and p.start == p.stop:
                        continue
                    row = [number, b, keys_packed(keys.words[w]), keys_packed(keys.pairs[p]), _packed(keys.word_counts[:, w], keys.pair_counts[:, p])]
                    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], ["chunk", "bucket", "words", "pairs", "counts"])

    return held.mapInArrow(work, "chunk long, bucket int, words binary, pairs binary, counts binary")


def answers(parts: DataFrame, bits: int) -> DataFrame:
    """The sums for each chunk of each bucket: ``chunk, bucket, payload``; a row without a chunk has the bucket's totals."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, "bucket"):
            words, pairs = ([keys_unpacked(x.as_buffer()) for x in group.column(c)] for c in ("words", "pairs"))
            own = [_unpacked(x.as_buffer(), len(w), len(p)) for x, w, p in zip(group.column("counts"), words, pairs)]
            sums, places = [], []
            for k, keys in enumerate((words, pairs)):
                distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
                values = np.concatenate([o[k] for o in own], axis=1)
                total = np.zeros((len(values), len(distinct)), np.int64)
                for row, value in zip(total, values):
                    np.add.at(row, at, value)
                sums.append(total)
                places.append(np.split(at, np.cumsum([len(x) for x in keys])[:-1]))
            bucket = group.column("bucket")[0].as_py()
            out = [(c, _packed(sums[0][:, w], sums[1][:, p]), 0, 0, 0) for c, w, p in zip(group.column("chunk").to_pylist(), *places)]
            out.append((None, b"", sums[0].shape[1], int(sums[0][0].sum()), int(sums[0][1].sum())))
            columns = list(zip(*out))
            arrays = [pa.array(columns[0], pa.int64()), pa.array([bucket] * len(out), pa.int32()), pa.array(columns[1], pa.binary())]
            yield pa.RecordBatch.from_arrays([*arrays, *(pa.array(c, pa.int64()) for c in columns[2:])], ["chunk", "bucket", "payload", "distinct", "background", "target"])

    # A bucket is a partition: by its number itself, so the largest task doesn't grow with the corpus.
    dealt = parts.repartitionById(1 << bits, F.col("bucket")).sortWithinPartitions("bucket")
    return dealt.mapInArrow(work, "chunk long, bucket int, payload binary, distinct long, background long, target long")


def losses(keys: Keys, word_sums: np.ndarray, pair_sums: np.ndarray, model: int, scale: float, total: int, size: int) -> np.ndarray:
    """The loss of every word of a chunk, under the background (``model`` 0) or the target (1), counts times ``scale``."""
    own = ((scale * word_sums[model] + ADD) / (total + ADD * size))[keys.word_at]
    seen = np.concatenate([[0], scale * word_sums[2 + model][keys.word_at[:-1]]])[: len(own)]
    joint = (scale * pair_sums[model][keys.pair_at] + PRIOR * own) / (seen + PRIOR)
    return -np.log(np.where(keys.first, own, joint))


def lm_scores(docs: DataFrame, marked: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text: ``doc_id, n_words, target_loss, background_loss, score`` (losses per word)."""
    held = cut(chunks(docs, marked, id_col, text_col), "lm-chunks")
    number = held.count()
    bits = max(1, int(number * CHUNK // BUCKET).bit_length())
    back = cut(answers(sent(held, bits), bits), "lm-counts")
    size, *totals = back.where("chunk IS NULL").agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("distinct", "background", "target"))).first()
    size, target = size + 1, totals[1]
    scales = (target / totals[0] if totals[0] else 0.0, 1.0)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, "chunk"):
            payloads = group.column("payload")
            keys = Keys(payloads[0].as_buffer())
            ws, ps = keys.edges(bits)
            got = [_unpacked(x.as_buffer(), ws[b + 1] - ws[b], ps[b + 1] - ps[b]) for b, x in zip(group.column("bucket").to_pylist()[1:], payloads[1:])]
            word_sums, pair_sums = (np.concatenate([g[k] for g in got], axis=1) if got else np.zeros((4 - 2 * k, 0)) for k in (0, 1))
            ends = np.cumsum(keys.lengths)
            means = []
            for model in (1, 0):
                sums = np.concatenate([[0.0], np.cumsum(losses(keys, word_sums, pair_sums, model, scales[model], target, size))])
                means.append((sums[ends] - sums[ends - keys.lengths]) / np.maximum(keys.lengths, 1))
            empty = keys.lengths == 0
            arrays = [pa.array(keys.lengths), *(pa.array(m, pa.float64(), mask=empty) for m in means), pa.array(means[1] - means[0])]
            yield pa.RecordBatch.from_arrays([keys.ids.combine_chunks(), *arrays], ["doc_id", "n_words", "target_loss", "background_loss", "score"])

    both = held.unionByName(back.where("chunk IS NOT NULL").select("chunk", "bucket", "payload"))
    dealt = both.repartition(max(number, held.sparkSession.sparkContext.defaultParallelism), "chunk").sortWithinPartitions("chunk", "bucket")
    return dealt.mapInArrow(work, "doc_id long, n_words long, target_loss double, background_loss double, score double")
