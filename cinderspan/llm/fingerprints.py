"""Document fingerprints from prefix polynomial hashes.

``PrefixHashes`` keeps, for two bases modulo the prime 2^31 - 1, the modular
prefix sums of code point times power. From them the hash of any span follows in constant time,
spans are compared without reading them, and the longest common extension of two positions is
found by binary search.

A fingerprint takes the span hashes of all windows of ``WIDTH`` code points (of a quarter of a
text that is shorter than four windows), deals them into ``SLOTS`` slots and keeps the low byte of each slot's smallest
hash. The share of equal slots estimates the Jaccard index J of the two window sets; the likeness
is 2 J / (1 + J), the shared part of an average text, after taking off chance agreement.
Equal texts have equal fingerprints; an empty text has a fingerprint of its own.

``fingerprint_neighbours`` also fingerprints each text's edited form, its last quarter replaced
by the start of the next text in ascending id. Texts are range-partitioned and sorted by id
once; a task holds two texts at a time, and the first text of each range travels to the range
before it. Null ids come first, ties are ordered by a digest of the text and by the text, and the last
text is followed by the first. There are at most ``MOST_RANGES`` ranges, so what the driver and a broadcast hold of them is
bounded; in a larger corpus ranges are longer and are sorted on disk and read as a stream. An id of so many rows that it fills several ranges is dealt over them
by the digest; only rows that repeat both id and text stay in one range.

Null texts are empty. A text of any length is fingerprinted whole, in memory in proportion to it.
An empty table gives no rows. Only the two named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


P = np.uint64((1 << 31) - 1)
BASES = (1_103_515_245, 1_664_525_001)
WIDTH, SLOTS = 16, 64
SIFT = 24  # expected windows per slot that pass the first sieve
EMPTY = "-"
#: Ranges of ids, each with one row on the driver.
MOST_RANGES = 1 << 14

_powers: dict[int, np.ndarray] = {}


def _mod(x: np.ndarray) -> np.ndarray:
    """Modulo P of products of two residues and of sums of up to 2^31 residues: one fold, one difference."""
    x = (x & P) + (x >> np.uint64(31))
    return np.minimum(x, x - P)  # below P the difference wraps around to a large number


def powers(base: int, size: int) -> np.ndarray:
    """base^0 .. base^(size-1), by doubling; kept up to a million entries."""
    known = _powers.get(base, np.ones(1, np.uint64))
    while len(known) < size:
        known = np.concatenate([known, _mod(known * np.uint64(pow(base, len(known), int(P))))])
    if len(known) <= 1 << 20:
        _powers[base] = known
    return known[:size]


class PrefixHashes:
    """Modular prefix arrays of a text's code points."""

    def __init__(self, codes: np.ndarray):
        self.size = len(codes)
        x = codes.astype(np.uint64) + np.uint64(1)
        self.sums = []
        for base in BASES:
            terms = _mod(x * powers(base, self.size))
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), _mod(np.cumsum(terms))]))

    def spans(self, starts: np.ndarray, length: int) -> np.ndarray:
        """Hashes of all spans of one length, 62 bits."""
        out = np.zeros(len(starts), np.uint64)
        for base, sums in zip(BASES, self.sums):
            inverse = pow(base, -1, int(P))
            part = sums[starts + length] + P - sums[starts]
            out = (out << np.uint64(31)) | _mod(_mod(part) * powers(inverse, len(sums))[starts])
        return out

    def windows(self, width: int) -> np.ndarray:
        """Hashes of every window of ``width``, by whole-array differences."""
        out = np.zeros(max(0, self.size - width + 1), np.uint64)
        for base, sums in zip(BASES, self.sums):
            part = _mod(sums[width:] + P - sums[: len(out)])
            out = (out << np.uint64(31)) | _mod(part * powers(pow(base, -1, int(P)), len(out)))
        return out

    def span(self, start: int, length: int) -> int:
        return int(self.spans(np.array([start]), length)[0])

    def equal(self, start: int, other: PrefixHashes, at: int, length: int) -> bool:
        """Whether two spans are equal; each hash is raised to the other's position, so none is divided."""
        for base, a, b in zip(BASES, self.sums, other.sums):
            own = (int(a[start + length]) - int(a[start])) * pow(base, at, int(P))
            if (own - (int(b[at + length]) - int(b[at])) * pow(base, start, int(P))) % int(P):
                return False
        return True

    def common_extension(self, start: int, other: PrefixHashes, at: int) -> int:
        """Length of the longest common span from two positions."""
        low, high = 0, min(self.size - start, other.size - at)
        while low < high:
            middle = (low + high + 1) // 2
            if self.equal(start, other, at, middle):
                low = middle
            else:
                high = middle - 1
        return low


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def _minima(hashes: np.ndarray) -> np.ndarray:
    """The smallest mixed hash of each slot (all ones: none)."""
    h = hashes * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    least = np.full(SLOTS, np.uint64(0xFFFFFFFFFFFFFFFF))
    # A slot's minimum lies under any bound that some of its values pass, so a sieve is exact
    # whenever it leaves every slot a value.
    if len(h) > 4 * SIFT * SLOTS:
        passed = h[h < np.uint64(min((1 << 64) - 1, (1 << 64) * SIFT * SLOTS // len(h)))]
        np.minimum.at(least, (passed & np.uint64(SLOTS - 1)).astype(np.intp), passed)
        if (least != np.uint64(0xFFFFFFFFFFFFFFFF)).all():
            return least
    np.minimum.at(least, (h & np.uint64(SLOTS - 1)).astype(np.intp), h)
    return least


def fingerprint(hashes: PrefixHashes) -> str:
    """Two hex digits per slot ('..' for an empty slot)."""
    if not hashes.size:
        return EMPTY
    least = _minima(hashes.windows(min(WIDTH, max(1, hashes.size // 4))))
    raw = ((least >> np.uint64(8)) & np.uint64(0xFF)).tolist()
    none = (least == np.uint64(0xFFFFFFFFFFFFFFFF)).tolist()
    return "".join(".." if n else f"{x:02x}" for x, n in zip(raw, none))


def likeness(a: str, b: str) -> float:
    """0 to 1; 1 for equal fingerprints."""
    if a == b:
        return 1.0
    if EMPTY in (a, b):
        return 0.0
    pairs = [(a[i : i + 2], b[i : i + 2]) for i in range(0, 2 * SLOTS, 2)]
    used = [(x, y) for x, y in pairs if not x == y == ".."]
    share = sum(x == y for x, y in used) / len(used) if used else 1.0
    j = max(0.0, (share - 1 / 256) / (1 - 1 / 256))
    return 2 * j / (1 + j)


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as much of the start of ``following``, or all of it."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def fingerprint_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_range: int = 5_000) -> DataFrame:
    """One row per row: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, common_prefix``.

    ``common_prefix`` is the longest common extension of the text and its edited form from 0.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    docs = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tag"))
    # Ranges come from the ids alone: bounds of about per_range rows each, a few numbers a range.
    lowest = -(1 << 63)
    ids = docs.select(F.coalesce("doc_id", F.lit(lowest)).alias("doc_id"))
    total = ids.count()
    parts = max(1, min(MOST_RANGES, total // per_range), spark.sparkContext.defaultParallelism if total > 1000 else 1)
    bounds = sorted(int(x) for x in ids.approxQuantile("doc_id", [k / parts for k in range(1, parts)], 0.2 / parts)) if parts > 1 else []
    # An id that is a bound several times has that many ranges, dealt by the digest.
    known = spark.sparkContext.broadcast(np.array(bounds, np.int64))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.array([lowest if x is None else x for x in batch.column(0).to_pylist()], np.int64)
            low, high = (np.searchsorted(known.value, own, side=x) for x in ("left", "right"))
            share = batch.column(2).to_numpy() / 2.0**64 + 0.5
            found = np.where(high > low, low + 1 + np.minimum((share * (high - low)).astype(np.int64), high - low - 1), high)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.astype(np.int32))], ["doc_id", "text", "tag", "part"])

    placed = docs.mapInArrow(search, "doc_id long, text string, tag long, part int")
    by_part = F.struct(F.col("doc_id").isNotNull().alias("k"), "doc_id", "tag")
    firsts = {r.part: r["first"] for r in placed.groupBy("part").agg(F.min(by_part).alias("first")).collect()}
    order = sorted(firsts)
    # The first text of a range (ties: the smallest) is also the one after the range before it.
    heads = None
    follow = [(order[k - 1] if k else order[-1], firsts[p].doc_id, firsts[p].tag, p) for k, p in enumerate(order)]
    if follow:
        keyed = spark.createDataFrame(follow, "to int, head_id long, head_tag long, from_part int")
        heads = placed.join(F.broadcast(keyed), (F.col("part") == F.col("from_part")) & F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("tag") == F.col("head_tag")))
        heads = heads.groupBy("to", "head_id", "tag").agg(F.min("text").alias("text")).select(F.col("head_id").alias("doc_id"), "text", "tag", F.col("to").alias("part"), F.lit(1).alias("after"))
    rows = placed.withColumn("after", F.lit(0))
    rows = rows if heads is None else rows.unionByName(heads)
    # A range is a partition: by its number itself, for hashed numbers would meet.
    dealt = rows.repartitionById(len(bounds) + 1, F.col("part")).sortWithinPartitions("part", "after", F.col("doc_id").asc_nulls_first(), "tag", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "common_prefix"]
        held = None
        out: list[tuple] = []
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
        for batch in batches:
            columns = (batch.column(x) for x in ("doc_id", "text", "part", "after"))
            for doc_id, text, part, after in zip(*(c.to_pylist() for c in columns)):
                codes = PrefixHashes(code_points(text))
                own = (doc_id, text, part, codes, fingerprint(codes))
                if held is not None and held[2] == part:
                    changed = edited(held[1], text)
                    other = PrefixHashes(code_points(changed))
                    mark = fingerprint(other)
                    out.append((held[0], len(held[1]), hashlib.sha256(changed.encode()).hexdigest(), held[4], mark, likeness(held[4], mark), likeness(held[4], own[4]), held[3].common_extension(0, other, 0)))
                held = None if after else own
                if len(out) >= 1000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                    out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return dealt.mapInArrow(work, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, common_prefix long")
