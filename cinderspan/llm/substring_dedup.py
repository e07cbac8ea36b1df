"""Substring dedup: content-defined chunks under a gear rolling hash, deduplicated by digest.

A text's UTF-8 bytes are cut where the gear hash of the last 32 bytes has its five top bits
clear, at least ``least`` and at most ``most`` bytes after the previous cut and never inside a
character. Cuts depend on nearby bytes only, so chunks line up again after an insertion.
Chunks are grouped by a 128-bit digest. The chunk kept is the first in the smallest id.

A passage is a run of neighbouring chunks that each occur more than once in the corpus. The
chunks at its ends differ between texts, so the run is extended to both sides, byte by byte and
up to ``REACH``, as far as the text that keeps the end chunk goes on in the same way (for that
text: as far as any other does). It counts if it then has ``min_words`` words or more. Within a
passage every chunk that is not kept is removed with its extension, cut back to whole words at
both ends. Only a passage that holds no whole equal chunk is not seen.

A row is known by its id and, where the table repeats an id, by a digest of its text beside it
(``row_tag``), so different texts under one id are different texts. Ties between them go to the
smaller digest.

Null and empty texts have no chunks and stay as they are. Rows with a null id neither give nor
lose text. Rows that repeat both id and text are one text: they stay alike, and what the first
occurrence keeps all of them keep. A text of any length is cut in one pass over its bytes; its
spans, at most one for every ``least`` bytes, are gathered by row, never by id or digest. An empty
table gives no rows. Columns of the names of the new ones are replaced; any others pass through,
whatever they are called.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinderspan.llm.arrow import texts
from cinderspan.session import cut

#: The gear: one 32-bit value for each byte, from a rule.
GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), seed=0) for b in range(256)], np.uint32)
LEAST, MOST, BITS = 16, 160, 5
#: Bytes compared beyond a run's ends: more than a longest chunk and the gear's window.
REACH = 224


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte: h = 2 h + gear, in 32 bits, by doubling the window."""
    h = GEAR[data]
    for step in (1, 2, 4, 8, 16):
        ahead = h.copy()
        ahead[step:] += h[:-step] << np.uint32(step)
        h = ahead
    return h


def chunk_ends(data: bytes, least: int = LEAST, most: int = MOST, bits: int = BITS) -> list[int]:
    """Ends of the chunks of ``data`` (UTF-8), ascending; the last is its length."""
    size = len(data)
    if not size:
        return []
    raw = np.frombuffer(data, np.uint8)
    inside = (raw & 0xC0) == 0x80  # a cut before such a byte would split a character
    marks = np.flatnonzero((gear_hashes(raw) >> np.uint32(32 - bits)) == 0) + 1
    marks = marks[marks < size]
    marks = marks[~inside[marks]].tolist()
    ends, last, at = [], 0, 0
    while size - last > least:
        at = bisect_left(marks, last + least, at)
        end = marks[at] if at < len(marks) else size
        if end - last > most:
            end = last + most
            while end < size and inside[end]:
                end -= 1
        if end >= size:
            break
        ends.append(end)
        last = end
    ends.append(size)
    return ends


def _signed(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, ">i8").astype(np.int64).reshape(-1, 2)


def row_tag(docs: DataFrame, id_col: str, text_col: str) -> Column:
    """What tells rows of one id apart: 0 where the table repeats no id, else a digest of the text."""
    ids = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id")).where("doc_id IS NOT NULL")
    repeated = not ids.groupBy("doc_id").count().where("count > 1").isEmpty()
    return F.xxhash64(F.col(f"`{text_col}`").cast("string")) if repeated else F.lit(0).cast("bigint")


def chunks(docs: DataFrame, tag: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per chunk: ``doc_id, tag, start, end`` (bytes), ``hi, lo`` (digest), ``again`` (seen before in its text)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, starts, ends, digests, again = [], [], [], [], []
            for text in texts(batch.column(2)):
                data = text.encode()
                stops = chunk_ends(data)
                begins = [0, *stops[:-1]] if stops else []
                own = [xxhash.xxh3_128_digest(data[a:b]) for a, b in zip(begins, stops)]
                seen: set[bytes] = set()
                for d in own:
                    again.append(d in seen)
                    seen.add(d)
                counts.append(len(stops))
                starts += begins
                ends += stops
                digests += own
            keys = _signed(b"".join(digests))
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array(np.repeat(batch.column(c).to_numpy(zero_copy_only=False), counts)) for c in (0, 1)),
                    pa.array(starts, pa.int32()),
                    pa.array(ends, pa.int32()),
                    pa.array(np.ascontiguousarray(keys[:, 0])),
                    pa.array(np.ascontiguousarray(keys[:, 1])),
                    pa.array(again, pa.bool_()),
                ],
                ["doc_id", "tag", "start", "end", "hi", "lo", "again"],
            )

    wanted = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), tag.alias("tag"), F.col(f"`{text_col}`").cast("string").alias("text")).where("doc_id IS NOT NULL AND text <> ''")
    return wanted.mapInArrow(work, "doc_id long, tag long, start int, end int, hi long, lo long, again boolean")


def repeated_chunks(docs: DataFrame, tag: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text with repeated chunks: ``doc_id, tag, spans`` (array of start, end, first_doc, kept, key, who).

    ``key`` stands for the digest, ``who`` for the texts that hold it, each as often as it does.
    The corpus is cut twice, once to count and once to place: keeping 20 million chunks a GB
    between the two would cost more disk than cutting again costs time.
    """
    found = chunks(docs, tag, id_col, text_col)
    # Counts and minima are combined before the shuffle, and the join is a plain equi-join
    # whose large partitions adaptive execution splits, so a hot digest needs no one task.
    first = F.min(F.struct("doc_id", "tag")).alias("first")
    often = found.groupBy("hi", "lo").agg(F.count("*").alias("n"), first, F.expr("bit_xor(xxhash64(doc_id, tag, again)) + count(*)").alias("who")).where("n > 1").drop("n")
    kept = F.expr("doc_id = first.doc_id AND tag = first.tag AND NOT again").alias("kept")
    span = F.struct("start", "end", F.col("first.doc_id").alias("first_doc"), kept, F.xxhash64("hi", "lo").alias("key"), "who")
    marked = found.join(often, ["hi", "lo"]).select("doc_id", "tag", span.alias("span"))
    return marked.groupBy("doc_id", "tag").agg(F.sort_array(F.collect_set("span")).alias("spans"))


def borders(data: bytes, spans: list[dict]) -> Iterator[tuple[int, int, int, bool, bytes]]:
    """``at, side, key, kept, beyond`` where other texts hold a span than the one beside it; -1 is the left side, read backwards."""
    for k, span in enumerate(spans):
        for side, at, other in ((-1, span["start"], spans[k - 1] if k else None), (1, span["end"], spans[k + 1] if k + 1 < len(spans) else None)):
            if other and at == other["end" if side < 0 else "start"] and other["who"] == span["who"]:
                continue
            beyond = data[at : at + REACH] if side > 0 else data[max(0, at - REACH) : at][::-1]
            if beyond:
                yield at, side, span["key"], span["kept"], beyond


def common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


def extensions(joined: DataFrame, text_col: str) -> DataFrame:
    """One row per text whose runs go on beyond their chunks: ``doc_id, tag, ext`` (array of at, side, n).

    ``joined`` has ``row`` (with the text), ``doc_id, tag, spans``. It is taken as it is, rows without spans
    too: a filter or a choice of columns here would shuffle the texts a second time.
    """
    names = ["doc", "tag", "at", "side", "key", "kept", "beyond"]

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.binary()]
        for batch in batches:
            rows = []
            column = batch.column("row").field(text_col)
            for i, own in enumerate(batch.column("spans").to_pylist()):
                if own:
                    key = batch.column("doc_id")[i].as_py(), batch.column("tag")[i].as_py()
                    rows += [(*key, *b) for b in borders((column[i].as_py() or "").encode(), own)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, tag, at, first, first_tag, first_at, side, a, b = (c.to_pylist() for c in batch.columns)
            n = [common(x, y) for x, y in zip(a, b)]
            columns = [pa.array(doc + first, pa.int64()), pa.array(tag + first_tag, pa.int64()), pa.array(at + first_at, pa.int32()), pa.array(side * 2, pa.int32()), pa.array(n * 2, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "tag", "at", "side", "n"])

    found = joined.mapInArrow(edges, "doc long, tag long, at int, side int, key long, kept boolean, beyond binary")
    # Each key has one keeper, so a frequent key makes no more rows than it has holders, and the join may be split.
    # (Rows that repeat id and text keep alike; one of them is enough.)
    keepers = found.where("kept").select("key", "side", *(F.col(c).alias(f"first_{c}") for c in ("doc", "tag", "at", "beyond"))).dropDuplicates(["key", "side"])
    pairs = found.where("NOT kept").join(keepers, ["key", "side"]).select("doc", "tag", "at", "first_doc", "first_tag", "first_at", "side", "beyond", "first_beyond")
    longest = pairs.mapInArrow(measure, "doc long, tag long, at int, side int, n int").where("n > 0").groupBy("doc", "tag", "at", "side").agg(F.max("n").alias("n"))
    return longest.groupBy(F.col("doc").alias("doc_id"), "tag").agg(F.collect_list(F.struct("at", "side", "n")).alias("ext"))


def extended(spans: list[dict], ext: list[dict] | None) -> list[dict]:
    """``spans`` with the ends of their runs moved outwards, without overlap."""
    more = {(e["at"], e["side"]): e["n"] for e in ext or ()}
    starts, ends = {s["start"] for s in spans}, {s["end"] for s in spans}
    out: list[dict] = []
    for span in spans:
        a, b = span["start"], span["end"]
        low = a if a in ends else a - more.get((a, -1), 0)
        high = b if b in starts else b + more.get((b, 1), 0)
        out.append(span | {"start": low, "end": high})
    for k in range(1, len(out)):
        # What two runs both reach goes to the left one, but no further than the right one's chunks.
        out[k - 1]["end"] = min(out[k - 1]["end"], spans[k]["start"])
        out[k]["start"] = max(out[k]["start"], out[k - 1]["end"])
    return out


def passages(data: bytes, spans: list[dict], min_words: int) -> list[list[dict]]:
    """Runs of neighbouring spans with ``min_words`` words or more."""
    runs: list[list[dict]] = []
    for span in spans:
        if runs and runs[-1][-1]["end"] == span["start"]:
            runs[-1].append(span)
        else:
            runs.append([span])
    return [r for r in runs if len(data[r[0]["start"] : r[-1]["end"]].split()) >= min_words]


def removed_ranges(data: bytes, runs: list[list[dict]]) -> list[tuple[int, int]]:
    """Byte ranges of what is not kept, cut back to whole words."""
    out = []
    for run in runs:
        at = 0
        while at < len(run):
            stop = at
            while stop < len(run) and not run[stop]["kept"]:
                stop += 1
            if stop > at:
                a, b = run[at]["start"], run[stop - 1]["end"]
                while a < b and a and not data[a - 1 : a].isspace():
                    a += 1
                while b > a and b < len(data) and not data[b : b + 1].isspace():
                    b -= 1
                if a < b:
                    out.append((a, b))
            at = max(stop, at + 1)
    return out


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 25) -> DataFrame:
    """``docs`` with repeated passages cut from its text, and what was found.

    New columns: ``removed_bytes``, ``n_passages`` (repeated passages that the text holds, kept
    ones included), ``passage_words``, ``first_doc_ids`` (ids that keep what the text repeats). A
    text without repeated passages is unchanged.
    """
    new = ["removed_bytes", "n_passages", "passage_words", "first_doc_ids"]
    own = [c for c in docs.columns if c not in new]
    fields = [docs.schema[c] for c in own]
    tag = row_tag(docs, id_col, text_col)
    spans = cut(repeated_chunks(docs, tag, id_col, text_col), "sdedup-spans")
    # The row travels as one struct, so that no column of it can clash with the operator's own.
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in own)).alias("row"), F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), tag.alias("tag"))
    joined = keyed.join(spans, ["doc_id", "tag"], "left")
    found = extensions(joined, text_col)
    joined = joined.join(found, ["doc_id", "tag"], "left").select("row", "spans", "ext")
    kinds = {"removed_bytes": pa.int64(), "n_passages": pa.int64(), "passage_words": pa.int64(), "first_doc_ids": pa.list_(pa.int64())}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(own, batch.column("row").flatten()))
            column = columns[text_col].to_pylist()
            found = [s and extended(s, ext) for s, ext in zip(batch.column("spans").to_pylist(), batch.column("ext").to_pylist())]
            extra: dict[str, list] = {x: [] for x in new}
            for i, spans in enumerate(found):
                data = (column[i] or "").encode() if spans else b""
                runs = passages(data, spans, min_words) if spans else []
                ranges = removed_ranges(data, runs)
                if ranges:
                    stops = [0, *(b for _, b in ranges)]
                    column[i] = b"".join(data[s:a] for s, (a, _) in zip(stops, ranges)).decode() + data[stops[-1] :].decode()
                extra["removed_bytes"].append(sum(b - a for a, b in ranges))
                extra["n_passages"].append(len(runs))
                extra["passage_words"].append(sum(len(data[r[0]["start"] : r[-1]["end"]].split()) for r in runs))
                extra["first_doc_ids"].append(sorted({s["first_doc"] for r in runs for s in r}))
            columns[text_col] = pa.array(column, pa.string())
            yield pa.RecordBatch.from_arrays([*columns.values(), *(pa.array(extra[k], kinds[k]) for k in new)], [*own, *new])

    counts = [T.StructField(c, T.LongType()) for c in new[:3]]
    return joined.mapInArrow(work, T.StructType([*fields, *counts, T.StructField(new[3], T.ArrayType(T.LongType()))]))
