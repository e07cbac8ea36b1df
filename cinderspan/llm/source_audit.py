"""Source divergence audit: how far the word use of the sources of a language is apart, in exact integers.

A group is the documents of one language and source. Each language keeps the terms that at least ``least`` of its documents
hold. With a term's count c in a group, N the group's count over all kept terms and V their number, the group gives
the term p = 1 + floor(SCALE * (c + 1) / (N + V)), also where c is 0; the language gives it q from its own counts. Against another
distribution q, a term diverges by f = floor((p - q)^2 / q).

1. Tasks count words per document and add them up for their own documents, so a common word is one row of a task and group.
   One shuffle adds these up by language, source and term, another gathers each term's sources: the term-major index, with
   one row for each kept term and as many postings in it as sources hold the term.
2. A block is so many terms of one language that it has about ``per_block`` postings, dealt by the term's hash. Within a
   block, row by row (Gustavson), a group's terms are scattered through the index into an accumulator with a place for
   each peer, of what the peers that hold the term add to the divergence. No pair of postings leaves the task.
3. Pairs that lack a term on one side or both diverge there too. For these zero baselines a group has no more than
   one value of p for each different count, so the sum over terms is one over the group's counts and how often they occur;
   the accumulator corrects it where both hold the term. A block's values are added up over blocks.

Values fit 64 bits while counts stay below 9 * 10^9: p is at most SCALE + 1, and the sum of (p - q)^2 / q over terms below 4 * 10^18.

A task holds a block's postings and, for its language, the names and totals of the sources; it does not hold pairs of them. The
result has one row for each pair of sources of a language, as the report asks for. Top terms are cut to ``top`` before and
after their shuffle, so a source with a third of all documents is not one task's work.

Null languages, sources and texts count as ''; such groups are groups, without terms where texts are empty. A repeated
row counts again. A language without kept terms gives its pairs the value 0. An empty table gives no rows. Only the three
named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinderspan.session import cut

SCALE = 1_000_000_000
#: What a byte of a text is in its terms: letters of ASCII small, all that is not ASCII as it is, the rest a space.
TERM_BYTES = np.array([b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)], np.uint8)
#: Bytes of texts whose terms a task adds up before it passes them on.
HELD = 24 << 20


def chunk_counts(lang: pa.Array, source: pa.Array, text: pa.Array) -> pa.RecordBatch:
    """``lang, source, term, n, docs`` of some documents, each term of a group once."""
    lang, source = lang.dictionary_encode(), source.dictionary_encode()
    group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
    # The texts' bytes, with a space for all that is in no term.
    _, offsets, data = text.buffers()
    spaced = text
    if data is not None and data.size:
        spaced = pa.LargeStringArray.from_buffers(len(text), offsets, pa.py_buffer(TERM_BYTES[np.frombuffer(data, np.uint8)]), None, 0, text.offset)
    words = pc.ascii_split_whitespace(spaced)
    flat = words.flatten().dictionary_encode()
    size = len(flat.dictionary)
    found = np.repeat(np.arange(len(text)), pc.list_value_length(words).to_numpy()) * size + flat.indices.to_numpy()
    blank = pc.index(flat.dictionary, pa.scalar("", flat.dictionary.type)).as_py()
    found, n = np.unique(found, return_counts=True)
    doc, term = np.divmod(found, max(1, size))
    real = term != blank
    key, place = np.unique(group[doc[real]] * size + term[real], return_inverse=True)
    own, term = np.divmod(key, max(1, size))
    at = np.divmod(own, max(1, len(source.dictionary)))
    columns = [lang.dictionary.take(pa.array(at[0])), source.dictionary.take(pa.array(at[1])), flat.dictionary.take(pa.array(term)).cast(pa.string())]
    sums = [np.bincount(place, weights=n[real], minlength=len(key)).astype(np.int64), np.bincount(place, minlength=len(key))]
    return pa.RecordBatch.from_arrays([*columns, *map(pa.array, sums)], ["lang", "source", "term", "n", "docs"])


def counted(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents, added up within tasks."""

    def summed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        lang, source, text = pa.Table.from_batches(held).combine_chunks().columns
        return chunk_counts(*(c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (lang, source, text.cast(pa.large_string()))))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= HELD:
                yield summed(held)
                held, size = [], 0
        if held:
            yield summed(held)

    return docs.mapInArrow(work, "lang string, source string, term string, n long, docs long")


def term_index(docs: DataFrame, least: int = 3) -> DataFrame:
    """One row per kept term: ``lang, term, total`` and ``postings`` (source, n)."""
    by_group = counted(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = by_group.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("postings"))
    return by_term.where(F.col("docs") >= least).select("lang", "term", "total", "postings")


def share(n: str, total: str, terms: str) -> Column:
    return F.expr(f"1 + ({SCALE} * ({n} + 1)) div ({total} + {terms})")


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def accumulated(source: np.ndarray, term: np.ndarray, n: np.ndarray, totals: np.ndarray, kept: int, here: int) -> Iterator[np.ndarray]:
    """For each source as a row, its divergence against each of them as a peer, over ``here`` terms of a block.

    Postings (source, term, n) are places and counts, ascending by term; ``totals`` are counts over all ``kept`` terms.
    """
    p = 1 + SCALE * (n + 1) // (totals[source] + kept)
    zero = 1 + SCALE // (totals + kept)
    starts = np.searchsorted(term, np.arange(here + 1))
    # Row-major copy of the block, and each peer's different counts with their numbers.
    rows = np.argsort(source, kind="stable")
    row_starts = np.searchsorted(source[rows], np.arange(len(totals) + 1))
    both, many = np.unique(source << 31 | p, return_counts=True)  # p is below 2 ** 31
    owner, level = both >> 31, both & (1 << 31) - 1
    held, level_starts = np.unique(owner, return_index=True)
    for g in range(len(totals)):
        neither = divergence(zero[g], zero)
        sums = neither * here
        # Peers' terms against the row's zero, as if the row held none of them.
        if len(held):
            sums[held] += np.add.reduceat((divergence(zero[g], level) - neither[owner]) * many, level_starts)
        own = rows[row_starts[g] : row_starts[g + 1]]
        if len(own):
            # The row's terms against the peers' zeros, as if no peer held them.
            values, times = np.unique(p[own], return_counts=True)
            for a in range(0, len(values), 256):
                sums += ((divergence(values[a : a + 256, None], zero[None, :]) - neither) * times[a : a + 256, None]).sum(axis=0)
            # Terms that both hold, through the index: what they add less both of the above.
            t = term[own]
            width = starts[t + 1] - starts[t]
            for a, b in spans(width, 1 << 20):
                at = np.repeat(starts[t[a:b]] - np.concatenate([[0], np.cumsum(width[a:b])[:-1]]), width[a:b]) + np.arange(width[a:b].sum())
                mine, peer = np.repeat(p[own[a:b]], width[a:b]), source[at]
                np.add.at(sums, peer, divergence(mine, p[at]) - divergence(mine, zero[peer]) - divergence(zero[g], p[at]) + neither[peer])
        yield sums


def spans(width: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of entries whose widths add up to ``most`` or so."""
    cuts = np.flatnonzero(np.diff(np.cumsum(width) // most)) + 1
    yield from zip([0, *cuts.tolist()], [*cuts.tolist(), len(width)])


def pair_values(index: DataFrame, groups: DataFrame, blocks: DataFrame) -> DataFrame:
    """``lang, source, item, value``: each group's divergence against each other source of its language.

    ``groups`` has ``lang, source, total, terms``; ``blocks`` has ``lang, blocks``.
    """
    block = F.expr("pmod(xxhash64(term), blocks)").alias("block")
    here = index.join(blocks, "lang").select("lang", block, "term", "postings")
    postings = here.select("lang", "block", "term", F.explode("postings").alias("x")).select("lang", "block", "term", "x.source", "x.n")
    peers = groups.join(blocks, "lang").select("lang", F.explode(F.expr("sequence(0L, blocks - 1)")).alias("block"), "source", "total", "terms")

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        peer = right.sort_by("source")
        names = peer.column("source").combine_chunks()
        totals = peer.column("total").to_numpy()
        place = pc.index_in(left.column("source").combine_chunks(), names).to_numpy(zero_copy_only=False).astype(np.int64)
        terms = left.column("term").combine_chunks().dictionary_encode()
        codes = terms.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.argsort(codes, kind="stable")
        lang = right.column("lang")[0].as_py() if right.num_rows else None
        kept = right.column("terms")[0].as_py() if right.num_rows else 0
        parts = []
        if kept:
            for g, sums in enumerate(accumulated(place[order], codes[order], left.column("n").to_numpy()[order], totals, kept, len(terms.dictionary))):
                others = np.arange(len(names)) != g
                size = int(others.sum())
                parts.append(pa.Table.from_arrays([pa.array([lang] * size, pa.string()), pa.array([names[g].as_py()] * size, pa.string()), names.filter(pa.array(others)), pa.array(sums[others], pa.int64())], ["lang", "source", "item", "value"]))
        kinds = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])
        return pa.concat_tables(parts).cast(kinds) if parts else kinds.empty_table()

    summed = postings.groupBy("lang", "block").cogroup(peers.groupBy("lang", "block")).applyInArrow(work, "lang string, source string, item string, value long")
    summed = summed.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    # Languages that keep no term have no distributions: all their pairs are 0.
    bare = groups.where("terms = 0").select("lang", "source")
    zeros = bare.join(bare.select("lang", F.col("source").alias("item")), "lang").where("source <> item").withColumn("value", F.lit(0).cast("bigint"))
    return summed.unionByName(zeros)


def source_audit(docs: DataFrame, least: int = 3, top: int = 200, per_block: int = 500_000, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``lang, source, part, item, value, rank``: part ``pair`` has all other sources, part ``term`` the ``top`` terms that a group has more of than its language."""
    wanted = docs.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(x) for x, c in (("lang", lang_col), ("source", source_col), ("text", text_col))))
    index = cut(term_index(wanted, least), "audit-index")
    langs = index.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("all"), F.sum(F.size("postings")).alias("postings"))
    totals = index.select("lang", F.explode("postings").alias("x")).groupBy("lang", F.col("x.source").alias("source")).agg(F.sum("x.n").alias("total"))
    every = wanted.select("lang", "source").distinct()
    groups = cut(
        every.join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .select("lang", "source", *(F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("total", "terms", "all", "postings"))),
        "audit-groups",
    )
    blocks = groups.groupBy("lang").agg(F.expr(f"cast(ceil(max(postings) / {per_block}) as bigint)").alias("blocks")).where("blocks > 0")
    pairs = pair_values(index, groups.select("lang", "source", "total", "terms"), blocks)
    held = index.select("lang", "term", F.col("total").alias("whole"), F.explode("postings").alias("x")).select("lang", "term", "whole", "x.source", "x.n")
    shares = held.join(groups, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), share("n", "total", "terms").alias("p"), share("whole", "`all`", "terms").alias("q"))
    terms = shares.where("p > q").select("lang", "source", "item", F.expr("((p - q) * (p - q)) div q").alias("value"))
    by = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = [x.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(by).alias("rank")) for part, x in (("pair", pairs), ("term", terms))]
    return ranked[0].unionByName(ranked[1].where(F.col("rank") <= top))
