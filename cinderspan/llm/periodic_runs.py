"""Periodic run detection: the dictionary of basic factors of a text's words.

A run is a stretch of words with smallest period q that is at least ``power`` periods and ``least``
words long and that no neighbouring word extends. Level k of the dictionary names every factor of m = 2^k
words; the names of level k + 1 are pairs of names of level k. A factor and its next occurrence that lie
within twice its length, so at most m apart, propose their distance as a period, and consecutive
starts with one distance are the arithmetic progressions of a run:

* Level k answers for periods up to m. In a run of period q <= m < 2q each factor that lies in
  the run one period before its end recurs q words later and no earlier, since its root is no power. So the
  run comes out as one progression, and ``power`` of 3 or more leaves it at least one start.
* A progression that is long enough has no smaller period: that would divide q and propose itself.

Progressions are extended to both sides as far as the period holds and told apart by start and period;
longer factors find a run again. A word or factor that occurs once in its text can't be in a longer factor
that recurs, so it leaves the dictionary, which for prose is empty after a few levels.

Many texts are worked on at once: words are numbered by text, so no factor joins two texts. Memory goes with
``WORDS`` words, or with the one text that has more. Each row is judged by itself, so nothing is shuffled
and repeated rows come out alike. A null or empty text has no words, no runs and an empty collapsed text.
Null ids pass through. An empty table gives no rows. Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words of the texts that are worked on at once.
WORDS = 400_000

Edit = Callable[[int | None, list[bytes]], list[bytes]]


def proposed(keys: np.ndarray, least: int, power: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Level by level, start, length and period of the progressions that are long enough."""
    at, name, m = np.arange(len(keys)), keys, 1
    while len(at) > 1:
        order = np.argsort(name, kind="stable")
        at, name = at[order], name[order]
        same = name[1:] == name[:-1]
        gap = at[1:] - at[:-1]
        near = np.flatnonzero(same & (gap <= m))
        if len(near):
            near = near[np.argsort(at[near])]
            start, step = at[near], gap[near]
            first = np.flatnonzero(np.concatenate([[True], (np.diff(start) != 1) | (np.diff(step) != 0)]))
            last = np.concatenate([first[1:], [len(near)]]) - 1
            period = step[first]
            length = start[last] - start[first] + period + m
            long = length >= np.maximum(least, power * period)
            yield start[first][long], length[long], period[long]
        recurs = np.zeros(len(at), bool)
        recurs[1:] |= same
        recurs[:-1] |= same
        rank = np.concatenate([[0], np.cumsum(~same)])
        names = np.full(len(keys) + m, -1)
        names[at[recurs]] = rank[recurs]
        at = np.sort(at[recurs])
        at = at[names[at + m] >= 0]
        name = names[at] * (rank[-1] + 1) + names[at + m]
        m *= 2


def runs_of(keys: np.ndarray, least: int = 6, power: int = 4) -> np.ndarray:
    """Start, length and period of every run of ``keys``, one row each, by start and then period."""
    parts = list(proposed(keys, least, power))
    if not parts:
        return np.empty((0, 3), np.int64)
    start, length, period = (np.concatenate(x) for x in zip(*parts))
    end, n = start + length, len(keys)
    while len(grow := np.flatnonzero((start > 0) & (keys[start - 1] == keys[start - 1 + period]))):
        start[grow] -= 1
    while len(grow := np.flatnonzero((end < n) & (keys[np.minimum(end, n - 1)] == keys[end - period]))):
        end[grow] += 1
    return np.unique(np.stack([start, period, end - start], axis=1), axis=0)[:, [0, 2, 1]]


def chunks(batches: Iterator[pa.RecordBatch], size: int, edit: Edit | None) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Ids and words of consecutive rows, until there are ``size`` words."""
    ids, words, total = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
            found = (text.as_py() or b"").split()  # on bytes, by space and \x09 to \x0d alone
            ids.append(doc_id)
            words.append(edit(doc_id, found) if edit else found)
            total += len(found)
            if total >= size:
                yield ids, words
                ids, words, total = [], [], 0
    if ids:
        yield ids, words


def collapsed_runs(texts: list[list[bytes]], least: int = 6, power: int = 4) -> Iterator[tuple[list[tuple[int, int, int]], bytes]]:
    """Per text its runs, and its words without those that a run holds after its first period."""
    sizes = np.array([len(x) for x in texts], np.int64)
    first = np.concatenate([[0], np.cumsum(sizes)])
    flat = pa.array([w for text in texts for w in text], pa.binary()).dictionary_encode()
    codes = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    keys = np.repeat(np.arange(len(texts)), sizes) * max(1, len(flat.dictionary)) + codes
    found = runs_of(keys, least, power)
    drop = np.zeros(len(keys) + 1, np.int64)
    np.add.at(drop, found[:, 0] + found[:, 2], 1)
    np.add.at(drop, found[:, 0] + found[:, 1], -1)
    kept = np.cumsum(drop)[:-1] == 0
    cuts = np.searchsorted(found[:, 0], first)
    for k, text in enumerate(texts):
        own = found[cuts[k] : cuts[k + 1]]
        if not len(own):
            yield [], b" ".join(text)
            continue
        stay = kept[first[k] : first[k + 1]].tolist()
        yield (own - [first[k], 0, 0]).tolist(), b" ".join([w for w, s in zip(text, stay) if s])


RUN = T.StructType([T.StructField(x, T.LongType()) for x in ("start", "length", "period")])


def periodic_runs(docs: DataFrame, least: int = 6, power: int = 4, id_col: str = "doc_id", text_col: str = "text", edit: Edit | None = None) -> DataFrame:
    """Per row ``doc_id``, ``runs`` (array of start, length, period in words, by start and period) and ``collapsed`` text.

    ``edit`` may change a row's words, given its id, before runs are looked for.
    """
    if power < 3:
        raise ValueError("runs of fewer than three periods need not show as one progression")
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])
    run = pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "period")]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, words in chunks(batches, WORDS, edit):
            found = list(collapsed_runs(words, least, power))
            runs = [[dict(zip(("start", "length", "period"), r)) for r in own] for own, _ in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(runs, run), pa.array([c for _, c in found], pa.binary()).cast(pa.string())], ["doc_id", "runs", "collapsed"]
            )

    wanted = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return wanted.mapInArrow(work, schema)


def longest(runs: str = "runs") -> Column:
    """The run of greatest length; of equal ones that with the smallest start, then period. Null without runs."""
    return F.array_min(F.transform(F.col(runs), lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length"))))
