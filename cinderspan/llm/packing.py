"""Best-fit packing: a configuration linear program over the histogram of piece lengths.

1. Documents are tokenized and cut: a longer one than ``capacity`` into pieces of ``capacity``
   tokens, of which the first may be shorter. Pieces and their counts per length are made by
   Spark; the histogram has ``capacity`` entries at most, whatever the corpus.
2. On that histogram the driver solves the configuration program: cover every length's count
   by configurations (multisets of lengths that fit) with the fewest sequences. Each length has
   a weight, its price, which is kept over the turns. In a turn a knapsack dynamic program, with no
   length oftener than it occurs, prices the best fill of every room; as many sequences as the bound
   allows start with the longest pieces and take the best fill of what room is left. Every weight is then
   multiplied by exp(-``rate`` * (share of the length's count that the turn covered - 1)). The
   average over the turns after the first ``settle`` is a fractional solution. Prices divided
   by the best configuration's worth are a dual solution, so the best of their totals bounds
   every packing from below.
3. Rounding: configurations are taken in order of their average use, each as often as that, rounded, but
   once at least and no oftener than pieces are left for, until half of the sequences that the
   pieces need are made. What is left is the same program with smaller counts: the weights go on from
   where they are for a few turns, and their new average is rounded, and so on to the last piece. So every
   sequence but those that one full piece fills is a configuration of some average, in a corpus of a hundred
   documents as in a large one. ``value`` is the number of sequences of a fractional cover that is put
   together alike without rounding.
4. Pieces are numbered within their length (per salt, with offsets from counts, so no length
   needs one task), and a piece's number and length give its configuration, copy and place. A
   (length, salt) group has about ``per_salt`` rows times the length's share of all pieces, so no
   more than ``per_salt`` or so even if all pieces are of one length.

Averages are over at most ``turns`` turns, each of one configuration for each length that sequences start
with, and counts halve from one average to the next, so the plan grows with the logarithm of the corpus; it is what
is broadcast.

A null text is empty. Every document ends with ``end_id``, so an empty one is a piece of one
token. Rows with a null or repeated id are pieces of their own. A text of any length is cut into
pieces within its row; a run of blanks too long for the pattern's matcher is split off where the pattern
would split it. An empty table gives no rows. Only the two named columns are read, so
other columns cannot clash.
"""

from __future__ import annotations

import base64
import bisect
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zlib
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderspan.llm.arrow import texts
from cinderspan.session import cut


def byte_bpe(path: str, pattern: str, special: dict[str, int]):
    """An encoder for a vocabulary of ranks; texts of special tokens give their ids."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)


def public_byte_bpe():
    """The public byte-level vocabulary of 50,257 ids; equal to its tokenizers file id by id."""
    import public_tokenizers

    return byte_bpe(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, {"<|endoftext|>": 50256})


#: Characters that the pattern's matcher takes as blank, in runs that are near the end of its stack.
BLANKS = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{100000,}")


def encoded(coder, text: str) -> list[int]:
    """Ids of ``text``. A very long run of blanks goes to the merges as the one word that the pattern makes of it.

    That is all of it but its last blank, which goes with what follows, or all of it where the text or its part before a special token ends.
    """
    out, at = [], 0
    for run in BLANKS.finditer(text):
        ends = run.end() == len(text) or any(text.startswith(x, run.end()) for x in coder.special_tokens_set)
        out += coder.encode(text[at : run.start()], allowed_special="all")
        at = run.end() - (not ends)
        out += coder._encode_single_piece(text[run.start() : at])
    return out + coder.encode(text[at:], allowed_special="all") if at else coder.encode(text, allowed_special="all")


def pieces(docs: DataFrame, encoder=public_byte_bpe, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32`` (and ``ids``)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder()
        for batch in batches:
            out: dict[str, list] = {x: [] for x in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
            for doc_id, text in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
                ids = np.array([*encoded(coder, text), end_id], "<u4")
                first = len(ids) % capacity or capacity
                starts = [0, *range(first, len(ids), capacity)]
                for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                    out["doc_id"].append(doc_id)
                    out["piece"].append(k)
                    out["start"].append(a)
                    out["length"].append(b - a)
                    out["ids_crc32"].append(zlib.crc32(ids[a:b].tobytes()))
                    if with_ids:
                        out["ids"].append(ids[a:b].astype(np.int32))
            kinds = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64()}
            columns = {k: pa.array(out[k], kind) for k, kind in kinds.items()}
            if with_ids:
                columns["ids"] = pa.array(out["ids"], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    wanted = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return wanted.mapInArrow(work, "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)


@dataclass
class Plan:
    """Configurations with the number of sequences of each; ``items`` are lengths in order.

    ``value`` and ``bound`` are those of the fractional solution and of the best dual one; ``averages`` has
    all configurations of the averages that were rounded.
    """

    capacity: int
    configs: list[tuple[int, ...]] = field(default_factory=list)
    uses: list[int] = field(default_factory=list)
    value: float = 0.0
    bound: float = 0.0
    averages: set[tuple[int, ...]] = field(default_factory=set)

    def add(self, items: tuple[int, ...], uses: int) -> None:
        if uses:
            self.configs.append(items)
            self.uses.append(uses)

    def slots(self) -> dict[int, np.ndarray]:
        """Per length, one column for each configuration that holds it: running count, first sequence, uses, offset of the first copy."""
        out: dict[int, list[tuple[int, int, int, int]]] = {}
        base = 0
        for items, uses in zip(self.configs, self.uses):
            at = 0
            for length in dict.fromkeys(items):
                copies = items.count(length)
                out.setdefault(length, []).append((copies * uses, base, uses, at))
                at += copies * length
            base += uses
        found = {k: np.array(v, np.int64).T for k, v in out.items()}
        for table in found.values():
            np.cumsum(table[0], out=table[0])
        return found


class Fills:
    """The knapsack program: the most valuable fill of every room, with no length oftener than its count."""

    def __init__(self, values: np.ndarray, counts: np.ndarray, room: int):
        # A length's copies in powers of two: any number up to the count is a sum of some.
        self.items = [(length, k) for length in np.flatnonzero(counts[: room + 1] > 0).tolist() for k in powers(int(min(counts[length], room // length)))]
        self.best = best = np.zeros(room + 1)
        self.choice = np.zeros((len(self.items), room + 1), bool)
        for chosen, (length, k) in zip(self.choice, self.items):
            size = length * k
            gain = best[: room + 1 - size] + values[length] * k
            np.greater(gain, best[size:], out=chosen[size:])
            np.maximum(gain, best[size:], out=best[size:])

    def taken(self, rooms: np.ndarray) -> np.ndarray:
        """Which items (rows) fill each of ``rooms`` (columns)."""
        left, out = rooms.copy(), np.zeros((len(self.items), len(rooms)), bool)
        for k in range(len(self.items) - 1, -1, -1):
            out[k] = self.choice[k][left]
            left -= out[k] * (self.items[k][0] * self.items[k][1])
        return out


def powers(n: int) -> list[int]:
    """Powers of two and a rest that add up to n."""
    out, k = [], 1
    while n:
        out.append(min(k, n))
        n -= out[-1]
        k *= 2
    return out


def averaged(need: np.ndarray, weight: np.ndarray, turns: int, settle: int, rate: float) -> tuple[dict[tuple[int, ...], float], np.ndarray, float]:
    """Uses of configurations on average over turns of multiplicative weights, the weights, and the best dual bound.

    ``need`` and ``weight`` are a count and a price per length, up to the capacity.
    """
    capacity = len(need) - 1
    lengths, counts = np.flatnonzero(need > 0), np.ceil(need)
    longer = np.cumsum(need[::-1])[::-1] - need
    used: dict[tuple[int, ...], float] = {}
    bound = 0.0
    for turn in range(turns):
        if turn % 20 == 0:
            best = Fills(weight, counts, capacity).best
            bound = max(bound, float((need * weight).sum() / (weight[lengths] + best[capacity - lengths]).max()))
            starts = np.clip(bound - longer, 0, need)
            own = np.flatnonzero(starts)
        fills = Fills(weight, counts, capacity - int(own[0]))
        taken = fills.taken(capacity - own)
        now = starts.copy()
        for (length, k), n in zip(fills.items, (taken * starts[own]).sum(axis=1).tolist()):
            now[length] += k * n
        weight = weight * np.exp(-rate * (np.divide(now, need, out=np.ones(len(need)), where=need > 0) - 1))
        weight /= weight.max()
        if turn >= settle:
            column, item = np.nonzero(taken.T)
            cuts, item = np.searchsorted(column, np.arange(len(own) + 1)), item.tolist()
            for j, first in enumerate(own.tolist()):
                items = [first]
                for i in item[cuts[j] : cuts[j + 1]]:
                    length, k = fills.items[i]
                    items += [length] * min(k, int(counts[length]) - items.count(length))
                key = tuple(sorted(items, reverse=True))
                used[key] = used.get(key, 0.0) + starts[first] / (turns - settle)
    return used, weight, bound


def peeled(used: dict[tuple[int, ...], float], rest: np.ndarray, most: float, whole: bool) -> list[tuple[tuple[int, ...], float]]:
    """Configurations by their use, as often as ``rest`` allows, which falls; ``whole`` rounds, once at least, up to ``most`` sequences."""
    out, made = [], 0.0
    for items, uses in sorted(used.items(), key=lambda x: (-x[1], -sum(x[0]), x[0])):
        lengths, copies = np.unique(items, return_counts=True)
        uses = min(max(1.0, round(uses)) if whole else uses, (rest[lengths] // copies if whole else rest[lengths] / copies).min())
        if uses > 0:
            out.append((items, uses))
            rest[lengths] -= uses * copies
            made += uses
            if made >= most:
                break
    return out


def solve(histogram: dict[int, int], capacity: int, turns: int = 120, settle: int = 80, rate: float = 0.01, later: int = 20) -> Plan:
    """Configurations that hold every piece of ``histogram`` (length to count)."""
    plan = Plan(capacity)
    full = histogram.get(capacity, 0)
    plan.add((capacity,), full)
    need = np.zeros(capacity + 1)
    for length, count in histogram.items():
        if length < capacity:
            need[length] = count
    plan.value = plan.bound = full
    if not need.any():
        return plan
    sizes = np.arange(capacity + 1) / capacity
    used, weight, bound = averaged(need, np.where(need > 0, sizes, 0.0), turns, settle, rate)
    plan.bound += bound
    rest, left, price = need.copy(), need.copy(), weight
    # The fractional cover: averages without rounding, and a last few pieces best-fit in thousandths.
    part = used
    for _ in range(3):
        plan.value += sum(n for _, n in peeled(part, left, np.inf, False))
        left[left < 1e-9] = 0
        if not left.any():
            break
        part, price, _ = averaged(left, np.where(left > 0, np.maximum(price, 1e-12), 0.0), later, later // 2, 2 * rate)
    gaps = {int(x): int(np.ceil(left[x] * 1000)) for x in np.flatnonzero(left)}
    plan.value += sum(n for _, n in best_fit(gaps, capacity)) / 1000
    while True:
        plan.averages |= used.keys()
        for items, uses in peeled(used, rest, max(1.0, 0.5 * (rest * sizes).sum()), True):
            plan.add(items, int(uses))
        if not rest.any():
            return plan
        used, weight, _ = averaged(rest, np.where(rest > 0, np.maximum(weight, 1e-12), 0.0), later, later // 2, 2 * rate)


def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over a histogram; bins with equal contents are one entry with a count."""
    bins: dict[int, list[list]] = {}
    rooms: list[int] = []
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                items, count = bins[room].pop()
                if not bins[room]:
                    rooms.pop(at)
                    del bins[room]
                fill = min(room // length, max(1, left // count)) if left >= count else 1
                used = min(count, left // fill) or 1
                if used < count:
                    bins.setdefault(room, []).append([items, count - used])
                    if room not in rooms:
                        bisect.insort(rooms, room)
            else:
                room, items = capacity, ()
                fill = min(capacity // length, left)
                used = max(1, left // fill)
            left -= fill * used
            rest = room - fill * length
            bins.setdefault(rest, []).append([(*items, *[length] * fill), used])
            if rest not in rooms:
                bisect.insort(rooms, rest)
    return [(tuple(items), count) for stacked in bins.values() for items, count in stacked]


def best_fit_packing(docs: DataFrame, encoder=public_byte_bpe, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", per_salt: int = 20_000) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    made = cut(pieces(docs, encoder, capacity, end_id, id_col, text_col), "pack-pieces")
    histogram = {r.length: r.n for r in made.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = solve(histogram, capacity)
    slots = made.sparkSession.sparkContext.broadcast(plan.slots())
    salts = max(1, sum(histogram.values()) // per_salt)
    salted = made.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    # Counts by length and salt give each salt's first number; one row for each of them.
    counts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    offsets = counts.select("length", "salt", F.expr("sum(n) OVER (PARTITION BY length ORDER BY salt) - n").alias("before"))
    numbered = salted.withColumn("own", F.expr("row_number() OVER (PARTITION BY length, salt ORDER BY doc_id, piece, ids_crc32)")).join(offsets, ["length", "salt"])
    numbered = numbered.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("own") - 1).alias("number"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, numbers = (batch.column(c).to_numpy() for c in ("length", "number"))
            sequences, offsets_ = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                ends, base, uses, at = slots.value[int(length)]
                k = np.searchsorted(ends, numbers[rows], side="right")
                own = numbers[rows] - np.where(k > 0, ends[k - 1], 0)
                sequences[rows] = base[k] + own % uses[k]
                offsets_[rows] = at[k] + own // uses[k] * length
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), pa.array(sequences, pa.int64()), pa.array(offsets_, pa.int64())], [*names, "sequence_id", "offset"])

    return numbered.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
