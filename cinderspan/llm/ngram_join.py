"""N-gram Jaccard join: all links between texts whose word-shingle sets are alike enough.

A text is lower-cased (A-Z only) and split at ASCII white space. Its set holds its distinct
``n``-word shingles; a shorter text counts as one shingle; a text without words has an empty
set and no links. Shingles are 62-bit hashes of 64-bit word hashes.

Plan:

1. Prefix filter: under any one global order, two sets that link share a shingle among the
   first ``len - ceil(t * len) + 1`` of each. The order used here is: shingles of the lower
   part of the hash range that only one text has, then all others. So a text with enough lone
   shingles in that part has no links. Only that part is shuffled; the rest of the corpus's
   shingles never is. What remains are candidates, usually a small share of the texts.
2. Candidates are counted again among themselves, over all their shingles, and ordered by
   rising number of texts. Shingles of shared passages and common phrases so come last, and
   prefixes hold what a family of near copies has alone. Sizes fall into classes of the
   threshold's ratio, so linked sets are of one class or of neighbouring ones. Under a prefix
   shingle the texts of a class are tied to its smallest id, and that to the next class's; tied
   texts form groups (connected components), so each candidate is shipped to one group. Counts
   and smallest ids are combined before the shuffle, so no shingle needs one task.
3. A group of more than ``block`` texts is thinned by pivots. All texts are compared
   with one pivot; those that link to it are one component and need no comparison with each
   other. Jaccard distance is a metric, so among the others only those within twice the
   link distance of the pivot can link to them: these are joined in blocks. The rest goes on
   to the next round, and what is large after all rounds is joined block by block.
4. A group is joined by a prefix tree over its sets, ordered by hash. Each set walks the tree, sharing
   the overlap of a common path, and leaves a subtree as soon as the overlap so far plus what
   remains on both sides cannot reach the threshold. Pairs that are linked already are
   skipped, so a group emits a spanning forest of its links.

   What stays large after all rounds is split into n blocks of ``block`` texts that are joined
   pair by pair, so each set is sent n times: that costs the square of such a group's size. It
   takes texts that share rare shingles with each other and still are far from every pivot.

Null ids are returned without a component. Rows with one id count as one text for linking.
Empty input gives empty output. Texts of any length are cut into shingles whole. Only the two
named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderspan.llm.arrow import flat_lists, groups, texts
from cinderspan.operators.components import connected_components
from cinderspan.session import cut

LOW = np.uint64((1 << 62) - 1)
K = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, n: int = 5) -> np.ndarray:
    """The distinct shingle hashes of ``text`` in ascending order (int64)."""
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.int64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(n, len(words))
    stop = len(words) - width + 1
    total = np.full(stop, width, np.uint64)
    for k in range(width):
        total += h[k : stop + k] * np.uint64(pow(K, k + 1, 1 << 64))
    found = np.sort(_mix(total) & LOW).view(np.int64)
    return found[np.concatenate([[True], found[1:] != found[:-1]])]


def trie_links(sets: list[np.ndarray], labels: list[int], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between ``sets`` (ascending int64 arrays, positions as nodes).

    Equal ``labels`` mark sets that are one component already.
    """
    order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">i8").tobytes())
    arrays = [sets[i] for i in order]
    sizes = np.array([len(a) for a in arrays])
    root = np.array([labels[i] for i in order])
    # Length of the path that neighbours share; inner nodes of the tree are its minima.
    common = np.zeros(len(arrays), np.int64)
    for i in range(1, len(arrays)):
        k = min(sizes[i - 1], sizes[i])
        differ = np.flatnonzero(arrays[i - 1][:k] != arrays[i][:k])
        common[i] = differ[0] if len(differ) else k
    tree: dict[tuple[int, int, int], tuple[int, list[tuple[int, int, int]]]] = {}

    def node(lo: int, hi: int, depth: int) -> tuple[int, list[tuple[int, int, int]]]:
        """Where the sets that end at this node stop, and the subtrees (from, to, depth) below it."""
        if (lo, hi, depth) not in tree:
            first = lo + int(np.count_nonzero(sizes[lo:hi] == depth))
            cuts = [first, *(first + 1 + np.flatnonzero(common[first + 1 : hi] <= depth)).tolist(), hi] if first < hi else []
            tree[lo, hi, depth] = first, [(a, b, int(sizes[a] if b - a == 1 else common[a + 1 : b].min())) for a, b in zip(cuts, cuts[1:])]
        return tree[lo, hi, depth]

    links = []
    for i, x in enumerate(arrays):
        stack = [(0, len(arrays), 0, 0, 0)] if len(x) else []
        while stack:
            lo, hi, depth, shared, at = stack.pop()
            first, below = node(lo, hi, depth)
            for j in range(max(lo, i + 1), first):
                if depth and root[j] != root[i] and (100 + percent) * shared >= percent * (len(x) + depth):
                    links.append((order[i], order[j]))
                    root[root == root[j]] = root[i]
            for a, b, end in below:
                if b <= i + 1 or (root[max(a, i + 1) : b] == root[i]).all():
                    continue
                path = arrays[a][depth:end]
                found = np.searchsorted(x, path)
                hits = x[np.minimum(found, len(x) - 1)] == path
                overlap, reached = shared + int(np.count_nonzero(hits)), int(found[-1]) + int(hits[-1])
                rest = min(len(x) - reached, int(sizes[a:b].max()) - end)
                if (100 + percent) * (overlap + rest) >= percent * (len(x) + int(sizes[a:b].min())):
                    stack.append((a, b, end, overlap, reached))
    return links


def _similar(inter, a, b, percent: int):
    return (100 + percent) * inter >= percent * (a + b)


def _thinned(large: DataFrame, block: int, rounds: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links to pivots, and blocks (``gid, node, label, keys``) that hold all other possible links.

    ``large`` has ``gid, node, keys`` and only groups of more than ``block`` rows. ``label``
    is equal where rows of a block are one component already.
    """
    links, blocks, rest = [], [], large
    salt = F.xxhash64("node")
    for k in range(rounds):
        pivots = rest.groupBy("gid").agg(F.min_by(F.struct(F.col("node").alias("pivot"), F.col("keys").alias("pivot_keys")), F.xxhash64("node", F.lit(k))).alias("p")).select("gid", "p.*")
        inter = F.size(F.array_intersect("keys", "pivot_keys"))
        a, b = F.size("keys"), F.size("pivot_keys")
        scored = cut(
            rest.join(pivots, "gid").select(
                "gid", "node", "keys", "pivot",
                F.when(_similar(inter, a, b, percent), "near").when(_similar(inter, a, b, max(0, 2 * percent - 100)), "mid").otherwise("far").alias("place"),
            ),
            "njoin-scored",
        )
        links.append(scored.where("place = 'near' AND node <> pivot").select(F.col("node").alias("src"), F.col("pivot").alias("dst")))
        # Written, as a row per group: the plans that follow then join two tables, however many rounds there were.
        sizes = cut(
            scored.groupBy("gid").agg(*(F.ceil(F.count_if(F.col("place") == x) / block).cast("int").alias(x) for x in ("near", "mid")), F.count_if(F.col("place") != "near").alias("left")),
            "njoin-sizes",
        )
        placed = scored.join(sizes, "gid")
        gid = lambda near, mid: F.concat_ws("/", "gid", F.lit(f"p{k}"), near.cast("string"), mid.cast("string"))
        own_near, own_mid = (F.pmod(salt, F.greatest(F.col(x), F.lit(1))) for x in ("near", "mid"))
        none = F.expr("cast(array() AS array<string>)")
        crossed = (
            F.when(F.expr("place = 'near' AND mid > 0"), F.transform(F.expr("sequence(0, mid - 1)"), lambda m: gid(own_near, m)))
            .when(F.expr("place = 'mid' AND near > 0"), F.transform(F.expr("sequence(0, near - 1)"), lambda m: gid(m, own_mid)))
            .otherwise(none)
        )
        left = F.concat_ws("/", "gid", F.lit(f"r{k}"))
        last = F.when((F.col("place") != "near") & (F.col("left") <= block), F.array(left)).otherwise(none)
        label = F.when(F.col("place") == "near", F.col("pivot")).otherwise(F.col("node"))
        blocks.append(placed.select(F.explode(F.concat(crossed, last)).alias("gid"), "node", label.alias("label"), "keys"))
        rest = placed.where((F.col("place") != "near") & (F.col("left") > block)).select(left.alias("gid"), "node", "keys")
        if sizes.where(F.col("left") > block).isEmpty():
            break
    else:
        n = rest.groupBy("gid").agg(F.ceil(F.count("*") / block).cast("int").alias("n"))
        split = rest.join(n, "gid").withColumn("own", F.pmod(salt, "n")).withColumn("other", F.explode(F.expr("sequence(0, n - 1)")))
        pair = F.concat_ws("/", "gid", F.least("own", "other").cast("string"), F.greatest("own", "other").cast("string"))
        blocks.append(split.select(pair.alias("gid"), "node", F.col("node").alias("label"), "keys"))
    union = lambda parts: parts[0] if len(parts) == 1 else union([parts[0].unionByName(parts[1]), *parts[2:]])
    return union(links), union(blocks)


def ngram_jaccard_join(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = 5,
    percent: int = 75,
    low: float = 0.4,
    block: int = 256,
    rounds: int = 6,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id``.

    ``component_id`` is the smallest id reachable by links, itself included; two texts link
    when 100 * intersection >= ``percent`` * union. Ids must cast to bigint. ``low`` is the
    part of the hash range whose shingles are counted over all texts, ``block`` the most texts
    that are joined at once; neither changes the result.
    """
    docs = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    bound = int(low * (1 << 62))

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests = [], []
            for text in texts(batch.column(1)):
                found = shingles(text, n)
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()))
            keys = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys[:, 0].copy()), pa.array(keys[:, 1].copy())], ["doc_id", "n_shingles", "hi", "lo"]
            )

    def low_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()  # a set that this task has met adds nothing under its digest
        for batch in batches:
            keys, lows = [], []
            for text in texts(batch.column(0)):
                found = shingles(text, n)
                digest = xxhash.xxh3_128_digest(found.tobytes())
                if digest not in seen:
                    if len(seen) >= 500_000:
                        seen.clear()
                    seen.add(digest)
                    lows.append(found[: np.searchsorted(found, bound)])
                    keys.append(int.from_bytes(digest[:8], "big", signed=True))
            sizes = list(map(len, lows))
            tokens = np.concatenate(lows) if lows else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(keys, np.int64), sizes)), pa.array(tokens)], ["hi", "token"])

    # Equal sets share a digest and stand under the smallest id that has it.
    profiles = cut(docs.mapInArrow(profile, "doc_id long, n_shingles long, hi long, lo long"), "njoin-profiles")
    reps = profiles.where("doc_id IS NOT NULL AND n_shingles > 0").groupBy("hi", "lo").agg(F.min("doc_id").alias("node"), F.max("n_shingles").alias("size"))
    tokens = docs.where("doc_id IS NOT NULL").select("text").mapInArrow(low_shingles, "hi long, token long")
    # A shingle is lone where the smallest and the largest digest that hold it are one.
    ends = tokens.groupBy("token").agg(F.min("hi").alias("hi"), F.max("hi").alias("last")).where("hi = last")
    lone = ends.groupBy("hi").agg(F.count("*").alias("n_lone"))
    need = F.expr(f"size - cast(ceil({percent} * size / 100) AS bigint) + 1")
    suspects = cut(reps.join(lone, "hi", "left").withColumn("need", need).where("coalesce(n_lone, 0) < need").select("node", "need", "size"), "njoin-suspects")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = flat_lists([shingles(text, n) for text in texts(batch.column("text"))], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("node"), found], ["node", "keys"])

    # Suspects grow with the corpus, so neither side of this join is ever broadcast.
    wanted = docs.join(suspects.select("node").hint("merge"), docs.doc_id == F.col("node"))
    candidates = cut(wanted.select("node", "text").mapInArrow(sets, "node long, keys array<long>"), "njoin-sets")
    held = candidates.select("node", F.explode("keys").alias("token"))
    often = held.groupBy("token").agg(F.count("*").alias("texts")).where("texts > 1")
    ranked = held.join(often, "token").join(suspects, "node").select(
        "node", "need", "size", "token",
        F.expr("row_number() OVER (PARTITION BY node ORDER BY texts, token)").alias("place"),
        F.expr("size - count(*) OVER (PARTITION BY node)").alias("alone"),
    )
    # A class is a whisker wider than the ratio, so rounding cannot put linked sizes two classes apart.
    grade = F.floor(F.log(F.col("size").cast("double")) / (math.log(100 / percent) * (1 + 1e-9))).alias("grade")
    prefixes = cut(ranked.where("place + alone <= need").select("node", "token", grade), "njoin-prefixes")
    hubs = prefixes.groupBy("token", "grade").agg(F.min("node").alias("hub"))
    above = hubs.select("token", (F.col("grade") - 1).alias("grade"), F.col("hub").alias("other"))
    tied = prefixes.join(hubs, ["token", "grade"]).select("node", F.col("hub").alias("other"))
    partners = tied.unionByName(hubs.join(above, ["token", "grade"]).select(F.col("hub").alias("node"), "other")).where("node <> other").distinct()
    coarse = cut(connected_components(partners, "node", "other"), "njoin-coarse")
    sizes = coarse.groupBy("component").agg(F.count("*").alias("texts"))
    grouped = candidates.join(coarse.join(sizes, "component"), "node").select(F.col("component").cast("string").alias("gid"), "node", "keys", "texts")
    blocks = grouped.where(F.col("texts") <= block).select("gid", "node", F.col("node").alias("label"), "keys")
    links = None
    if not sizes.where(F.col("texts") > block).isEmpty():
        links, others = _thinned(grouped.where(F.col("texts") > block).select("gid", "node", "keys"), block, rounds, percent)
        blocks = blocks.unionByName(others)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, "gid"):
            nodes = group.column("node").to_pylist()
            sets = [np.asarray(x.values) for x in group.column("keys")]
            found = trie_links(sets, group.column("label").to_pylist(), percent)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([nodes[x] for x, _ in found], pa.int64()), pa.array([nodes[y] for _, y in found], pa.int64())], ["src", "dst"])

    joined = blocks.repartition("gid").sortWithinPartitions("gid").mapInArrow(join, "src long, dst long")
    links = joined if links is None else links.unionByName(joined)
    fine = connected_components(links)
    # A node stands for its digest; ids fold into the smallest id of the component.
    named = profiles.join(reps.select("hi", "lo", "node"), ["hi", "lo"], "left").join(fine, "node", "left")
    named = named.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("component", "node")).alias("c"))
    return named.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("c", "doc_id")).alias("component_id"))
