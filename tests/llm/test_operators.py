"""The ten operators against brute force, round trips and edge cases."""

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cinderspan.llm import fingerprints, license_scan, lm_scores, ngram_join, packing, piece_tokens, queries, quality_classifier, quality_rules, substring_dedup, warc

SF = "/root/testdata/sf0.001"
PASSAGE = " ".join(f"word{i}x{i * 7 % 13}" for i in range(60))
LONG = " ".join(f"t{i * 31 % 997}" for i in range(20_000))
ROWS = [
    (1, None, "en"), (2, "", "en"), (3, "  \t\n ", None), (4, "one", "fr"), (5, "One", "fr"),
    (6, f"alpha beta gamma {PASSAGE} delta epsilon zeta", "en"), (7, f"quite other words before {PASSAGE} and other words after it", "xx"),
    (8, LONG, "en"), (9, LONG + " end", "en"), (10, "é" * 40 + " 中文 😀", "de"), (11, "a b c d e f g h", "en"), (11, "a b c d e f g h", "en"), (None, "no id here", "en"), (None, None, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, lang string").withColumn("score", F.lit("clash")).withColumn("spans", F.lit(1)).withColumn("n_words", F.lit("x"))


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute_components(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            inter = len(sets[i] & sets[j])
            if inter and 100 * inter >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                up[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("block", [2, 256])
def test_ngram_join(docs, real, block):
    for df in (docs.where("doc_id is not null"), real):
        rows = {r.doc_id: r.text for r in df.collect()}
        found = ngram_join.ngram_jaccard_join(df, block=block, rounds=2).collect()
        assert len(found) == df.count()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components(rows.items())


def test_ngram_join_nulls_and_empty(docs):
    assert {r.component_id for r in ngram_join.ngram_jaccard_join(docs.where("doc_id is null")).collect()} == {None}
    assert ngram_join.ngram_jaccard_join(docs.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    found = con.execute(queries.oracle_sql()[name])
    names, wanted = [c[0] for c in found.description], found.fetchall()
    df = queries.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(names) and wanted
    assert Counter(tuple(r) for r in df.select(*names).collect()) == Counter(wanted)


def test_trie_links_match_all_pairs():
    rng = np.random.default_rng(5)
    base = np.unique(rng.integers(0, 10_000, 60))
    sets = [np.unique(np.concatenate([rng.choice(base, 50, replace=False), rng.integers(0, 10_000, rng.integers(0, 20))])) for _ in range(40)] + [base, base]
    links = ngram_join.trie_links(sets, list(range(len(sets))), 75)
    rows = {i: set(s.tolist()) for i, s in enumerate(sets)}
    for a, b in links:
        assert 100 * len(rows[a] & rows[b]) >= 75 * len(rows[a] | rows[b])
    joined = {i: {i} for i in rows}
    for a, b in links:
        both = joined[a] | joined[b]
        for x in both:
            joined[x] = both
    for a in rows:
        for b in rows:
            if 100 * len(rows[a] & rows[b]) >= 75 * len(rows[a] | rows[b]):
                assert b in joined[a]


def test_substring_dedup(docs):
    out = {r.doc_id: r for r in substring_dedup.substring_dedup(docs).where("doc_id is not null").collect()}
    assert out[6].text == ROWS[5][1] and out[6].n_passages == 1
    assert out[7].removed_bytes > 200 and out[7].text.startswith("quite other words before") and out[7].text.endswith("words after it")
    assert out[1].text is None and out[4].text == "one" and out[9].removed_bytes > 0.9 * len(LONG)
    assert substring_dedup.substring_dedup(docs.limit(0)).count() == 0


def test_substring_dedup_keeps_what_does_not_repeat_under_a_repeated_id(spark):
    own = " ".join(f"own{i * 17 % 9001}" for i in range(300))
    rows = [(1, PASSAGE), (5, "q " + PASSAGE), (5, own), (5, own), (None, PASSAGE), (7, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"_id": F.lit(1), "a.b": F.lit("x"), "tag": F.lit(2), "row": F.lit(3)})
    out = substring_dedup.substring_dedup(df).collect()
    assert Counter((r.doc_id, r.text, r["_id"], r["a.b"], r.tag) for r in out if r.text != "q ") == Counter((i, t, 1, "x", 2) for i, t in rows if t != "q " + PASSAGE)
    assert [(r.doc_id, r.text.strip(), r.first_doc_ids) for r in out if r.removed_bytes] == [(5, "q", [1])]


def brute_chunks(rows):
    """(id, text) to the spans of its repeated chunks, and whether each is the first occurrence in the smallest id."""
    held, out = defaultdict(list), defaultdict(set)
    for i, text in rows:
        data = (text or "").encode()
        ends = substring_dedup.chunk_ends(data)
        for a, b in zip([0, *ends], ends):
            held[data[a:b]].append((i, a, b))
    for places in held.values():
        for place in places if len(places) > 1 else ():
            out[place[0]].add((*place[1:], place == min(places)))
    return out


def test_repeated_chunks_match_brute_force(real):
    tag = substring_dedup.row_tag(real, "doc_id", "text")
    found = {r.doc_id: {(s.start, s.end, s.kept) for s in r.spans} for r in substring_dedup.repeated_chunks(real, tag).collect()}
    assert found == brute_chunks([(r.doc_id, r.text) for r in real.collect()]) and found


def test_chunks_cover_text_and_resist_shifts():
    data = LONG.encode()
    ends = substring_dedup.chunk_ends(data)
    assert ends[-1] == len(data) and all(b - a <= substring_dedup.MOST for a, b in zip([0, *ends], ends))
    cut_up = lambda d: {d[a:b] for a, b in zip([0, *substring_dedup.chunk_ends(d)], substring_dedup.chunk_ends(d))}
    assert len(cut_up(data) & cut_up(b"shift " + data)) > 0.9 * len(cut_up(data))
    h = substring_dedup.gear_hashes(np.frombuffer(data[:500], np.uint8))
    rolled = 0
    for k, byte in enumerate(data[:500]):
        rolled = ((rolled << 1) + int(substring_dedup.GEAR[byte])) % (1 << 32)
        assert rolled == h[k]


def test_piece_tokens(docs, real):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=piece_tokens.piece_model())
    for df in (docs, real):
        texts = Counter()
        for r in df.collect():
            ids = model.encode(r.text or "", add_eos=True)
            texts[r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(model.decode(ids).encode()).hexdigest()] += 1
        assert Counter(tuple(r) for r in piece_tokens.piece_tokens(df).collect()) == texts


def test_warc_round_trip(spark):
    pages = spark.createDataFrame([(1, "u1", "same"), (2, "u2", "same"), (3, None, None), (4, "u\n4", ""), (5, "u5", "é" * 99), (None, "u6", "same")], "page_id long, url string, html string")
    found = {r.page_id: r for r in warc.read_records(warc.write_archives(pages), with_payload=True).collect()}
    assert found[1].record_type == "revisit" and found[1].refers_to == 2 and found[1].payload is None and found[1].payload_bytes == 4
    assert found[3].refers_to == 4 and found[4].record_type == "response" and found[5].payload.decode() == "é" * 99
    assert found[None].record_type == "response"
    assert {r.record_type for r in warc.read_records(warc.write_archives(pages, least=5)).collect()} == {"response"}


def test_warc_of_the_table_and_of_repeated_rows(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
    rows += [(10_000 + i, u, h) for i, u, h in rows[:40]] + rows[:3] + [(None, "n", rows[0][2]), (20_000, "n", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"sha1": F.lit(1), "newest": F.lit(2), "file": F.lit(3), "a.b": F.lit(4)})
    index = warc.write_archives(df.repartition(5), archive_bytes=9_000)
    assert index.select("file").distinct().count() > 5
    newest = {}
    for i, _, h in rows:
        if i is not None:
            newest[h or ""] = max(i, newest.get(h or "", i))
    wanted = Counter()
    for i, _, h in rows:
        data = (h or "").encode()
        other = None if i is None or newest[h or ""] == i else newest[h or ""]
        wanted[i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if other is None else "revisit", other] += 1
    found = warc.read_records(index, most=4096).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found) == wanted
    assert len({r.record_id for r in found}) == len(rows)
    some = {r.page_id for r in warc.read_records(index.where("page_id % 7 = 0")).collect()}
    assert some == {i for i, *_ in rows if i is not None and i % 7 == 0}
    assert warc.read_records(warc.write_archives(df.limit(0))).count() == 0


def test_license_scan(spark):
    notice = license_scan.TEMPLATES["apache-2.0-notice"]
    df = spark.createDataFrame([(1, f"x y {notice} z {notice}"), (2, notice.replace("the ", "")), (3, "Licensed to nobody under the sun"), (4, None)], "doc_id long, text string")
    found = Counter((r.doc_id, r.license) for r in license_scan.license_scan(df).collect())
    assert found == {(1, "apache-2.0-notice"): 2, (2, "apache-2.0-notice"): 1}


def common_words(a, b):
    """Length of a longest common subsequence."""
    row = np.zeros(len(b) + 1, int)
    b = np.array(b, object)
    for w in a:
        step = np.concatenate([[0], np.maximum(row[1:], np.where(b == w, row[:-1] + 1, 0))])
        row = np.maximum.accumulate(step)
    return int(row[-1])


def test_whole_licenses_are_found_in_damaged_copies():
    whole = license_scan.whole_texts()
    assert len(whole) >= 14 and min(len(license_scan.words_of(t)) for t in whole.values()) > 80
    every = {k: license_scan.Template(v, 0.8) for k, v in whole.items()}
    rng = np.random.default_rng(1)
    filler = [f"filler{i}" for i in range(4000)]
    for name, text in whole.items():
        words, prepared = license_scan.words_of(text), {name: every[name]}
        exact = [f for f in license_scan.findings(" ".join(filler[:30] + words + filler[30:50]), prepared) if f[0] == name]
        assert exact == [(name, 1.0, 30, 30 + len(words))]
        # A word in twenty is lost, one in thirty is followed by another word.
        damaged = [x for w in words for x in ([w] if rng.random() > 0.05 else []) + (["other"] if rng.random() < 1 / 30 else [])]
        found = [f for f in license_scan.findings(" ".join(filler[:700] + damaged + filler[700:]), prepared) if f[0] == name]
        assert len(found) == 1 and 0.85 <= found[0][1] < 1 and abs(found[0][2] - 700) < 60 and abs(found[0][3] - 700 - len(damaged)) < 60
        # What is aligned is a common subsequence, so never more than the longest one, and here near it.
        if len(words) < 1700:
            assert found[0][1] * len(words) <= common_words(damaged, words) <= 1.03 * found[0][1] * len(words)
        half = words[: len(words) // 2]
        assert not [f for f in license_scan.findings(" ".join(filler[:20] + half), prepared) if f[0] == name]
    shuffled = " ".join(rng.permutation(license_scan.words_of(whole["MIT"])))
    assert license_scan.findings(shuffled, every) == []
    assert {f[0] for f in license_scan.findings(whole["GFDL-1.3"], every)} == {"GFDL-1.2", "GFDL-1.3"}


def test_license_findings_match_brute_force(spark):
    """Every stretch of small texts against every template: a finding where, and only where, the longest common subsequence covers enough."""
    rng = np.random.default_rng(7)
    templates = {"a": "one two three four five six seven eight nine ten", "b": "red green blue red white black"}
    rows = []
    for k in range(150):
        words = [f"w{i}" for i in rng.integers(0, 9, rng.integers(0, 12))]
        for _ in range(rng.integers(0, 3)):
            own = templates[rng.choice(["a", "b"])].split()
            kept = [w for w in own if rng.random() > rng.choice([0.0, 0.1, 0.4])]
            words += kept + [f"w{i}" for i in rng.integers(0, 9, rng.integers(1, 6))]
        rows.append((k, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("license", F.lit("clash"))
    got = Counter((r.doc_id, r.license) for r in license_scan.license_scan(df, templates).collect())
    for k, text in rows:
        words = text.split()
        for name, template in templates.items():
            own = template.split()
            best, at, n = 0, 0, 0
            while at < len(words):  # non-overlapping stretches from the left, each as short as it can be
                ends = [b for b in range(at + 1, len(words) + 1) if common_words(words[at:b], own) >= 0.8 * len(own)]
                if not ends:
                    break
                n, at = n + 1, ends[0]
            assert (got[k, name] > 0) == (n > 0) and got[k, name] <= n, (text, name)
    odd = spark.createDataFrame([(1, None), (None, ""), (2, "one two"), (3, " ".join(["w"] * 300_000) + " " + templates["a"]), (3, templates["a"]), (3, templates["a"])], "doc_id long, text string")
    assert Counter((r.doc_id, r.license, r.coverage) for r in license_scan.license_scan(odd, templates).collect()) == {(3, "a", 1.0): 3}
    assert license_scan.license_scan(odd.limit(0), templates).count() == 0


def plain_scores(rows, good):
    """Both losses of every row by a plain recount of real words and pairs."""
    plain = [(i, (t or "").encode().lower().split()) for i, t in rows]
    uni, bi, ctx = ([Counter(), Counter()] for _ in range(3))
    for i, w in plain:
        for m in range(1 + (i in good)):
            uni[m].update(w), bi[m].update(zip(w, w[1:])), ctx[m].update(w[:-1])
    size, total = len(uni[0]) + 1, sum(uni[1].values())
    scale = [total / max(1, sum(uni[0].values())), 1.0]

    def loss(w, m):
        own = [(scale[m] * uni[m][b] + lm_scores.ADD) / (total + lm_scores.ADD * size) for b in w]
        joint = [(scale[m] * bi[m][a, b] + lm_scores.PRIOR * p) / (scale[m] * ctx[m][a] + lm_scores.PRIOR) for a, b, p in zip(w, w[1:], own[1:])]
        return -np.mean(np.log([own[0], *joint]))

    return sorted((-1 if i is None else i, len(w), *([loss(w, 1), loss(w, 0), loss(w, 0) - loss(w, 1)] if w else [0, 0, 0])) for i, w in plain)


def scored_rows(found):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.target_loss or 0, r.background_loss or 0, r.score) for r in found)


def test_lm_scores_match_plain_counts(spark, docs, real, monkeypatch):
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1")
    good = {r.doc_id for r in labels.collect()}
    for most in (1 << 20, 0):  # flags broadcast, flags shuffled
        monkeypatch.setattr(lm_scores, "MOST_MARKED", most)
        found = lm_scores.lm_scores(real, labels).collect()
        np.testing.assert_allclose(scored_rows(found), plain_scores([(r.doc_id, r.text) for r in real.collect()], good), rtol=1e-9, atol=1e-12)
    found = lm_scores.lm_scores(docs.withColumn("_id", F.lit(1)), docs.where("doc_id = 11")).collect()
    np.testing.assert_allclose(scored_rows(found), plain_scores([r[:2] for r in ROWS], {11}), rtol=1e-9, atol=1e-12)
    assert {r.score for r in lm_scores.lm_scores(docs.where("text is null"), docs.select("doc_id")).collect()} == {0.0}
    assert {r.score for r in lm_scores.lm_scores(docs, docs.limit(0)).collect()} == {0.0}
    assert lm_scores.lm_scores(docs.limit(0), docs).count() == 0


def brute_fingerprint(text):
    """Minima of the window hashes by slot, from a plain power sum for each window."""
    p, codes = (1 << 31) - 1, [ord(c) for c in text]
    if not codes:
        return fingerprints.EMPTY
    width, least = min(fingerprints.WIDTH, max(1, len(codes) // 4)), {}
    for i in range(len(codes) - width + 1):
        h = 0
        for base in fingerprints.BASES:
            h = h << 31 | sum((c + 1) * pow(base, k, p) for k, c in enumerate(codes[i : i + width])) % p
        h = h * 0x9E3779B97F4A7C15 % (1 << 64)
        h = (h ^ h >> 32) * 0xD6E8FEB86659FD93 % (1 << 64)
        slot = h % fingerprints.SLOTS
        least[slot] = min(h, least.get(slot, h))
    return "".join(f"{least[k] >> 8 & 255:02x}" if k in least else ".." for k in range(fingerprints.SLOTS))


def test_fingerprints(real, docs, spark):
    rows = sorted((r.doc_id, r.text or "") for r in real.collect())
    found = {r.doc_id: r for r in fingerprints.fingerprint_neighbours(real, per_range=40).collect()}
    short = 0
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)]
        changed = fingerprints.edited(text, after[1])
        assert found[i].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest() and found[i].n_chars == len(text)
        assert found[i].near_edited == fingerprints.likeness(found[i].fingerprint, found[i].edited_fingerprint)
        assert found[i].near_next == fingerprints.likeness(found[i].fingerprint, found[after[0]].fingerprint)
        if len(text) < 700:
            short += 1
            assert found[i].fingerprint == brute_fingerprint(text) and found[i].edited_fingerprint == brute_fingerprint(changed)
    assert short > 10
    assert fingerprints.fingerprint_neighbours(docs.withColumns({"part": F.lit(1), "tag": F.lit(2), "after": F.lit(3)})).count() == docs.count()
    assert fingerprints.fingerprint_neighbours(docs.limit(0)).count() == 0
    # An id and no id with many rows each are dealt over several ranges and still chained in order.
    hot = [(7 if k % 3 else None, f"text {k} " * (1 + k % 5)) for k in range(400)] + [(k, f"other {k}") for k in range(20)]
    out = fingerprints.fingerprint_neighbours(spark.createDataFrame(hot, "doc_id long, text string"), per_range=25).collect()
    tag = {t: x for t, x in spark.createDataFrame(hot, "doc_id long, text string").select("text", F.xxhash64("text")).collect()}
    line = sorted(hot, key=lambda r: (r[0] is not None, r[0] or 0, tag[r[1]], r[1]))
    wanted = Counter((i, hashlib.sha256(fingerprints.edited(t, line[(k + 1) % len(line)][1]).encode()).hexdigest()) for k, (i, t) in enumerate(line))
    assert Counter((r.doc_id, r.edited_sha256) for r in out) == wanted
    a, b = (fingerprints.PrefixHashes(fingerprints.code_points(t)) for t in ("abcdéXabcdé", "abcdé"))
    assert a.equal(6, b, 0, 5) and a.common_extension(6, b, 0) == 5 and a.common_extension(1, b, 0) == 0


def test_packing(docs, real):
    from tokenizers import Tokenizer
    import public_tokenizers

    encoder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for df in (docs, real):
        found = [r.asDict() for r in packing.best_fit_packing(df).collect()]
        bins, got = defaultdict(list), Counter()
        for r in found:
            bins[r["sequence_id"]].append((r["offset"], r["length"]))
            got[r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]] += 1
        for spans in bins.values():
            assert [a for a, _ in sorted(spans)] == np.cumsum([0, *(n for _, n in sorted(spans)[:-1])]).tolist() and sum(n for _, n in spans) <= 2048
        wanted, total = Counter(), 0
        for r in df.collect():  # null and repeated ids too
            ids = np.array([*encoder.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
            total += len(ids)
            first = len(ids) % 2048 or 2048
            for k, a in enumerate([0, *range(first, len(ids), 2048)]):
                b = min(len(ids), a + 2048) if k else first
                wanted[r.doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
        assert got == wanted
        plain = packing.best_fit(Counter(r["length"] for r in found), 2048)
        assert len(bins) <= min(sum(n for _, n in plain), -(-total // 2048) + 1)
    assert packing.best_fit_packing(docs.limit(0)).count() == 0


def test_packing_program():
    rng = np.random.default_rng(4)
    for size, most in ((40, 90), (400, 2048)):
        lengths = np.minimum(most, 1 + rng.geometric(4 / most, size))
        histogram = {int(k): int(v) for k, v in zip(*np.unique(lengths, return_counts=True))}
        plan = packing.solve(histogram, most)
        held = Counter()
        for items, uses in zip(plan.configs, plan.uses):
            assert sum(items) <= most
            held.update({k: items.count(k) * uses for k in set(items)})
        assert held == histogram
        # The dual bound is below every packing, and the fractional cover near it.
        assert plan.bound <= sum(plan.uses) + 1e-6 and plan.bound - 1e-6 <= plan.value <= 1.01 * plan.bound
        assert sum(plan.uses) <= np.ceil(plan.bound - 1e-6) + 1
        # Every sequence but the full pieces is a configuration of an average of the weights' turns.
        assert {c for c in plan.configs if c != (most,)} <= plan.averages
    assert packing.solve({}, 64).uses == [] and packing.solve({64: 3}, 64).uses == [3]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_sequences_come_from_the_program(spark, sf):
    made = packing.pieces(spark.read.parquet(f"/root/testdata/{sf}/documents.parquet"))
    histogram = {r["length"]: r["count"] for r in made.groupBy("length").count().collect()}
    plan = packing.solve(histogram, 2048)
    priced = sum(u for c, u in zip(plan.configs, plan.uses) if c in plan.averages)
    assert priced == sum(plan.uses) - histogram.get(2048, 0) > 0
    assert plan.value <= 1.01 * plan.bound and sum(plan.uses) <= np.ceil(plan.bound - 1e-6) + 1


def test_bounded_knapsack_is_best():
    rng = np.random.default_rng(9)
    for _ in range(40):
        room = int(rng.integers(5, 40))
        counts = rng.integers(0, 4, room + 1) * (rng.random(room + 1) < 0.3)
        counts[0] = 0
        values = rng.random(room + 1)
        best = np.zeros(room + 1)
        for length in range(1, room + 1):
            for _ in range(int(counts[length])):
                best[length:] = np.maximum(best[length:], best[: room + 1 - length] + values[length])
        fills = packing.Fills(values, counts, room)
        assert fills.best == pytest.approx(best)
        taken = fills.taken(np.arange(room + 1))
        for r in range(room + 1):
            held = Counter()
            for k, (length, n) in enumerate(fills.items):
                held[length] += n * int(taken[k, r])
            assert sum(x * n for x, n in held.items()) <= r and all(n <= counts[x] for x, n in held.items())
            assert sum(values[x] * n for x, n in held.items()) == pytest.approx(best[r])


def test_long_runs_of_blanks_have_the_ids_of_the_tokenizers_file():
    import public_tokenizers
    from tokenizers import Tokenizer

    slow, fast = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), packing.public_byte_bpe()
    wide = "\u3000" * 110_000
    for text in ("x" + " " * 2_000_000 + "y", " " * 300_000, "a" + "\n" * 200_000 + " b" + " " * 150_000 + "<|endoftext|>" + wide + "\tz", "\t" * 100_000 + "'s"):
        assert packing.encoded(fast, text) == slow.encode(text, add_special_tokens=False).ids


def test_byte_bpe_gives_the_ids_of_the_tokenizers_file():
    from tokenizers import Tokenizer
    import public_tokenizers

    slow, fast = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), packing.public_byte_bpe()
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for k in range(0, len(points), 997):
        text = " ".join(points[k : k + 500]) + "".join(points[k + 500 : k + 997])
        assert slow.encode(text, add_special_tokens=False).ids == fast.encode(text, allowed_special="all")


def test_classifier_sees_what_repeats(spark):
    """Held-out rows of label 0 that only repeat lines are caught, rows of label 1 stay."""
    found = queries.op9_quality_classifier(spark, "/root/testdata/sf0.1").where("held_out")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where("quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    right = {r.quality: r.share for r in found.join(labels, "doc_id").groupBy("quality").agg(F.avg((F.col("predicted") == F.col("quality")).cast("double")).alias("share")).collect()}
    assert right[0] >= 0.9 and right[1] >= 0.98


def test_pairs_that_repeat_count_as_such():
    words = "a b a b c a b".split()
    rows = Counter(r for x in quality_classifier.feature_blocks(" ".join(words), 1 << 18) for r in x.tolist())
    fresh, again = (int(((k ^ (k >> np.uint64(32))) * np.uint64(quality_classifier.K) >> np.uint64(20)) & np.uint64((1 << 18) - 1)) for k in (quality_classifier.FRESH, quality_classifier.AGAIN))
    assert (rows[fresh], rows[again]) == (4, 2)  # ab ba | ab | bc ca | ab


def test_classifier_score_is_that_of_the_mean_vector(spark):
    """A recount of scores from the table of vectors itself, feature by feature."""
    real = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality_classifier.train(real, spark.read.parquet(f"{SF}/labels.parquet"))
    texts = {r.doc_id: r.text or "" for r in real.collect()}
    for r in quality_classifier.quality_classifier(real.select("doc_id", "text"), model).collect()[:60]:
        rows = [x for block in quality_classifier.feature_blocks(texts[r.doc_id], len(model.table)) for x in block]
        vector = model.table[rows].astype(float).mean(axis=0) if rows else np.zeros(model.table.shape[1])
        logits = vector @ model.out + model.bias
        assert r.score == pytest.approx(np.exp(logits[1]) / np.exp(logits).sum(), abs=1e-5)


def test_classifier(spark, docs):
    sf = "/root/testdata/sf0.01"
    real, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    scored = quality_classifier.quality_classifier(real, quality_classifier.train(real, labels)).join(labels, "doc_id").where(quality_classifier.held_out(F.col("doc_id")))
    rows = [(r.score, r.quality) for r in scored.select("score", "quality").collect()]
    good, bad = [s for s, q in rows if q == 1], [s for s, q in rows if q == 0]
    assert np.mean([a > b for a in good for b in bad]) > 0.85
    model = quality_classifier.train(docs, spark.createDataFrame([(4, 1, 0)], "doc_id long, quality int, toxic int"))
    assert {r.score for r in quality_classifier.quality_classifier(docs, model).collect()} <= {0.5, 1.0}


def test_features_by_blocks_are_those_of_the_whole_text():
    for text in ("", " \t", "one", "a b", LONG, " ".join(f"w{i * i % 83}é" for i in range(50))):
        whole = [r for rows in quality_classifier.feature_blocks(text, 1 << 12, 10**6) for r in rows]
        for size in (1, 2, 7):
            assert Counter(r for rows in quality_classifier.feature_blocks(text[:4000], 1 << 12, size) for r in rows) == Counter(
                r for rows in quality_classifier.feature_blocks(text[:4000], 1 << 12, 10**6) for r in rows
            )
        found, shares = quality_classifier.feature_shares(text, 1 << 12)
        counts = Counter(whole)
        assert found.tolist() == sorted(counts) and np.allclose(shares, [counts[r] / len(whole) for r in sorted(counts)])


def brute_rules(text):
    space = r"[\x20\x09-\x0D]+"
    words = [w for w in re.split(space, text or "") if w]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.sub(space, "", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), len(words) < 50 or 100 * len(covered) > 50 * len(words)


def test_quality_rules(docs, real):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    for df in (docs, real):
        judged = quality_rules.quality_rules(df)
        assert Counter((r.doc_id, *(r[x] for x in names)) for r in judged.collect()) == Counter((r.doc_id, *brute_rules(r.text)) for r in df.collect())
        assert judged.where("base_failed and kept").count() == 0
    assert quality_rules.quality_rules(docs, lang=None).where("kept").count() <= docs.count()


def test_common_extension_at_any_offset():
    text = "abcabcabd" * 7 + "é漢x" * 5
    other = "x" + text[5:40] + "abcabd" * 4
    a, b = (fingerprints.PrefixHashes(fingerprints.code_points(t)) for t in (text, other))
    for i in range(0, len(text), 3):
        for j in range(0, len(other), 4):
            n = 0
            while i + n < len(text) and j + n < len(other) and text[i + n] == other[j + n]:
                n += 1
            assert a.common_extension(i, b, j) == n


def test_piece_tokens_of_odd_texts():
    import sentencepiece

    path = piece_tokens.piece_model()
    model, vocab = sentencepiece.SentencePieceProcessor(model_file=path), piece_tokens.vocabulary(path)
    for text in ("", " ", "  a  b ", "\t\n", "日本語 漢字", "é́​", "😀😀 x😀y", "a" * 3000, "aab" * 500, "\x00\x7f"):
        ids = model.encode(text, add_eos=True)
        assert vocab.encode(text) == ids and vocab.decode(ids) == model.decode(ids)


def test_marks_beside_a_word_make_no_new_segment(monkeypatch):
    met = set()
    plain = piece_tokens.PieceVocabulary.ids
    monkeypatch.setattr(piece_tokens.PieceVocabulary, "ids", lambda self, text: met.add(text) or plain(self, text))
    words = [f"{a}{b}tion" for a in "bcdfghjklm" for b in "aeiouáéíóú"]
    text = " ".join(f"{w}{mark}" for w in words for mark in (",", ".", "!", "!!", ";", "$$$", ".\n", "", "\n"))
    piece_tokens.vocabulary(piece_tokens.piece_model()).encode(text)
    assert len(met) <= len(words) + 20


def test_piece_tokens_of_random_and_of_very_long_texts(spark):
    import sentencepiece

    path = piece_tokens.piece_model()
    model, vocab = sentencepiece.SentencePieceProcessor(model_file=path), piece_tokens.vocabulary(path)
    rng = np.random.default_rng(8)
    symbols = np.array([*" ▁\n\r\t.,!?$'\"()[]{}0123456789aábcdeéstnAB", "日", "😀", "\u0301", "\x00", " the", "tion", "...", "  "], dtype=object)
    rows = [(i, "".join(rng.choice(symbols, rng.integers(0, 60)))) for i in range(3000)]
    rows += [(4000, None), (4001, "word, 日本! " * (piece_tokens.AT_ONCE // 12)), (4002, ""), (4003, " "), (4004, "x" * 50_000 + " end"), (4005, None)]
    found = {r.doc_id: r for r in piece_tokens.piece_tokens(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), with_ids=True).collect()}
    assert len(found) == len(rows)
    for i, text in rows:
        ids = model.encode(text or "", add_eos=True)
        decoded = model.decode(ids)
        assert found[i].ids == ids and found[i].decoded == decoded and found[i].n_tokens == len(ids)
        assert found[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest() and found[i].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
        assert len(ids) > 100_000 or vocab.encode(text or "") == ids
    slices = list(piece_tokens.parts(pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3, 4, 5], "text": pa.array(["aaaa", None, "bbbbbbbbb", "", "c"])}), 4))
    assert [x for s in slices for x in s.column(0).to_pylist()] == [1, 2, 3, 4, 5] and len(slices) > 1
    assert list(piece_tokens.parts(pa.RecordBatch.from_pydict({"doc_id": [], "text": pa.array([], pa.string())}), 4))[0].num_rows == 0


def test_lm_scores_count_every_word_and_pair(spark, monkeypatch):
    monkeypatch.setattr(lm_scores, "CHUNK", 20_000, raising=False)
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{k}" for k in rng.zipf(1.2, 400) % 150_000) + f" own{i} tail{i}") for i in range(300)] + [(7, "w1 w2 w1"), (None, "w1 w2"), (None, None), (301, " ")]
    rows += [(1000 + i, " ".join(f"u{400 * i + k}" for k in range(400))) for i in range(250)]
    good = {i for i, _ in rows if i is not None and i % 3 == 0}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = lm_scores.lm_scores(df, spark.createDataFrame([(i,) for i in good], "doc_id long")).collect()
    np.testing.assert_allclose(scored_rows(found), plain_scores(rows, good), rtol=1e-9, atol=1e-12)


def test_lm_keys_survive_packing():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64) << np.uint64(1) & lm_scores.TOP)
    for part in (keys, keys[:1], keys[:0]):
        assert (lm_scores.keys_unpacked(lm_scores.keys_packed(part)) == part).all()


def test_substring_dedup_finds_passages_of_51_words(spark):
    rng = np.random.default_rng(11)
    words = lambda n: " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 1 + rng.poisson(3.7))) for _ in range(n))
    shared = [words(51) for _ in range(600)]
    rows = [(2 * k + b, f"{words(70)} {p} {words(70)}") for k, p in enumerate(shared) for b in (0, 1)]
    out = {r.doc_id: r for r in substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    texts = dict(rows)
    assert all(out[2 * k].text == texts[2 * k] for k in range(600))
    found = [k for k in range(600) if out[2 * k].n_passages == 1 and out[2 * k + 1].n_passages == 1]
    assert len(found) >= 595
    for k in found:
        left = out[2 * k + 1].text
        assert shared[k] not in left and len(texts[2 * k + 1]) - len(left) >= len(shared[k]) - 12


def test_license_scan_with_long_insertions():
    prepared = {k: license_scan.Template(v, 0.8) for k, v in license_scan.TEMPLATES.items()}
    scan = lambda t: [f for f in license_scan.findings(t, prepared) if f[0] == "apache-2.0-notice"]
    broken = "Licensed under the terms and conditions of the Apache License, Version 2.0"
    assert len(scan(broken)) == 1
    filler = " ".join(f"filler{i}" for i in range(300))
    for n in (0, 5, 40, 300):
        gap = " ".join(filler.split()[:n])
        assert len(scan(f"{filler} Licensed under the {gap} Apache License, Version 2.0. {filler}")) == 1
    assert len(scan(f"{broken} {filler} {license_scan.TEMPLATES['apache-2.0-notice']}")) == 2
