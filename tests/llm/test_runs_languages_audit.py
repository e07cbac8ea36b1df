"""Operators 11 to 13 against brute force, planted texts and edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinderspan.llm import language_id, periodic_runs, queries, source_audit

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"t{i * i % 9973}" for i in range(300_000))
CYCLE = "on and on and over again " * 20_000
ROWS = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, "  \t\n ", None, None), (4, "one", "fr", "b"), (5, "One", "fr", None), (6, LONG, "en", "b"), (7, CYCLE, "en", "b"),
    (8, "é" * 40 + " 中文 😀 12 ²", "de", "a"), (9, "a a a a a a a", "en", "b"), (9, "a a a a a a a", "en", "b"), (10, "x y x y x y x y z", "en", "c"), (11, "x y x y x y x z", "en", "c"),
    (None, "b b b b b b b b", "en", "c"), (None, None, None, None), (12, "Tie tie TIE ties Ties", "", "a"), (13, "12 34 !? ²½", "", "c"),
]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    for name in ("score", "runs", "term", "block", "n", "rank"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def brute_runs(w, least=6, power=4):
    n, out = len(w), []
    for q in range(1, n // power + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j + q - i
            if j > i and size >= max(least, power * q) and not any(all(w[t] == w[t + r] for t in range(i, i + size - r)) for r in range(1, q)):
                out.append((i, size, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapsed(w, runs):
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def test_runs_match_brute_force():
    rng = random.Random(3)
    for _ in range(1500):
        texts = []
        for _ in range(3):
            kinds, n = rng.choice([1, 2, 2, 3, 5]), rng.randint(0, 80)
            w = [b"%d" % rng.randrange(kinds) for _ in range(n)]
            if n and rng.random() < 0.7:
                a = rng.randrange(n)
                p = 1 + (n - a) // rng.randint(3, 9)
                for i in range(a + p, n):
                    w[i] = w[i - p]
                if rng.random() < 0.3:
                    w[rng.randrange(n)] = b"x"
            texts.append(w)
        least, power = rng.choice([(6, 4), (6, 4), (1, 3), (10, 5)])
        for w, (runs, left) in zip(texts, periodic_runs.collapsed_runs(texts, least, power)):
            assert [tuple(r) for r in runs] == brute_runs(w, least, power)
            assert left.decode() == brute_collapsed([x.decode() for x in w], [tuple(r) for r in runs])


def edited(doc_id, w):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not w:
        return w
    g = h // 10
    a = g % len(w)
    p = 1 + (len(w) - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]


def test_op11_query_matches_brute_force(spark):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = queries.op11_periodic_runs(spark, SF).collect()
    assert len(found) == len(rows)
    with_runs = 0
    for r in found:
        w = edited(r.doc_id, re.findall(r"[^\x20\x09-\x0D]+", rows[r.doc_id] or ""))
        runs = brute_runs(w)
        best = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=None)
        assert r.n_runs == len(runs)
        assert (r.start, r.length, r.period, r.exponent_milli) == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(brute_collapsed(w, runs).encode()).hexdigest()
        with_runs += bool(runs)
    assert with_runs >= 10


def test_runs_edge_cases(docs, monkeypatch):
    for size in (periodic_runs.WORDS, 3):
        monkeypatch.setattr(periodic_runs, "WORDS", size)
        found = periodic_runs.periodic_runs(docs).withColumn("best", periodic_runs.longest()).collect()
        assert len(found) == len(ROWS)
        by_id = defaultdict(list)
        for r in found:
            by_id[r.doc_id].append(r)
        for k in (1, 2, 3, 4, 11):
            assert by_id[k][0].runs == [] and by_id[k][0].best is None
        assert by_id[1][0].collapsed == by_id[3][0].collapsed == ""
        assert by_id[7][0].runs == [(0, 120_000, 6)] and by_id[7][0].collapsed == "on and on and over again"
        assert by_id[9][0] == by_id[9][1] and by_id[9][0].runs == [(0, 7, 1)] and by_id[9][0].collapsed == "a"
        assert by_id[10][0].runs == [(0, 8, 2)] and by_id[10][0].collapsed == "x y z"
        assert sorted(r.collapsed for r in by_id[None]) == ["", "b"]
        assert by_id[6][0].collapsed == LONG or by_id[6][0].runs
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0
    assert queries.repeating(None, [b"a"] * 9) == [b"a"] * 9
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(docs, power=2)


def brute_tables(counts):
    """n-gram counts of interpolated Kneser-Ney, by order, from words and their counts."""
    top = language_id.ORDER
    occurs = Counter()
    for w, c in counts.items():
        s = "\0" * (top - 1) + w + "\0"
        for t in range(top - 1, len(s)):
            occurs[s[t - top + 1 : t + 1]] += c
    tables = {top: occurs}
    for n in range(top - 1, 0, -1):
        lower, before = Counter(), Counter()
        for g, c in occurs.items():
            lower[g[1:]] += c
            before[g[1:]] += 1
        tables[n] = {g: lower[g] if g[0] == "\0" and n > 1 else before[g] for g in lower}
        occurs = lower
    return tables


def brute_share(tables, context, symbol, symbols):
    p = 1 / symbols
    for n in range(1, language_id.ORDER + 1):
        t = tables[n]
        n1, n2 = (sum(v == k for v in t.values()) for k in (1, 2))
        d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        h = context[len(context) - n + 1 :] if n > 1 else ""
        row = {g: v for g, v in t.items() if g[:-1] == h}
        if row:
            total = sum(row.values())
            p = (max(row[h + symbol] - d, 0) if h + symbol in row else 0) / total + d * len(row) / total * p
    return p


def test_models_match_plain_kneser_ney():
    data = {"a": {"abc": 2, "abd": 1, "b": 5, "bca": 1, "cc": 2}, "b": {"éa": 3, "ab": 1, "bé": 1}}
    models = language_id.LanguageModels.fit(data)
    symbols = round(1 / models.floor)
    assert symbols == len("abcdé") + 2
    words = ["abc", "zb", "éab", "b", "cca", "abcabcab"]
    bits, n = models.bits(words)
    assert n.tolist() == [len(w) + 1 for w in words]
    for k, lang in enumerate(models.languages):
        tables = brute_tables(data[lang])
        for w, got in zip(words, bits[:, k]):
            s = "\0" * (language_id.ORDER - 1) + w + "\0"
            at = language_id.ORDER - 1
            want = -sum(np.log2(brute_share(tables, s[t - at : t], s[t], symbols)) for t in range(at, len(s)))
            assert got == pytest.approx(want, abs=1e-4)
        for context in ("\0\0\0\0", "\0\0\0a", "\0\0ab", "zzzz"):
            assert sum(brute_share(tables, context, c, symbols) for c in "abcdé\0?") == pytest.approx(1)


def test_entropy_of_a_text_is_that_of_its_words():
    models = language_id.LanguageModels.fit({"a": {"abc": 2, "ab": 3}, "b": {"bca": 1}})
    texts = [language_id.words_of(t) for t in ("abc AB, ab!", "", "12", "bca bca x9y", "²")]
    entropy, n = models.entropies(texts)
    for words, h, m in zip(texts, entropy, n):
        words = ["".join(filter(str.isalpha, w)) for w in words]
        if not "".join(words):
            assert m == 0 and np.isnan(h).all()
            continue
        bits, symbols = models.bits(words)
        assert m == symbols.sum() and h == pytest.approx(bits.sum(axis=0) / symbols.sum())


def test_op12_held_out_accuracy(spark):
    for sf in (SF, "/root/testdata/sf0.01"):
        lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
        found = [r for r in queries.op12_language_id(spark, sf).collect() if lang[r.doc_id] is not None]
        for r in found:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        held = [r for r in found if r.held_out]
        assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held)
        assert sum(r.rejected for r in held) <= 0.05 * len(held)


def test_language_models_never_see_held_out_rows(spark, real):
    """Other texts, languages and sources of the held-out rows change no prediction of the rest."""
    twisted = real.withColumn("lang", F.when(language_id.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    twisted = twisted.withColumn("text", F.when(language_id.held_out(F.col("doc_id")), F.lit("qqq www")).otherwise(F.col("text")))
    a, b = (language_id.train(x) for x in (real, twisted))
    assert "zz" not in b.languages and a.languages == b.languages and a.heat == b.heat
    assert all((x[0][1] == y[0][1]).all() for x, y in zip(a.orders, b.orders))


def test_rejection(spark, real):
    models = language_id.train(real)
    texts = [(1, "Это текст на совсем другом языке, которого модель никогда не видела " * 3), (2, "zxqj wvkk qqzx jjxw vvqk " * 30), (3, real.where("lang = 'fr' and length(text) > 800").first().text)]
    odd = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r for r in language_id.language_id(odd, models).collect()}
    assert got[1].rejected and got[2].rejected and got[1].lang_pred == got[2].lang_pred == "und"
    assert got[3].lang_pred == "fr" and not got[3].rejected
    assert {r.lang_pred for r in language_id.language_id(odd, models, reject=False).collect()} <= set(models.languages)


def test_language_edge_cases(spark, docs, real, monkeypatch):
    models = language_id.train(real)
    for size in (language_id.WORDS, 2):
        monkeypatch.setattr(language_id, "WORDS", size)
        found = language_id.language_id(docs, models, reject=False).collect()
        assert len(found) == len(ROWS)
        for r in found:
            if r.doc_id in (1, 2, 3, 13):
                assert (r.lang_pred, r.score, r.entropy) == ("und", 0.0, None)
        assert [r for r in found if r.doc_id == 9][0] == [r for r in found if r.doc_id == 9][1]
        assert [r for r in found if r.doc_id == 6][0].lang_pred in models.languages
    assert language_id.language_id(docs.limit(0), models).count() == 0
    assert language_id.train(docs.limit(0)) is None and language_id.train(docs.where("doc_id in (1, 3, 13)")) is None
    assert {(r.lang_pred, r.score) for r in language_id.language_id(docs, None).collect()} == {("und", 0.0)}
    learned = language_id.train(docs)
    assert "" in learned.languages or "en" in learned.languages
    # Ties go to the first in order of names.
    tie = language_id.LanguageModels.fit({"b": {"same": 2}, "a": {"same": 2}})
    assert tie.judge([["same"]])["lang_pred"] == ["a"] and tie.judge([["same"]])["score"] == [0.5]


def test_language_sample_is_bounded(spark, real):
    known = real.where("lang is not null and text is not null").select("doc_id", "text", "lang")
    whole = known.groupBy("lang").agg(F.sum(F.ceil(F.length("text") / language_id.BLOCK)).alias("n")).collect()
    assert {r.lang: r.n for r in whole} == {r.lang: r["count"] for r in language_id.sampled(known, 10**9).groupBy("lang").count().collect()}
    few = {r.lang: r["count"] for r in language_id.sampled(known, 20).groupBy("lang").count().collect()}
    assert all(n <= 20 + 4 * 20**0.5 for n in few.values()) and sum(few.values()) >= 30


def brute_audit(rows, least=3, top=200):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    docs, counts, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = term.findall((text or "").translate(lower))
        counts[lang, source].update(found)
        docs[lang].update(set(found))
        sources[lang].add(source)
    out = []
    for lang, group in sources.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        whole = Counter()
        for s in group:
            whole.update({t: counts[lang, s][t] for t in kept})

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (total + len(kept)) for t in kept}

        p, q = {s: shares(counts[lang, s]) for s in group}, shares(whole)
        for s in group:
            parts = {"pair": [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in group if o != s]}
            parts["term"] = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items in parts.items():
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(ranked) if part == "pair" or k < top]
    return sorted(out)


@pytest.mark.parametrize("per_block", [500_000, 50])
def test_audit_matches_brute_force(docs, real, per_block):
    few = docs.where("doc_id is null or doc_id <> 6").unionByName(docs.where("doc_id in (9, 10, 12)"))
    for df, top in ((few, 200), (real, 200), (real, 5)):
        found = source_audit.source_audit(df, top=top, per_block=per_block).collect()
        assert sorted(map(tuple, found)) == brute_audit([(r.text, r.lang, r.source) for r in df.collect()], top=top)
    assert any(r.lang == "en" and r.part == "term" for r in found)


def test_audit_edge_cases(spark, docs):
    assert source_audit.source_audit(docs.limit(0)).count() == 0
    bare = spark.createDataFrame([("one word", "en", "a"), (None, "en", "b"), ("", None, "c")], "text string, lang string, source string")
    assert sorted(map(tuple, source_audit.source_audit(bare).collect())) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
    # Equal groups: all values tie at 0, ranks go by item; nothing is over its language's share.
    same = spark.createDataFrame([(t, "en", s) for s in "cab" for t in ("x y", "x y", "x y Z")], "text string, lang string, source string")
    assert sorted(map(tuple, source_audit.source_audit(same, least=3).collect())) == brute_audit([(r.text, r.lang, r.source) for r in same.collect()])
    assert source_audit.source_audit(docs.where("doc_id = 6")).count() == 0


def test_accumulator_equals_dense_sums():
    rng = np.random.default_rng(5)
    for _ in range(30):
        sources, terms = rng.integers(1, 7), rng.integers(1, 30)
        n = rng.integers(0, 5, (sources, terms)) * rng.integers(0, 2, (sources, terms))
        n[0] = np.maximum(n[0], rng.integers(0, 2, terms))
        term, source = np.nonzero(n.T)
        elsewhere = rng.integers(0, 50, sources)
        kept, totals = int(terms + rng.integers(0, 9)), n.sum(axis=1) + elsewhere
        p = 1 + source_audit.SCALE * (n + 1) // (totals[:, None] + kept)
        got = list(source_audit.accumulated(source, term, n[source, term], totals, kept, int(terms)))
        for g in range(sources):
            assert got[g].tolist() == [int(((p[g] - p[s]) ** 2 // p[s]).sum()) for s in range(sources)]
