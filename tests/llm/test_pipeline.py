"""Every stage of the pipeline on a small table with odd rows, and the whole run."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_operators import SF, brute_components, brute_rules

STAGE = dict(corpus_pipeline.STAGES)


def prose(seed, n):
    """Words in an order of their own, all different, in a language's usual shape."""
    return " ".join(f"{'abcdefghijklmnopqrstuvwxyz'[(seed * 7 + i) % 26]}{'aeiou'[i % 5]}{'rstlnm'[(i * seed) % 6]}{'aeiou'[(i // 5 + seed) % 5]}{chr(97 + i % 26)}{chr(97 + (i // 26 + seed) % 26)}" for i in range(n))


BASE, PASSAGE = prose(1, 200), prose(2, 60)
ROWS = [
    (1, BASE), (2, BASE), (3, BASE + " " + prose(3, 12)), (4, prose(4, 150)), (5, prose(5, 90) + " " + PASSAGE + " " + prose(6, 40)), (6, PASSAGE + " " + prose(7, 100)),
    (7, None), (8, ""), (9, "short text"), (10, "same words again " * 60), (11, prose(8, 120)), (11, prose(8, 120)), (11, prose(9, 120)), (None, prose(10, 120)), (None, prose(10, 120)), (None, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").withColumns({"lang": F.lit(None).cast("string"), "source": F.lit("s"), "n_chars": F.length("text").cast("bigint")})
    return df.withColumns({c: F.lit("clash") for c in ("_t", "_w", "_h", "_n", "_row", "_kept", "_id", "kept", "score", "row", "tag", "a.b")})


def pairs(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


@pytest.mark.parametrize("name", list(STAGE)[:-1])
def test_stage_keeps_columns_and_takes_empty_tables(spark, docs, name):
    out = STAGE[name](spark, docs, SF)
    assert out.columns == docs.columns and {r["a.b"] for r in out.collect()} <= {"clash"}
    assert STAGE[name](spark, docs.limit(0), SF).count() == 0
    assert sum(pairs(STAGE[name](spark, docs.where("text is null"), SF)).values()) <= 2


def test_rules_drop_what_fails_the_base_and_only_judge_rows(spark, docs):
    out = pairs(STAGE["quality rules"](spark, docs, SF))
    assert not [t for (_, t) in out if brute_rules(t)[-1]]
    all_rows = Counter(ROWS)
    assert all(n == all_rows[k] for k, n in out.items())


def test_classifier_takes_whole_groups_of_equal_texts(spark, docs):
    out, all_rows = pairs(STAGE["quality classifier"](spark, docs, SF)), Counter(ROWS)
    assert all(n == all_rows[k] for k, n in out.items())
    kept = {t for _, t in out}
    assert not [k for k in all_rows if k[1] in kept and k not in out]


def test_near_duplicates_leave_the_smallest_id(spark, docs):
    out = pairs(STAGE["n-gram jaccard join"](spark, docs, SF))
    named = brute_components([r for r in ROWS if r[0] is not None and r[0] != 11])
    wanted = {(i, t): 1 for i, t in ROWS if i is None or i == 11 or named[i][1] == i}
    assert out == wanted and (2, BASE) not in out and (3, ROWS[2][1]) not in out


def test_passages_go_where_they_repeat(spark, docs):
    before = docs.where("doc_id in (4, 5, 6, 7, 8, 9)")
    out = {r.doc_id: r for r in STAGE["substring dedup"](spark, before, SF).collect()}
    texts = dict(r for r in ROWS if r[0] in out)
    assert all(out[i].text == texts[i] for i in (4, 5, 7, 8, 9))
    assert PASSAGE[20:-20] not in out[6].text and out[6].text.endswith(prose(7, 100)) and out[6].n_chars == len(out[6].text)


def test_packing_holds_every_row(spark, docs):
    out = STAGE["best-fit packing"](spark, docs, SF).collect()
    assert Counter(r.doc_id for r in out if r.piece == 0) == Counter(i for i, _ in ROWS)


def test_run_gives_the_stages_one_after_another(spark, tmp_path):
    held = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        held = stage(spark, held, SF)
        path = str(tmp_path / stage.__name__)
        held.write.parquet(path)
        held = spark.read.parquet(path)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    rows = lambda df: Counter(map(tuple, df.select(*names).collect()))
    assert rows(corpus_pipeline.run(spark, SF)) == rows(held) and held.count() > 50
