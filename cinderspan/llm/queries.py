"""Queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderspan.llm.fingerprints import fingerprint_neighbours
from cinderspan.llm import language_id as languages
from cinderspan.llm.license_scan import license_scan
from cinderspan.llm.lm_scores import lm_scores
from cinderspan.llm.ngram_join import ngram_jaccard_join
from cinderspan.llm.packing import best_fit_packing
from cinderspan.llm.periodic_runs import longest, periodic_runs
from cinderspan.llm.piece_tokens import piece_tokens
from cinderspan.llm.quality_classifier import held_out, quality_classifier, train
from cinderspan.llm.quality_rules import quality_rules
from cinderspan.llm.source_audit import source_audit
from cinderspan.llm.substring_dedup import substring_dedup
from cinderspan.llm.warc import read_records, write_archives
from cinderspan.session import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document that holds a repeated passage, with the text that is left."""
    found = substring_dedup(table(spark, sf_dir, "documents"))
    return found.where("n_passages > 0").select("doc_id", "n_passages", "passage_words", "removed_bytes", "first_doc_ids", "text")


def op2_piece_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_tokens(table(spark, sf_dir, "documents"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = write_archives(table(spark, sf_dir, "pages"))
    return read_records(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents towards those labelled good, against all documents."""
    return lm_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").where("quality = 1"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_neighbours(table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(table(spark, sf_dir, "documents"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality_classifier(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def repeating(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The edit that op11 fixes: a tenth of the ids, by checksum, repeat what follows a place of their words. A null id has no checksum and stays."""
    if doc_id is None or not words:
        return words
    g, tenth = divmod(zlib.crc32(b"%d" % doc_id), 10)
    if tenth:
        return words
    at = g % len(words)
    period = 1 + (len(words) - at) // (3 + g % 8)
    cycle = words[at : at + period]
    return words[:at] + (cycle * ((len(words) - at) // period + 1))[: len(words) - at]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of runs, the longest one, and digests of all runs and of the collapsed text."""
    found = periodic_runs(table(spark, sf_dir, "documents"), edit=repeating).withColumn("best", longest())
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.expr("sha2(array_join(transform(runs, r -> concat(concat_ws(',', r.start, r.length, r.period), '\n')), ''), 256)").alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best learned language of every text that has a letter, with what the rejection says of it beside."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = languages.language_id(docs.select("doc_id", "text"), languages.train(docs), reject=False)
    return found.select("doc_id", languages.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit(table(spark, sf_dir, "documents").select("lang", "source", "text"))


def queries() -> dict[str, Query]:
    found = (
        op1_substring_dedup,
        op2_piece_tokens,
        op3_ngram_jaccard_join,
        op4_warc,
        op5_license_scan,
        op6_lm_scores,
        op7_fingerprints,
        op8_best_fit_packing,
        op9_quality_classifier,
        op10_quality_rules,
        op11_periodic_runs,
        op12_language_id,
        op13_source_audit,
    )
    return {f.__name__: f for f in found}


_SHINGLES = """select doc_id, list_distinct(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s
  from (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w from documents)"""

OP3_SQL = f"""with recursive sets as ({_SHINGLES}), tokens as (select doc_id, unnest(s) as t from sets), sizes as (select doc_id, len(s) as n from sets),
pairs as (select a.doc_id as x, b.doc_id as y, count(*) as m from tokens a join tokens b on a.t = b.t and a.doc_id < b.doc_id group by 1, 2),
links as (select x, y from pairs join sizes p on p.doc_id = x join sizes q on q.doc_id = y where 100 * m >= 75 * (p.n + q.n - m)),
edges as (select x, y from links union all select y, x from links),
reach as (select doc_id as x, doc_id as c from sizes union select e.y as x, r.c from reach r join edges e on e.x = r.x)
select s.doc_id, cast(s.n as bigint) as n_shingles, min(r.c) as component_id from sizes s join reach r on r.x = s.doc_id group by 1, 2"""

#: Base 32 from 40 hex digits: five of them are four letters.
_BASE32 = """list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  1 + cast((cast(concat('0x', substr(h, 1 + 5 * cast(i // 4 as int), 5)) as bigint) >> cast(15 - 5 * (i % 4) as bigint)) & 31 as int), 1)), 'string_agg', '')"""

OP4_SQL = f"""with p as (select page_id, octet_length(encode(coalesce(html, ''))) as n, sha1(coalesce(html, '')) as h from pages), m as (select h, max(page_id) as newest from p group by 1)
select page_id, cast(n as bigint) as payload_bytes, {_BASE32} as payload_digest, case when page_id = newest then 'response' else 'revisit' end as record_type,
  case when page_id <> newest then newest end as refers_to from p join m using (h)"""


#: Every kept term against every source of its language, term by term.
OP13_SQL = """with w as (select row_number() over () as d, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as ws from documents),
t as (select d, lang, source, unnest(ws) as term from w),
kept as (select lang, term, count(*) as n from t group by 1, 2 having count(distinct d) >= 3),
langs as (select lang, count(*) as v, sum(n) as total from kept group by 1),
counts as (select lang, source, term, count(*) as n from t semi join kept using (lang, term) group by 1, 2, 3),
every as (select distinct lang, source from w),
groups as (select lang, source, coalesce(sum(n), 0) as total from every left join counts using (lang, source) group by 1, 2),
p as (select g.lang, g.source, k.term, coalesce(c.n, 0) as n, cast(1 + (1000000000 * (coalesce(c.n, 0) + 1)) // (g.total + l.v) as bigint) as p, cast(1 + (1000000000 * (k.n + 1)) // (l.total + l.v) as bigint) as q
  from groups g join langs l using (lang) join kept k using (lang) left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term),
pairs as (select a.lang, a.source, 'pair' as part, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) as value from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by 1, 2, 4),
bare as (select a.lang, a.source, 'pair' as part, b.source as item, 0 as value from every a join every b using (lang) where a.source <> b.source and lang not in (select lang from langs)),
terms as (select lang, source, 'term' as part, term as item, ((p - q) * (p - q)) // q as value from p where n > 0 and p > q),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item) as r from (select * from pairs union all select * from bare union all select * from terms))
select lang, source, part, item, cast(value as bigint) as value, cast(r as int) as rank from ranked where part = 'pair' or r <= 200"""


def oracle_sql() -> dict[str, str]:
    return {"op3_ngram_jaccard_join": OP3_SQL, "op4_warc": OP4_SQL, "op13_source_audit": OP13_SQL}
