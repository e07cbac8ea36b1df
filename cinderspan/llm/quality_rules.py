"""Quality rules: base counts of a text, and its divergence from language references.

Only DataFrame and SQL functions: every count is an expression over the text of one row, so
there is no shuffle, no Python and no second pass.

The base rules reject a text with fewer than ``min_words`` words, or one in which more than
half the words lie in 3-word windows that occur twice or more. The rest is judged by
Jensen-Shannon distance (square root of the divergence in bits, 0 to 1) between the text's
histograms and those of a language: character classes for every text with at least
``class_guard`` characters, common words for every text with at least ``word_guard`` words.
A text shorter than a guard is not judged by that histogram. A text goes if both distances
pass their lower limits (a missing word distance counts as passed), or if either passes its
upper limit. A text whose language is null
or has no reference is held against every reference, and the nearest counts.

Null and empty texts have no words and fail the base rules. Repeated rows are judged alike. A text
of any length is judged whole. An empty table gives no rows. Columns of the results' names are
replaced; any others pass through, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Shares of the classes lower-case letters, upper-case letters, digits, white
# space, rule symbols and everything else in running prose.
CLASS_REFERENCE = {
    "en": [0.790, 0.025, 0.005, 0.155, 0.0005, 0.0245],
    "fr": [0.790, 0.025, 0.005, 0.155, 0.0005, 0.0245],
    "de": [0.790, 0.035, 0.005, 0.145, 0.0005, 0.0245],
    "es": [0.795, 0.020, 0.005, 0.155, 0.0005, 0.0245],
}

# Common words of each language and their usual shares of running words, in
# percent. What is left goes to one class of other words.
WORD_REFERENCE = {
    "en": {"the": 6.0, "of": 3.2, "and": 2.7, "to": 2.5, "a": 2.1, "in": 2.0, "is": 1.1, "that": 1.1, "it": 1.0, "for": 0.9, "was": 0.9, "on": 0.7, "with": 0.7, "as": 0.7, "be": 0.6, "by": 0.6},
    "fr": {"de": 5.6, "la": 3.0, "le": 2.4, "et": 2.2, "les": 1.9, "en": 1.4, "des": 1.5, "un": 1.1, "du": 1.1, "une": 1.0, "que": 1.0, "est": 0.9, "pour": 0.8, "par": 0.7, "dans": 0.8, "qui": 0.7},
    "de": {"der": 3.6, "die": 3.4, "und": 2.8, "in": 1.9, "den": 1.2, "von": 1.1, "zu": 1.1, "das": 1.1, "sich": 0.8, "mit": 0.9, "des": 0.8, "auf": 0.7, "für": 0.7, "ist": 0.8, "im": 0.7, "nicht": 0.7},
    "es": {"de": 6.0, "la": 3.6, "que": 2.9, "el": 2.8, "en": 2.5, "y": 2.4, "los": 1.6, "las": 1.1, "se": 1.2, "del": 1.1, "un": 1.1, "por": 0.9, "con": 0.9, "no": 0.9, "una": 0.8, "su": 0.7},
}

#: White space and lower-case letters as parts of a Java class, a word's character, and the
#: classes upper-case letters, digits and rule symbols.
SPACES = r" \\t-\\r"
SPACE = f"[{SPACES}]"
LOWER = r"\\p{Ll}"
WORD = f"[^{SPACES}]"
#: Up to so many different repeated windows, positions are looked up rather than sorted.
FEW = 100
CLASSES = [r"\\p{Lu}", r"\\p{Nd}", r"[#*$%&|<>]"]


def _numbers(values: list[float]) -> str:
    return "array(" + ", ".join(f"{v!r}D" for v in values) + ")"


def jensen_shannon(p: str, q: str) -> str:
    """SQL for the Jensen-Shannon distance of two arrays of shares of equal length."""
    term = "CASE WHEN x > 0 THEN x * log2(2 * x / (x + y)) ELSE 0D END"
    other = "CASE WHEN y > 0 THEN y * log2(2 * y / (x + y)) ELSE 0D END"
    return f"sqrt(greatest(0D, aggregate(zip_with({p}, {q}, (x, y) -> 0.5D * ({term} + {other})), 0D, (s, x) -> s + x)))"


def _word_reference(lang: str) -> tuple[list[str], list[float]]:
    shares = {w: v / 100 for w, v in WORD_REFERENCE[lang].items()}
    return list(shares), [*shares.values(), 1 - sum(shares.values())]


def _distance(lang: Column | None, shares, reference: dict[str, list[float]]) -> Column:
    """The distance to the row's language, or the least of all where it has no reference."""
    nearest = F.least(*(F.expr(jensen_shannon(shares(k), _numbers(reference[k]))) for k in reference))
    if lang is None:
        return nearest
    own, ref = F.when(F.lit(False), F.array(F.lit(0.0))), F.when(F.lit(False), F.array(F.lit(0.0)))
    for k in reference:
        own, ref = own.when(lang == k, F.expr(shares(k))), ref.when(lang == k, F.expr(_numbers(reference[k])))
    pairs = F.arrays_zip(own.alias("x"), ref.alias("y"))
    known = F.sqrt(F.greatest(F.lit(0.0), F.aggregate(pairs, F.lit(0.0), lambda total, z: total + _term(z["x"], z["y"]))))
    return F.when(lang.isin(*reference), known).otherwise(nearest)


def _term(x: Column, y: Column) -> Column:
    return F.lit(0.5) * (F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(0.0) + F.when(y > 0, y * F.log2(2 * y / (x + y))).otherwise(0.0))


def _word_shares(lang: str) -> str:
    """SQL for the shares of a language's common words, and of all others, in ``_cw``."""
    size = "cast(greatest(n_words, 1) AS double)"
    own = [f"(size(_cw) - size(array_remove(_cw, '{w}'))) / {size}" for w in WORD_REFERENCE[lang]]
    listed = ", ".join(f"'{w}'" for w in WORD_REFERENCE[lang])
    return f"array({', '.join(own)}, (n_words - size(filter(_cw, w -> w IN ({listed})))) / {size})"


def quality_rules(
    docs: DataFrame,
    text: str = "text",
    lang: str | None = "lang",
    min_words: int = 50,
    class_limits: tuple[float, float] = (0.17, 0.30),
    word_limits: tuple[float, float] = (0.27, 0.45),
    class_guard: int = 200,
    word_guard: int = 50,
) -> DataFrame:
    """Every row of ``docs`` with the base counts, the two distances, ``base_failed`` and ``kept``.

    ``lang=None`` holds every text against all references.
    """
    out = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_distance", "word_distance", "base_failed", "kept"]
    own = [F.col(f"`{c}`") for c in docs.columns if c not in out]
    forms = ", ".join(f"'{x}', '{x.capitalize()}'" for x in sorted({w for k in WORD_REFERENCE.values() for w in k}))
    # The row travels as one struct, so that no column of it can clash with those made here.
    tongue = F.lit(None).cast("string") if lang is None else F.col(f"`{lang}`")
    t = docs.select(F.struct(*own).alias("_doc"), tongue.alias("_lang"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_t"))
    split = t.select(
        "*",
        F.expr(f"filter(split(_t, '{SPACE}+'), w -> w <> '')").alias("_w"),
        F.expr(f"filter(split(_t, '\n'), l -> l RLIKE '{WORD}')").alias("_l"),
        # What is neither a lower-case letter nor white space is little; the other classes are counted there.
        F.expr(f"regexp_replace(_t, '[{LOWER}{SPACES}]+', '')").alias("_r"),
        F.expr("cast(length(_t) AS bigint)").alias("_n"),
    ).drop("_t")
    # A window is a 64-bit hash of three words.
    hashed = split.select(
        "*",
        F.expr("CASE WHEN size(_w) < 3 THEN cast(array() AS array<bigint>) ELSE transform(sequence(0, size(_w) - 3), i -> xxhash64(_w[i], _w[i + 1], _w[i + 2])) END").alias("_h"),
        F.expr("aggregate(_w, 0L, (a, w) -> a + length(w))").alias("word_chars"),
        F.expr(f"transform(filter(_w, w -> w IN ({forms})), w -> lower(w))").alias("_cw"),
        *(F.expr(f"cast(length(_r) - length(regexp_replace(_r, '{c}+', '')) AS bigint)").alias(f"_c{i}") for i, c in enumerate(CLASSES)),
    )
    # Windows that repeat are neighbours in the sorted hashes. Where few differ, their positions
    # are looked up; where many do, hashes and positions are sorted together.
    repeats = hashed.select("*", F.expr("CASE WHEN size(array_distinct(_h)) < size(_h) THEN sort_array(_h) ELSE cast(array() AS array<bigint>) END").alias("_s")).select(
        "*", F.expr("array_distinct(filter(_s, (x, i) -> i > 0 AND x = _s[greatest(i - 1, 0)]))").alias("_d")
    )
    placed = repeats.select(
        "*",
        F.expr(
            "CASE WHEN size(_d) = 0 THEN cast(array() AS array<int>)"
            f" WHEN size(_d) <= {FEW} THEN filter(transform(_h, (x, i) -> CASE WHEN array_contains(_d, x) THEN i ELSE -1 END), i -> i >= 0)"
            " ELSE sort_array(flatten(transform(array(sort_array(transform(_h, (x, i) -> struct(x AS h, i AS i)))), s ->"
            " transform(filter(s, (x, i) -> coalesce(get(s, i - 1).h = x.h, false) OR coalesce(get(s, i + 1).h = x.h, false)), x -> x.i)))) END"
        ).alias("_p"),
    )
    counted = placed.select(
        "_doc",
        "_lang",
        F.expr("cast(size(_w) AS bigint)").alias("n_words"),
        "word_chars",
        F.col("_c2").alias("n_symbols"),
        F.expr("cast(size(_l) - size(array_distinct(_l)) AS bigint)").alias("n_dup_lines"),
        F.expr("aggregate(transform(_p, (x, i) -> least(3, coalesce(get(_p, i + 1) - x, 3))), 0L, (a, x) -> a + x)").alias("n_repeat_words"),
        F.expr("transform(array(word_chars - length(_r), _c0, _c1, _n - word_chars, _c2, length(_r) - _c0 - _c1 - _c2), x -> x / cast(greatest(_n, 1) AS double))").alias("_class"),
        "_n",
        "_cw",
    )
    tongue = None if lang is None else F.col("_lang")
    # A filter on kept must not be pushed below this step, where its expression would be
    # expanded through every step before; a row number, not deterministic, holds it here.
    judged = counted.select(
        "_doc",
        F.monotonically_increasing_id().alias("_row"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        F.when(F.col("_n") >= class_guard, _distance(tongue, lambda k: "_class", CLASS_REFERENCE)).alias("class_distance"),
        F.when(F.col("n_words") >= word_guard, _distance(tongue, _word_shares, {k: _word_reference(k)[1] for k in WORD_REFERENCE})).alias("word_distance"),
    ).withColumn("base_failed", F.expr(f"n_words < {min_words} OR 100 * n_repeat_words > 50 * n_words"))
    classes, words = F.coalesce("class_distance", F.lit(0.0)), F.coalesce("word_distance", F.lit(1.0))
    return judged.withColumn(
        "kept",
        ~F.col("base_failed")
        & ~((classes > class_limits[0]) & (words > word_limits[0]))
        & (classes <= class_limits[1])
        & (F.coalesce("word_distance", F.lit(0.0)) <= word_limits[1])
        & (F.col("_row") >= 0),
    ).select("_doc.*", *out)
