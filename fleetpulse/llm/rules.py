"""Quality rules with adaptive thresholds, in DataFrame functions only.

Instead of fixed cutoffs, every (language, source) gets fences from its own distribution: a metric must
lie within ``reach`` interquartile ranges of the quartiles. Quartiles come from mergeable quantile
sketches: counts of logarithmic buckets, of relative error ``ACCURACY``, that add up without loss. They are counted
once per (language, source) with map-side combine and merged upwards for groups with too few
documents: to the language, then to everything.

Per-document measures are computed once, without a shuffle, and stored without the text; fences
have one row per group and are joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetpulse.llm.common import SPACE_CHARS, SPACES, WORD, join_small, stored

ACCURACY = 0.05
#: Metric: expression in thousandths, and how far beyond a quartile any document may lie.
METRICS = {
    "word_length": ("1000 * word_chars div greatest(n_words, 1)", 1500),
    "symbols": ("1000 * n_symbols div greatest(n_words, 1)", 300),
    "dup_lines": ("1000 * n_dup_lines div greatest(n_lines, 1)", 300),
    "repeats": ("1000 * n_repeat_words div greatest(n_words, 1)", 200),
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(words: Column, width: int = 5) -> Column:
    """Words inside windows of ``width`` words that occur twice or more in the array.

    Windows are compared by 64-bit hashes. Only texts whose hashes are not all distinct are sorted
    to find which ones repeat; then the union of their places is counted.
    """

    def hashed(w: Column) -> Column:
        at = lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)])
        return F.when(F.size(w) < width, F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(0), F.size(w) - width), at))

    def starts(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def twice(p: Column) -> Column:
            same = lambda j, x: F.coalesce(F.get(p, j)["h"] == x["h"], F.lit(False))
            return F.filter(p, lambda x, j: F.when(j > 0, same(j - 1, x)).otherwise(F.lit(False)) | same(j + 1, x))

        return F.array_sort(F.transform(let(pairs, twice), lambda x: x["i"]))

    def covered(s: Column) -> Column:
        steps = F.transform(s, lambda x, k: F.least(F.lit(width), F.coalesce(F.get(s, k + 1) - x, F.lit(width))))
        return F.aggregate(steps, F.lit(0), lambda total, x: total + x)

    def count(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(starts(h), covered))

    return let(let(F.transform(words, lambda w: F.xxhash64(w)), hashed), count)


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns plus the measures of each whole text; null and empty texts measure 0."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")
    split = docs.select("*", words.alias("_words"), lines.alias("_lines"))
    return split.select(
        *docs.columns,
        F.size("_words").cast("bigint").alias("n_words"),
        (F.length(text) - F.length(F.regexp_replace(text, WORD, ""))).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        repeated_words(F.col("_words")).cast("bigint").alias("n_repeat_words"),
        F.size("_lines").cast("bigint").alias("n_lines"),
    )


def bucket(value: Column) -> Column:
    """Sketch bucket of a whole number: 0 for 0, else the power of (1 + ACCURACY) below it, from 1."""
    return F.when(value <= 0, F.lit(0)).otherwise((F.floor(F.log(value.cast("double")) / F.log(F.lit(1 + ACCURACY))) + 1).cast("int"))


def bucket_value(place: Column) -> Column:
    """A bucket's lower end."""
    return F.when(place <= 0, F.lit(0.0)).otherwise(F.pow(F.lit(1 + ACCURACY), place - 1))


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, metric, bucket, n): the sketch of every metric of each group."""
    stacked = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), bucket(F.expr(e)).alias("bucket")) for m, (e, _) in METRICS.items()]))
    return measured.select("_lang", "_source", stacked.alias("_m")).groupBy("_lang", "_source", "_m.metric", "_m.bucket").agg(F.count("*").alias("n"))


def fences(sketch: DataFrame, keys: tuple[str, ...], reach: float, guarded: bool = False) -> DataFrame:
    """Merge the sketches of groups that agree on ``keys``; the fences of each metric, and documents.

    Guarded fences take no upper end from the third quartile, which is junk itself when over a quarter of
    a group is: it is at most as far above the median as twice the way from the first quartile to the
    median reaches, which junk does not move unless it is half of the group.
    """
    merged = sketch.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "metric")
    running = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = merged.select("*", F.sum("n").over(running).alias("_below"), F.sum("n").over(group).alias("_all"))

    def quartile(k: int) -> Column:
        return bucket_value(F.min(F.when(F.col("_below") * 4 >= F.col("_all") * k, F.col("bucket"))))

    found = ranked.groupBy(*keys, "metric").agg(quartile(1).alias("q1"), quartile(2).alias("q2"), quartile(3).alias("q3"), F.max("_all").alias("docs"))
    slack = F.create_map(*[F.lit(x) for m, (_, s) in METRICS.items() for x in (m, float(s))])
    spread = F.greatest((F.col("q3") - F.col("q1")) * reach, slack[F.col("metric")])
    high = F.col("q3") + spread
    if guarded:
        high = F.least(high, F.col("q2") + F.greatest((F.col("q2") - F.col("q1")) * 2 * reach, slack[F.col("metric")]))
    one = lambda m, v: F.max(F.when(F.col("metric") == m, v))
    return found.groupBy(*keys).agg(
        F.max("docs").alias("docs"),
        F.struct(*[F.struct(one(m, F.col("q1") - spread).alias("low"), one(m, high).alias("high")).alias(m) for m in METRICS]).alias("fence"),
    )


def group_fences(sketch: DataFrame, reach: float, least_docs: int, guarded: bool = False) -> DataFrame:
    """One row per (language, source): its own fences if it has ``least_docs`` documents, else its language's, else all."""
    own, lang, every = (fences(sketch, keys, reach, guarded) for keys in (("_lang", "_source"), ("_lang",), ()))
    lang = lang.select(F.col("_lang").alias("_l"), F.col("docs").alias("_ld"), F.col("fence").alias("_lf"))
    every = every.select(F.col("fence").alias("_ef"))
    joined = own.join(lang, F.col("_lang").eqNullSafe(F.col("_l")), "left").join(F.broadcast(every), F.lit(True), "left")  # one row
    chosen = F.when(F.col("docs") >= least_docs, F.col("fence")).when(F.col("_ld") >= least_docs, F.col("_lf")).otherwise(F.col("_ef"))
    return joined.select(F.col("_lang").alias("_glang"), F.col("_source").alias("_gsource"), chosen.alias("_fence")).select("_glang", "_gsource", "_fence.*")


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    keep: tuple[str, ...] = (),
    reach: float = 3.0,
    least_docs: int = 50,
    least_words: int = 10,
    most_repeats: int = 20,
    guarded: bool = False,
) -> DataFrame:
    """Measures and verdict of every row: (doc_id, ``keep`` columns, measures, base_failed, kept).

    A text fails the base rules with fewer than ``least_words`` words or more than ``most_repeats``
    percent of its words in repeated windows; it is kept if it passes them and every metric is within its
    group's fences. Null languages and sources are groups of their own. Null and empty texts fail.
    Repeated rows are judged each and count each; an empty table gives no row. ``guarded`` fences hold
    when up to half of a group is junk; the SQL has those that are not guarded.
    """
    own = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(lang_col).cast("string").alias("_lang"),
        F.col(source_col).cast("string").alias("_source"),
        F.col(text_col).cast("string").alias("_text"),
        F.struct(F.lit(1), *[F.col(c) for c in keep]).alias("_keep"),
    )
    measured = measures(own, "_text")
    measured = stored(measured.drop("_text") if keep else measured.drop("_text", "_keep"), "rules")
    limits = group_fences(sketches(measured), reach, least_docs, guarded)
    joined = join_small(
        measured, limits, F.col("_lang").eqNullSafe(F.col("_glang")) & F.col("_source").eqNullSafe(F.col("_gsource")), "left", "fences"
    )
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeats * F.col("n_words"))
    within = [F.expr(e).between(F.col(m)["low"], F.col(m)["high"]) for m, (e, _) in METRICS.items()]
    verdict = ~failed
    for ok in within:
        verdict = verdict & F.coalesce(ok, F.lit(True))
    return joined.select("doc_id", *(["_keep"] if keep else []), *MEASURES, failed.alias("base_failed"), verdict.alias("kept"))


def accepted(docs: DataFrame, **options) -> DataFrame:
    """The rows that the rules keep, with the columns they came with."""
    return judge(docs, keep=tuple(docs.columns), **options).filter("kept").select(*[F.col("_keep")[c].alias(c) for c in docs.columns])


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
u AS (SELECT rid, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM w),
h AS (SELECT rid, i, x || ' ' || lead(x, 1) OVER k || ' ' || lead(x, 2) OVER k || ' ' || lead(x, 3) OVER k || ' ' || lead(x, 4) OVER k AS five
  FROM u WINDOW k AS (PARTITION BY rid ORDER BY i)),
g AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, five) AS c FROM h WHERE five IS NOT NULL),
r AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM g WHERE c > 1) GROUP BY rid),
m AS (SELECT rid, doc_id, lang, source, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
  coalesce(r.n, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines FROM w LEFT JOIN r USING (rid)),
v AS (SELECT rid, lang, source, unnest([
  {'metric': 'word_length', 'slack': 1500, 'v': 1000 * word_chars // greatest(n_words, 1)},
  {'metric': 'symbols', 'slack': 300, 'v': 1000 * n_symbols // greatest(n_words, 1)},
  {'metric': 'dup_lines', 'slack': 300, 'v': 1000 * n_dup_lines // greatest(n_lines, 1)},
  {'metric': 'repeats', 'slack': 200, 'v': 1000 * n_repeat_words // greatest(n_words, 1)}], recursive := true) FROM m),
b AS (SELECT *, CASE WHEN v <= 0 THEN 0 ELSE floor(ln(v::DOUBLE) / ln(1.05::DOUBLE)) + 1 END AS k FROM v),
l AS (SELECT 2 AS lvl, lang, source, metric, slack, k, count(*) AS n FROM b GROUP BY ALL
  UNION ALL SELECT 1, lang, NULL, metric, slack, k, count(*) FROM b GROUP BY ALL
  UNION ALL SELECT 0, NULL, NULL, metric, slack, k, count(*) FROM b GROUP BY ALL),
c AS (SELECT *, sum(n) OVER (PARTITION BY lvl, lang, source, metric ORDER BY k) AS below, sum(n) OVER (PARTITION BY lvl, lang, source, metric) AS docs FROM l),
q AS (SELECT lvl, lang, source, metric, slack, docs, min(CASE WHEN below * 4 >= docs THEN k END) AS a, min(CASE WHEN below * 4 >= docs * 3 THEN k END) AS z
  FROM c GROUP BY ALL),
f AS (SELECT lvl, lang, source, metric, docs, q1 - greatest((q3 - q1) * 3.0, slack) AS low, q3 + greatest((q3 - q1) * 3.0, slack) AS high
  FROM (SELECT *, CASE WHEN a <= 0 THEN 0 ELSE pow(1.05::DOUBLE, a - 1) END AS q1, CASE WHEN z <= 0 THEN 0 ELSE pow(1.05::DOUBLE, z - 1) END AS q3 FROM q)),
j AS (SELECT b.rid, bool_and(CASE WHEN o.docs >= 50 THEN v BETWEEN o.low AND o.high WHEN g.docs >= 50 THEN v BETWEEN g.low AND g.high
    ELSE v BETWEEN e.low AND e.high END) AS inside
  FROM b JOIN f o ON o.lvl = 2 AND o.metric = b.metric AND o.lang IS NOT DISTINCT FROM b.lang AND o.source IS NOT DISTINCT FROM b.source
  JOIN f g ON g.lvl = 1 AND g.metric = b.metric AND g.lang IS NOT DISTINCT FROM b.lang JOIN f e ON e.lvl = 0 AND e.metric = b.metric GROUP BY b.rid),
x AS (SELECT m.*, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed, inside FROM m JOIN j USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, (NOT base_failed AND inside) AS kept FROM x
"""
