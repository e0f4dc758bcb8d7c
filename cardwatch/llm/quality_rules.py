"""Quality rules: a threshold table compiled into one Spark projection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.llm.common import DOCUMENT_COLUMNS, columns_of, read_table
from cardwatch.llm.registry import query

# What counts as white space, as a symbol and as a stop word.
WHITE = " \t\n\x0b\f\r"
WHITE_RUN = r"[ \t-\r]+"
SYMBOLS = "[#*$%&|<>]"
LATIN = "[A-Za-z]+"
WIDE = r"[^\x00-\x7F]+"
STOP_WORDS = (
    "the of and to in is that it for was on with as be by at this from are or an not "
    "le la les des et un une du en que qui dans pour par sur est pas "
    "der die das und den dem von zu mit nicht ein eine sich auf auch als "
    "el los las y del se con no su lo como para por es"
).split()


@dataclass(frozen=True)
class Rule:
    """``measure`` must lie between ``low`` and ``high``, both included; None sets no bound. A
    ``latin`` rule holds for texts with at least as many Latin letters as characters beyond ASCII."""

    measure: str
    low: float | None = None
    high: float | None = None
    latin: bool = False


BASE_RULES = (
    Rule("n_words", low=50),
    Rule("repeat_word_ratio", high=0.5),
)
RULES = (
    Rule("mean_word_chars", low=2.0, high=12.0, latin=True),
    Rule("symbol_word_ratio", high=0.1),
    Rule("stop_word_ratio", low=0.02, latin=True),
    Rule("dup_line_ratio", high=0.5),
)


def _broken(rules: tuple[Rule, ...], ratios: dict[str, tuple[Column, Column]]) -> Column:
    """Rules as products, ``n > limit * d``, so that no rule divides and none is ever null."""
    out = F.lit(False)
    for rule in rules:
        n, d = ratios[rule.measure]
        broken = F.lit(False)
        if rule.low is not None:
            broken = broken | (n < F.lit(rule.low) * d)
        if rule.high is not None:
            broken = broken | (n > F.lit(rule.high) * d)
        out = out | (broken & (F.col("n_latin") >= F.col("n_wide")) if rule.latin else broken)
    return out


def measure(docs: DataFrame, *keep: str) -> DataFrame:
    """The counts of each text beside the columns ``keep``.

    Words are runs of anything but the six ASCII white-space characters. A null text has no words
    and an empty one has none either. Work per text grows as n log n of its words:

    * repeated lines are lines minus distinct lines;
    * 3-word windows are hashed (64 bits; two windows of one text share a hash with a probability
      under 1e-10 for 20 000 words), sorted with their places, and equal neighbours are repeated;
      a place covers its word and the next two, counted from the gaps between sorted places.
    """
    text, words, lines = F.col("qr_text"), F.col("qr_words"), F.col("qr_lines")
    step = columns_of(docs, *dict.fromkeys(["text", *keep])).withColumn("qr_text", F.coalesce("text", F.lit("")))
    step = step.withColumns(
        {
            "qr_words": F.array_remove(F.split(text, WHITE_RUN), ""),
            "qr_lines": F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(WHITE)) != ""),
        }
    )
    step = step.withColumn(
        "qr_windows",
        F.expr(
            "transform(slice(qr_words, 1, greatest(size(qr_words) - 2, 0)),"
            " (w, i) -> xxhash64(w, get(qr_words, i + 1), get(qr_words, i + 2)))"
        ),
    )
    # The sort gives (hash, place) pairs; the index i of a pair leads to its neighbours.
    step = step.withColumn(
        "qr_sorted",
        F.expr(
            "CASE WHEN size(array_distinct(qr_windows)) < size(qr_windows)"
            " THEN sort_array(transform(qr_windows, (x, i) -> struct(x AS h, i AS p))) END"
        ),
    )
    step = step.withColumn(
        "qr_places",
        F.expr(
            "sort_array(transform(filter(qr_sorted, (x, i) ->"
            " coalesce(x.h = get(qr_sorted, i - 1).h, false) OR coalesce(x.h = get(qr_sorted, i + 1).h, false)),"
            " x -> x.p))"
        ),
    )
    stop = sorted({w for s in STOP_WORDS for w in (s, s.capitalize(), s.upper())})
    return step.select(
        *[F.col(f"`{k}`") for k in keep],
        F.size(words).cast("long").alias("n_words"),
        F.length(F.concat_ws("", words)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.expr(
            "CASE WHEN qr_places IS NULL THEN 0L ELSE 3L + aggregate(sequence(1, size(qr_places) - 1), 0L,"
            " (s, i) -> s + least(3, get(qr_places, i) - get(qr_places, i - 1))) END"
        ).alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        F.size(F.filter(words, lambda w: w.isin(stop))).cast("long").alias("n_stop_words"),
        (F.length(text) - F.length(F.regexp_replace(text, LATIN, ""))).cast("long").alias("n_latin"),
        (F.length(text) - F.length(F.regexp_replace(text, WIDE, ""))).cast("long").alias("n_wide"),
    )


def judge(
    docs: DataFrame,
    *keep: str,
    base: tuple[Rule, ...] = BASE_RULES,
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """All counts, ``base_failed`` and ``kept``; a row for each row, whatever is null in it.

    A text without words fails the base rule on words. Empty tables give empty results. The rules on
    stop words and on the length of words know four languages that are written with Latin letters
    and blanks; texts in another script are judged by the other rules alone.
    """
    counts = measure(docs, *keep)
    words = F.col("n_words")
    ratios = {
        "n_words": (words, F.lit(1)),
        "repeat_word_ratio": (F.col("n_repeat_words"), words),
        "mean_word_chars": (F.col("word_chars"), words),
        "symbol_word_ratio": (F.col("n_symbols"), words),
        "stop_word_ratio": (F.col("n_stop_words"), words),
        "dup_line_ratio": (F.col("n_dup_lines"), F.col("n_lines")),
    }
    failed = _broken(base, ratios)
    return counts.withColumns({"base_failed": failed, "kept": ~failed & ~_broken(rules, ratios)})


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every rule; null and empty texts do not, repeated rows do alike.

    The filter names a column that is not deterministic. Without it Spark would push the filter
    below the projection and with it a copy of the whole rule table, measures included.
    """
    marked = judge(docs, *DOCUMENT_COLUMNS).withColumn("qr_mark", F.monotonically_increasing_id())
    return marked.where("kept AND qr_mark >= 0").select(*DOCUMENT_COLUMNS)


def _sql() -> str:
    bounds = []
    for rule in RULES:
        n, d = {
            "mean_word_chars": ("word_chars", "n_words"),
            "symbol_word_ratio": ("n_symbols", "n_words"),
            "stop_word_ratio": ("n_stop_words", "n_words"),
            "dup_line_ratio": ("n_dup_lines", "n_lines"),
        }[rule.measure]
        free = "n_latin < n_wide OR " * rule.latin
        if rule.low is not None:
            bounds.append(f"({free}{n} >= {rule.low}::DOUBLE * {d})")
        if rule.high is not None:
            bounds.append(f"({free}{n} <= {rule.high}::DOUBLE * {d})")
    stops = ", ".join(f"'{w}'" for s in STOP_WORDS for w in sorted({s, s.capitalize(), s.upper()}))
    white = r"[\x20\x09-\x0D]"
    return f"""
WITH t AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS x FROM documents),
s AS (SELECT *, list_filter(regexp_split_to_array(x, '{white}'), lambda w: w <> '') AS w,
             list_filter(string_split(x, chr(10)), lambda l: regexp_replace(l, '{white}', '', 'g') <> '') AS l FROM t),
g AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k
      FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM s)),
d AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c FROM g) WHERE c > 1),
p AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM d) GROUP BY r),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(x, '{white}', '', 'g'))::BIGINT AS word_chars,
             (length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(p.n, 0)::BIGINT AS n_repeat_words,
             len(l)::BIGINT AS n_lines, len(list_filter(w, lambda v: v IN ({stops})))::BIGINT AS n_stop_words,
             (length(x) - length(regexp_replace(x, '[A-Za-z]+', '', 'g')))::BIGINT AS n_latin,
             (length(x) - length(regexp_replace(x, '[^\x00-\x7F]+', '', 'g')))::BIGINT AS n_wide
      FROM s LEFT JOIN p USING (r))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND {' AND '.join(bounds)} AS kept
FROM m"""


@query("op7_quality_rules", sql=_sql())
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return judge(read_table(spark, folder, "documents"), "doc_id")
