"""Quality rules: a table of thresholds compiled into one projection over length, symbol, stop-word and line ratios.

No user functions and no shuffle: every measure is an expression of the row's own text, so that cost and memory follow the
longest text alone. A rule is (name, measure, lowest, highest): a text fails it when the measure is below or above.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, SPACE_RUN, col, documents, fresh, words

#: Frequent words of English, German, French and Spanish. Fixed values.
STOP_WORDS = (
    "the of and to a in is that for it was on with be as by this are at from or an have not but "
    "der die und in den von zu das sich mit auf des für ist nicht im dem ein eine als auch es an "
    "de la le et les des en un du une que pour est qui dans par pas au sur avec ce il ne se plus "
    "el y los del las por no con su para al lo como más o pero sus"
).split()
#: Words of one window whose repetition counts.
WINDOW = 5


class Rule(NamedTuple):
    name: str
    measure: str
    least: float | None
    most: float | None
    #: The rule is put to texts of so many words at least.
    words: int = 0


#: The two base rules of the query's contract come first; the others are the verdict.
BASE_RULES = (Rule("short", "n_words", 10, None), Rule("repeated_windows", "repeat_ratio", None, 0.2))
RULES = (
    Rule("symbols", "symbol_ratio", None, 0.1),
    Rule("capitals", "upper_ratio", None, 0.3),
    Rule("duplicate_lines", "dup_line_ratio", None, 0.5),
    Rule("stutter", "stutter_ratio", None, 0.2),
    Rule("word_length", "mean_word_length", 2.0, 20.0),
    Rule("no_stop_words", "stop_word_ratio", 0.005, None, 100),
)


def measured(df: DataFrame, text: str) -> tuple[DataFrame, dict[str, Column]]:
    """df with working columns, and the measures as columns over it."""
    w, h, g, s, d, n = fresh(df, "words", "hashes", "windows", "sorted", "repeats", "lines")
    body = F.coalesce(col(text), F.lit(""))
    df = df.withColumn(w, words(col(text)))
    df = df.withColumn(h, F.transform(w, lambda x: F.xxhash64(x))).withColumn(n, F.filter(F.split(body, "\n", -1), lambda x: F.btrim(x, F.lit(SPACE)) != ""))
    at = lambda i: F.get(F.col(h), i)
    df = df.withColumn(
        g, F.when(F.size(h) < WINDOW, F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(*[at(i + j) for j in range(WINDOW)])))
    )
    # only texts with a window that occurs twice pay for the sort; equal hashes are compared word by word
    df = df.withColumn(s, F.when(F.size(F.array_distinct(g)) < F.size(g), F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    # word by word, as slicing an array copies all of it
    same = lambda x, y: reduce(lambda a, b: a & b, [x["h"] == y["h"], *(F.get(F.col(w), x["i"] + k) == F.get(F.col(w), y["i"] + k) for k in range(WINDOW))])
    near = lambda x, j: F.coalesce(same(x, F.get(F.col(s), j)), F.lit(False))
    df = df.withColumn(d, F.sort_array(F.transform(F.filter(s, lambda x, i: near(x, i - 1) | near(x, i + 1)), lambda x: x["i"])))
    covered = F.aggregate(
        d, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), lambda a, i: F.struct((i + WINDOW).alias("end"), (a["n"] + F.least(F.lit(WINDOW), i + WINDOW - a["end"])).alias("n")), lambda a: a["n"]
    )
    count, lines = F.size(w), F.size(n)
    m: dict[str, Column] = {
        "n_words": count,
        "word_chars": F.char_length(F.regexp_replace(body, SPACE_RUN, "")),
        "n_symbols": F.char_length(F.regexp_replace(body, r"[^#*$%&|<>]+", "")),
        "n_dup_lines": lines - F.size(F.array_distinct(n)),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
        "n_lines": lines,
        "n_upper": F.char_length(F.regexp_replace(body, r"[^\p{Lu}]+", "")),
        "n_stutter": F.when(count < 2, 0).otherwise(F.size(F.filter(F.sequence(F.lit(1), count - 1), lambda i: at(i) == at(i - 1)))),
        "n_stop_words": F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))),
    }
    return df, {k: v.cast("long") for k, v in m.items()}


#: ratio: (numerator, denominator) among the measures; 0 where the denominator is 0.
RATIOS = {
    "repeat_ratio": ("n_repeat_words", "n_words"), "symbol_ratio": ("n_symbols", "n_words"), "upper_ratio": ("n_upper", "word_chars"), "dup_line_ratio": ("n_dup_lines", "n_lines"),
    "stutter_ratio": ("n_stutter", "n_words"), "mean_word_length": ("word_chars", "n_words"), "stop_word_ratio": ("n_stop_words", "n_words"),
}


def failed(rule: Rule, at) -> Column:
    """Whether the rule fails; compared as numerator against bound * denominator, so nothing is divided. at: measure -> column."""
    top, below = RATIOS.get(rule.measure, (rule.measure, None))
    scale = (lambda x: F.lit(float(x)) * at(below)) if below else (lambda x: F.lit(float(x)))
    bad = ([] if rule.least is None else [at(top) < scale(rule.least)]) + ([] if rule.most is None else [at(top) > scale(rule.most)])
    return reduce(lambda a, b: a | b, bad) & (at("n_words") >= rule.words)


def judge(df: DataFrame, text: str = "text", base: Sequence[Rule] = BASE_RULES, rules: Sequence[Rule] = RULES) -> tuple[DataFrame, str]:
    """df and one more column, whose name is returned: a struct of the measures, base_failed, failed (names of rules), kept.

    Null or empty texts have no words: all counts are 0 and they fail the rule on length. Very long texts are judged whole.
    Rows are judged one by one, so repeated rows get equal verdicts; other columns pass through whatever their names.
    """
    (out,) = fresh(df, "quality")
    plain = df.columns
    work, measures = measured(df, text)
    # a filter moves below a projection only if that is deterministic; moved, it would measure each text anew for each rule
    fence = F.monotonically_increasing_id().alias("row")
    work = work.select(*[col(c) for c in plain], F.struct(*[v.alias(k) for k, v in measures.items()], fence).alias(out))
    at = lambda k: F.col(out)[k]
    named = lambda r: F.when(failed(r, at), F.lit(r.name))
    bad = F.array_compact(F.array(*[named(r) for r in (*base, *rules)]))
    basic = reduce(lambda a, b: a | b, [failed(r, at) for r in base], F.lit(False))
    return work.withColumn(out, F.struct(*[at(k).alias(k) for k in measures], at("row").alias("row"), basic.alias("base_failed"), bad.alias("failed"), (F.size(bad) == 0).alias("kept"))), out


def keep_good(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows of df that break no rule, with df's columns."""
    judged, q = judge(df, text)
    return judged.filter(F.col(q)["kept"]).select(*[col(c) for c in df.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    judged, q = judge(docs)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select("doc_id", *[F.col(q)[x].alias(x) for x in names], F.array_join(F.col(q)["failed"], ",").alias("failed_rules"))


_IN = ", ".join("'" + x + "'" for x in sorted(set(STOP_WORDS)))


def _sql_rule(r: Rule) -> str:
    top, below = RATIOS.get(r.measure, (r.measure, None))
    scale = f" * {below}" if below else ""
    parts = [f"{top} {op} {float(x)}::DOUBLE{scale}" for op, x in (("<", r.least), (">", r.most)) if x is not None]
    return f"(({' OR '.join(parts)}) AND n_words >= {r.words})"


SQL = f"""
WITH base AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body FROM documents),
split AS (SELECT rid, regexp_extract_all(body, '[^\\x20\\x09-\\x0D]+') AS ws FROM base),
word AS (SELECT rid, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM split),
win AS (
  SELECT rid, i, w, lag(w) OVER p AS prev,
         CASE WHEN lead(w, 4) OVER p IS NOT NULL THEN [w, lead(w, 1) OVER p, lead(w, 2) OVER p, lead(w, 3) OVER p, lead(w, 4) OVER p] END AS g
  FROM word WINDOW p AS (PARTITION BY rid ORDER BY i)
),
rep AS (SELECT *, CASE WHEN g IS NOT NULL AND count(*) OVER (PARTITION BY rid, g) > 1 THEN 1 ELSE 0 END AS r FROM win),
cov AS (SELECT *, max(r) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS c FROM rep),
per AS (
  SELECT rid, count(*) AS n_words, sum(length(w)) AS word_chars, sum(c) AS n_repeat_words,
         count(*) FILTER (WHERE w = prev) AS n_stutter, count(*) FILTER (WHERE lower(w) IN ({_IN})) AS n_stop_words
  FROM cov GROUP BY rid
),
line AS (SELECT rid, unnest(string_split(body, chr(10))) AS l FROM base),
lines AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines FROM line WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY rid),
m AS (
  SELECT b.doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, coalesce(n_stutter, 0) AS n_stutter,
         coalesce(n_stop_words, 0) AS n_stop_words, length(regexp_replace(body, '[^\\p{{Lu}}]+', '', 'g')) AS n_upper
  FROM base b LEFT JOIN per USING (rid) LEFT JOIN lines USING (rid)
),
f AS (
  SELECT *, {' OR '.join(_sql_rule(r) for r in BASE_RULES)} AS base_failed,
         concat_ws(',', {', '.join(f"CASE WHEN {_sql_rule(r)} THEN '{r.name}' END" for r in (*BASE_RULES, *RULES))}) AS failed_rules
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, failed_rules = '' AS kept, failed_rules FROM f
"""
