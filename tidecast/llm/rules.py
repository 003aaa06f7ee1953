"""Quality rules as a short-circuit cascade of native expressions (operator 2).

The cost and the selectivity of every rule are estimated on a sample; rules
are then tried in the order of rejections per cost, and a row leaves the
cascade at the first rule it breaks.  Everything is a DataFrame expression.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import columns_of, fresh, materialize

#: White space that separates words (fixed by the word definition ``[^\x20\x09-\x0D]+``).
SPACE = r"[ \t-\r]+"
#: Characters that count as symbols (fixed values).
SYMBOLS = "#*$%&|<>"
#: Rows of the sample on which costs and selectivities are estimated, about.
SAMPLE_ROWS = 2000


def text_of(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text, in order."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(text, SPACE, "")).cast("bigint")


def n_symbols(text: Column) -> Column:
    return F.length(F.regexp_replace(text, "[^" + SYMBOLS + "]+", "")).cast("bigint")


def n_upper(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"\P{Lu}+", "")).cast("bigint")


def lines(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^ \t-\r]"))


def n_dup_lines(text: Column) -> Column:
    at = lines(text)
    return (F.size(at) - F.size(F.array_distinct(at))).cast("bigint")


def n_repeat_words(text: Column, window: int = 5) -> Column:
    """Words in windows of ``window`` words that are found twice or more in the text.

    Windows are compared by hash first: where all hashes differ no window is
    repeated.  Only for the other texts the windows themselves are sorted with
    their places, so the answer is exact.
    """
    def gram(w: Column, i: Column) -> Column:
        return F.array_join(F.slice(w, i + 1, window), " ")

    def repeated(w: Column) -> Column:
        last = F.size(w) - window
        hashes = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(window)]))
        placed = F.array_sort(F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(gram(w, i).alias("g"), i.alias("i"))))
        starts = F.transform(F.array(placed), lambda p: F.array_sort(F.transform(
            F.filter(F.sequence(F.lit(0), last), lambda j: (
                ((j > 0) & (F.get(p, j - 1)["g"] == F.get(p, j)["g"])) |
                ((j < last) & (F.get(p, j + 1)["g"] == F.get(p, j)["g"])))),
            lambda j: F.get(p, j)["i"])))
        covered = F.transform(starts, lambda s: F.aggregate(
            s, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
            lambda a, i: F.struct((a["n"] + i + window - F.greatest(a["end"], i)).alias("n"), (i + window).alias("end")),
            lambda a: a["n"]))
        return (F.when(F.size(w) < window, F.lit(0))
                .when(F.size(F.array_distinct(hashes)) == last + 1, F.lit(0))
                .otherwise(F.get(covered, F.lit(0))))

    return F.get(F.transform(F.array(words(text)), repeated), F.lit(0)).cast("bigint")


@dataclass(frozen=True)
class Rule:
    """``breaks`` maps a text expression to a boolean: the rule rejects the text."""

    name: str
    breaks: object


#: The two base rules, and those of the method's own verdict.
BASE = (
    Rule("few_words", lambda t: n_words(t) < 10),
    Rule("repeated_windows", lambda t: 100 * n_repeat_words(t) > 20 * n_words(t)),
)
MORE = (
    Rule("symbols", lambda t: 100 * n_symbols(t) > 20 * n_words(t)),
    Rule("upper_case", lambda t: 100 * n_upper(t) > 50 * word_chars(t)),
    Rule("long_words", lambda t: word_chars(t) > 20 * n_words(t)),
    Rule("duplicate_lines", lambda t: 100 * n_dup_lines(t) > 50 * F.size(lines(t))),
)


def order_rules(docs: DataFrame, rules=BASE + MORE, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[dict]:
    """Rules with their sampled cost (seconds a row) and selectivity, most rejections per cost first.

    The sample is drawn by chance over the whole table, about ``sample_rows``
    rows.  The order affects the time a cascade takes, never its verdicts.
    """
    text = docs.select(text_of(F.col(text_col)).alias("t"))
    total = text.count()
    share = min(1.0, sample_rows / max(total, 1))
    sample = materialize((text if share == 1.0 else text.sample(share, seed=11)).coalesce(2))
    out = []
    base = None
    for rule in (None, *rules):
        began = time.perf_counter()
        hit = F.lit(False) if rule is None else F.coalesce(rule.breaks(F.col("t")), F.lit(False))
        n, k = sample.agg(F.count("*"), F.coalesce(F.count_if(hit & (F.length("t") >= 0)), F.lit(0))).first()
        took = time.perf_counter() - began
        if rule is None:
            base = took
            continue
        cost = max(took - base, 1e-3) / max(n, 1)
        out.append({"rule": rule, "cost": cost, "selectivity": k / max(n, 1)})
    return sorted(out, key=lambda r: (-r["selectivity"] / r["cost"], r["rule"].name))


def first_broken(text: Column, ordered) -> Column:
    """Name of the first rule in the given order that rejects the text, null if none does.

    A CASE expression: a later rule is evaluated only for rows that no earlier rule rejects.
    """
    out = None
    for r in ordered:
        hit = F.coalesce(r.breaks(text), F.lit(False))
        out = F.when(hit, F.lit(r.name)) if out is None else out.when(hit, F.lit(r.name))
    return out if out is not None else F.lit(None).cast("string")


def cascade(docs: DataFrame, rules=BASE + MORE, text_col: str = "text", into: str = "broken_rule",
            sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with the column ``into``: the rule that rejected the row first, null for kept rows.

    A null text has no words.  Every row is judged on its whole text by
    itself, so ties and repeated rows are judged alike; an empty table gives
    no rows; a column of the name ``into`` is replaced, all others pass.
    """
    ordered = [r["rule"] for r in order_rules(docs, rules, text_col, sample_rows)]
    return docs.withColumn(into, first_broken(text_of(F.col(text_col)), ordered))


def kept(docs: DataFrame, rules=BASE + MORE, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with their columns, whatever their names."""
    broken, = fresh(docs, "__broken")
    return cascade(docs, rules, text_col, broken).where(F.col(broken).isNull()).select(*columns_of(docs))


def base_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, the five base counts, ``base_failed`` and ``kept`` of every row.

    ``base_failed``: fewer than 10 words, or over 20 % of the words in repeated
    5-word windows.  ``kept`` is the verdict of the cascade over the other
    rules for rows that pass the base.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_of(F.col(text_col)).alias("t"))
    ordered = [r["rule"] for r in order_rules(rows, MORE, "t", sample_rows)]
    counted = rows.select("doc_id", "t", n_words(F.col("t")).alias("n_words"), word_chars(F.col("t")).alias("word_chars"),
                          n_symbols(F.col("t")).alias("n_symbols"), n_dup_lines(F.col("t")).alias("n_dup_lines"),
                          n_repeat_words(F.col("t")).alias("n_repeat_words"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    verdict = F.when(failed, F.lit(False)).when(first_broken(F.col("t"), ordered).isNotNull(), F.lit(False)).otherwise(True)
    return counted.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                          failed.alias("base_failed"), verdict.alias("kept"))


#: DuckDB twin of ``base_counts`` over ``documents``.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, list_filter(regexp_split_to_array(t, '[ \t-\r]+'), lambda x: x <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]')) AS l FROM d),
g AS (SELECT r, i, array_to_string(w[i:i+4], ' ') AS g
      FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM g) WHERE c > 1),
cov AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM rep) GROUP BY r),
c AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[ \t-\r]+', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
             (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
             length(regexp_replace(t, '[^\p{Lu}]+', '', 'g')) AS up, len(l) AS n_lines
      FROM w LEFT JOIN cov USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR 100 * n_symbols > 20 * n_words
            OR 100 * up > 50 * word_chars OR word_chars > 20 * n_words OR 100 * n_dup_lines > 50 * n_lines) AS kept
FROM c
"""
