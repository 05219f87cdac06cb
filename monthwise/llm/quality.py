"""Operator 2: quality rules as a short-circuit cascade, native expressions only.

A rule is a named predicate that rejects a text.  ``plan_cascade`` measures on a
bounded sample how often each rule rejects and what it costs, and orders the
rules by rejection per cost; ``passes`` is one CASE expression in that order, so
a rejected text is not looked at by the later rules.  The order never changes
the verdict (a text passes when no rule rejects it), so a poor sample costs time
only.  The cost of a rule is its work per character, word and line (fixed unit
weights) times the sample's mean numbers of these.

Everything is built from SQL functions and runs inside the JVM: one scan, no
shuffle, no Python.  Repeated windows are found by sorting window hashes with
their positions, so a text of n words takes n log n steps.

Defined results: a null text is an empty one, which the word minimum rejects;
repeated rows get equal results; an empty table gives an empty result and the
declared rule order; extra columns are kept by ``quality_filter`` and cannot
clash, because no helper column is added.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 5                      # words in a repeat window
SAMPLE_ROWS = 1000              # expected size of the sample that orders the cascade
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over one evaluation of ``value`` (a lambda binding)."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def word_lines(text: Column) -> Column:
    """The \\n-split lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))


def n_dup_lines(lines: Column) -> Column:
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def n_symbols(text: Column) -> Column:
    return F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long")


def word_chars(ws: Column) -> Column:
    return F.length(F.array_join(ws, "")).cast("long")


def n_repeat_words(ws: Column, window: int = WINDOW) -> Column:
    """Words that lie in a window found twice or more in the text."""
    zero = F.lit(0).cast("long")

    def covered(positions):
        gaps = F.transform(positions, lambda p, i: F.least(F.lit(window), p - F.coalesce(
            F.get(positions, i - 1), F.lit(-window))).cast("long"))
        return F.aggregate(gaps, zero, lambda a, x: a + x)

    def positions(at):
        again = F.filter(at, lambda x, i: F.coalesce(F.get(at, i - 1)["h"] == x["h"], F.lit(False))
                         | F.coalesce(F.get(at, i + 1)["h"] == x["h"], F.lit(False)))
        return F.sort_array(F.transform(again, lambda x: x["p"]))

    def repeats(hashes):
        pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p")))
        found = let(F.sort_array(pairs), lambda at: let(positions(at), covered))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), zero).otherwise(found)

    def windows(hs):
        return F.transform(F.sequence(F.lit(0), F.size(hs) - window),
                           lambda i: F.xxhash64(*[F.get(hs, i + j) for j in range(window)]))

    return let(F.transform(ws, lambda w: F.xxhash64(w)),
               lambda hs: F.when(F.size(hs) < window, zero).otherwise(let(windows(hs), repeats)))


@dataclass(frozen=True)
class Rule:
    """``reject`` takes the text and its words.  Costs are per character, word and line."""
    name: str
    reject: Callable[[Column, Column], Column]
    per_char: float = 0.0
    per_word: float = 0.0
    per_line: float = 0.0


def _n(ws):
    return F.size(ws)


#: Verdict rules beside the two base rules.  Limits are loose: they are meant to
#: reject symbol noise, table fragments, shouting and repeated lines, not prose.
RULES = (
    Rule("symbol_words", lambda t, w: 100 * n_symbols(t) > 20 * _n(w), per_char=1.0),
    Rule("mean_word_length", lambda t, w: (word_chars(w) < 2 * _n(w)) | (word_chars(w) > 20 * _n(w)), per_char=0.3),
    Rule("words_without_letters",
         lambda t, w: 2 * F.size(F.filter(w, lambda x: x.rlike(r"\p{L}"))) < _n(w), per_word=10.0),
    Rule("upper_case", lambda t, w: let(F.length(F.regexp_replace(t, r"[^\p{Lu}]+", "")), lambda up: (up >= 20) & (
        10 * up > 7 * F.length(F.regexp_replace(t, r"[^\p{L}]+", "")))), per_char=2.0),
    Rule("repeated_lines", lambda t, w: let(word_lines(t), lambda x: 100 * n_dup_lines(x) > 30 * F.size(x)),
         per_char=1.0, per_line=10.0),
)
BASE_RULES = (
    Rule("few_words", lambda t, w: _n(w) < 10, per_word=0.1),
    Rule("repeated_words", lambda t, w: 100 * n_repeat_words(w) > 20 * _n(w), per_word=60.0),
)


def plan_cascade(docs: DataFrame, text_col: str = "text", rules=RULES + BASE_RULES,
                 sample_rows: int = SAMPLE_ROWS) -> list[tuple[Rule, float, float]]:
    """Rules with their (rejection rate, cost) on a sample of about ``sample_rows`` rows from
    all parts of the table, by rejection per cost; ties keep the declared order."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    share = sample_rows / max(1, docs.count())
    sample = docs if share >= 1 else docs.sample(share, seed=5)
    judged = sample.select(let(F.struct(text.alias("t"), words(text).alias("w")), lambda x: F.struct(
        F.length(x["t"]).alias("chars"), F.size(x["w"]).alias("words"), F.size(F.split(x["t"], "\n")).alias("lines"),
        *[r.reject(x["t"], x["w"]).cast("int").alias(f"r{i}") for i, r in enumerate(rules)])).alias("q")).select("q.*")
    seen = judged.agg(*[F.avg(c).alias(c) for c in judged.columns]).first()
    out = []
    for i, r in enumerate(rules):
        cost = 1 + r.per_char * (seen["chars"] or 0) + r.per_word * (seen["words"] or 0) + r.per_line * (seen["lines"] or 0)
        out.append((r, float(seen[f"r{i}"] or 0), cost))
    return sorted(out, key=lambda x: -x[1] / x[2])


def cascade(text: Column, ws: Column, rules) -> Column:
    """True when no rule rejects; rules run in order and stop at the first rejection."""
    out = None
    for r in rules:
        hit = r.reject(text, ws)
        out = F.when(hit, F.lit(False)) if out is None else out.when(hit, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def passes(text_col: str, rules) -> Column:
    """The verdict on one text column, its words split once."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return let(F.struct(text.alias("t"), words(text).alias("w")), lambda x: cascade(x["t"], x["w"], rules))


def quality_filter(docs: DataFrame, text_col: str = "text", rules=RULES + BASE_RULES) -> DataFrame:
    """The rows that no rule rejects, all columns as they were."""
    order = [r for r, _, _ in plan_cascade(docs, text_col, rules)]
    return docs.where(passes(text_col, order))


def measures(text: Column, order) -> Column:
    """struct of the base measures and both verdicts of one text."""
    def of(x):
        ws = x["w"]
        return F.struct(F.size(ws).cast("long").alias("n_words"), word_chars(ws).alias("word_chars"),
                        n_symbols(x["t"]).alias("n_symbols"), n_dup_lines(word_lines(x["t"])).alias("n_dup_lines"),
                        n_repeat_words(ws).alias("n_repeat_words"), x["t"].alias("t"), ws.alias("w"))

    def verdicts(m):
        base = (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        return F.struct(*[m[c].alias(c) for c in names], base.alias("base_failed"),
                        F.when(base, F.lit(False)).otherwise(cascade(m["t"], m["w"], order)).alias("kept"))

    text = F.coalesce(text.cast("string"), F.lit(""))
    return let(let(F.struct(text.alias("t"), words(text).alias("w")), of), verdicts)


def op2_quality_rules(spark, sf_dir: str) -> DataFrame:
    from monthwise.llm.common import table
    docs = table(spark, sf_dir, "documents")
    order = [r for r, _, _ in plan_cascade(docs, rules=RULES)]
    return docs.select("doc_id", measures(F.col("text"), order).alias("q")).select("doc_id", "q.*")


# DuckDB's form of the contract's measures and of the verdict (RULES above).
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
p AS (SELECT rid, unnest(range(1, len(ws) - 3)) AS i,
             unnest(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) AS g
      FROM w WHERE len(ws) >= 5),
r AS (SELECT rid, i FROM p QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
c AS (SELECT rid, sum(gap) AS n FROM (SELECT rid, least(5, i - lag(i, 1, i - 5) OVER (PARTITION BY rid ORDER BY i)) AS gap
      FROM r) GROUP BY rid),
m AS (SELECT doc_id, t, ws, ls, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
             length(regexp_replace(t, '[^\p{Lu}]+', '', 'g')) AS up,
             length(regexp_replace(t, '[^\p{L}]+', '', 'g')) AS letters
      FROM w LEFT JOIN c USING (rid)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 20 * n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words
            OR 2 * len(list_filter(ws, lambda x: regexp_matches(x, '\p{L}'))) < n_words
            OR (up >= 20 AND 10 * up > 7 * letters) OR 100 * n_dup_lines > 30 * len(ls)) AS kept
FROM b
"""
