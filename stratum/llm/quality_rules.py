"""Quality rules as a short-circuit cascade, in built-in functions only.

A rule is a condition that rejects a document, over measures of its text. On a bounded sample, the
cost of each rule (seconds to evaluate it alone) and its selectivity (share of rows rejected) are
measured, and the rules are ordered by rejection per cost. The measures that a rule needs are only
evaluated for rows that no earlier rule has rejected. The order changes only the cost: a document is
kept if and only if no rule rejects it, so the verdict doesn't depend on the sample.

Words are ``[^\\x20\\x09-\\x0D]+``. Windows of words are compared by a 64-bit hash within one text.

Defined cases: a null text counts as empty; an empty text has no words and is rejected as too short;
repeated rows give repeated rows; an empty table gives an empty result; extra columns stay untouched
(working columns have a prefix of their own).
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import TMP, stored, text_or_empty

SPACES, SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"
#: Rows on which the cascade's order is estimated.
SAMPLE_ROWS = 2000
#: Runs of a rule, of which the fastest counts.
TIMES = 3


def m(name: str) -> Column:
    """A measure's working column."""
    return F.col(TMP + name)


def _without(text: Column, chars: str, instead: str = "") -> Column:
    """Plain replacements: far cheaper than translate() or a pattern, above all where nothing is found."""
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(instead))
    return text


def _length(text: Column) -> Column:
    return F.length(text).cast("long")


def _placed() -> Column:
    """(hash, place) of the 3-word windows, by hash; empty if all hashes differ."""
    hashes = m("windows")
    pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), F.sort_array(pairs))


def _places() -> Column:
    """Places of the windows whose hash stands next to an equal one, in order."""
    s = m("placed")
    taken = F.transform(s, lambda x, k: F.when(
        (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]), x["i"]))
    return F.sort_array(F.filter(taken, lambda i: i.isNotNull()))


def _covered() -> Column:
    """Words that the windows at these places cover, each once."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last"))
    n = F.aggregate(m("places"), start, lambda a, i: F.struct(
        (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")), lambda a: a["n"])
    return F.coalesce(n, F.lit(0).cast("long"))


#: Measure -> (measures it needs, its expression over their columns).
MEASURES: dict[str, tuple[tuple[str, ...], Callable[[], Column]]] = {
    "flat": ((), lambda: _without(m("text"), SPACES[1:], " ")),
    "words": (("flat",), lambda: F.array_remove(F.split(m("flat"), " "), "")),
    "n_words": (("words",), lambda: F.size(m("words")).cast("long")),
    "word_chars": (("flat",), lambda: _length(_without(m("flat"), " "))),
    "chars": ((), lambda: _length(m("text"))),
    "n_symbols": (("chars",), lambda: m("chars") - _length(_without(m("text"), SYMBOLS))),
    "n_bangs": (("chars",), lambda: m("chars") - _length(_without(m("text"), "!"))),
    "lines": ((), lambda: F.filter(F.split(m("text"), "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))),
    "n_lines": (("lines",), lambda: F.size(m("lines")).cast("long")),
    "n_dup_lines": (("lines", "n_lines"), lambda: m("n_lines") - F.size(F.array_distinct(m("lines")))),
    "windows": (("words",), lambda: F.transform(
        F.slice(m("words"), 1, F.greatest(F.size(m("words")) - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(m("words"), i + 1), F.get(m("words"), i + 2)))),
    "placed": (("windows",), _placed),
    "places": (("placed",), _places),
    "n_repeat_words": (("places",), _covered),
}


@dataclass(frozen=True)
class Rule:
    name: str
    needs: tuple[str, ...]
    rejects: Callable[[], Column]


BASE_RULES = (
    Rule("too_short", ("n_words",), lambda: m("n_words") < 50),
    Rule("repetition", ("n_words", "n_repeat_words"),
         lambda: 100 * m("n_repeat_words") > 50 * m("n_words")),
)
#: Thresholds: a symbol or an exclamation mark for every tenth word; words of 3 to 12 characters on
#: average; half of the lines repeated.
MORE_RULES = (
    Rule("symbols", ("n_words", "n_symbols"), lambda: 10 * m("n_symbols") > m("n_words")),
    Rule("exclamation", ("n_words", "n_bangs"), lambda: 10 * m("n_bangs") > m("n_words")),
    Rule("word_length", ("n_words", "word_chars"), lambda:
         (m("word_chars") < 3 * m("n_words")) | (m("word_chars") > 12 * m("n_words"))),
    Rule("repeated_lines", ("n_lines", "n_dup_lines"), lambda: 2 * m("n_dup_lines") > m("n_lines")),
)
RULES = BASE_RULES + MORE_RULES


def with_text(docs: DataFrame, text_col: str = "text") -> DataFrame:
    return docs.withColumn(TMP + "text", text_or_empty(text_col))


def measured(df: DataFrame, names: tuple[str, ...], alive: Column | None = None) -> DataFrame:
    """Add measures that ``df`` lacks, evaluated only where ``alive`` holds."""
    for name in names:
        if TMP + name not in df.columns:
            needs, make = MEASURES[name]
            df = measured(df, needs, alive)
            df = df.withColumn(TMP + name, make() if alive is None else F.when(alive, make()))
    return df


def cascade(df: DataFrame, rules: tuple[Rule, ...], alive: Column | None = None) -> DataFrame:
    """Add the working column ``rejected_by``: the first rule, in the order given, that rejects."""
    df = df.withColumn(TMP + "rejected_by", F.lit(None).cast("string") if alive is None
                       else F.when(~alive, F.lit("before")))
    for rule in rules:
        open_ = m("rejected_by").isNull()
        df = measured(df, rule.needs, open_)
        df = df.withColumn(TMP + "rejected_by", F.when(open_, F.when(rule.rejects(), F.lit(rule.name)))
                           .otherwise(m("rejected_by")))
    return df


def kept() -> Column:
    """Whether no rule has rejected the row. The number, always true, is not deterministic to Spark, so
    a filter on this column isn't pushed below the columns that it rests on; there, the array of
    words would be built anew for each window."""
    return m("rejected_by").isNull() & (F.monotonically_increasing_id() >= 0)


def ordered_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS,
                  text_col: str = "text") -> tuple[Rule, ...]:
    """The rules by rejection per cost on a sample of about ``sample_rows`` rows, an even share of all.

    A rule's cost is the least time of some runs beyond that of only going over the sample, so that
    scheduling doesn't count. The order changes the cost of the cascade, never its verdicts."""
    rows = docs.agg(F.count(F.lit(1))).collect()[0][0]
    share = min(1.0, sample_rows / max(1, rows))
    drawn = docs.select(text_col) if share == 1.0 else docs.select(text_col).sample(share, seed=17)
    sample = with_text(stored(drawn, "quality_sample"), text_col)

    def least(job) -> tuple[float, list]:
        out = []
        for _ in range(TIMES):
            began = time.perf_counter()
            out = job.collect()[0]
            times.append(time.perf_counter() - began)
        return min(times[-TIMES:]), out

    times: list[float] = []
    idle, _ = least(sample.agg(F.count("*"), F.sum(F.length(m("text")))))

    def worth(rule: Rule) -> float:
        took, (n, out) = least(measured(sample, rule.needs).agg(F.count("*"), F.count_if(rule.rejects())))
        return (out / n if n else 0.0) / max(took - idle, 1e-4)

    return tuple(sorted(rules, key=worth, reverse=True))


def quality(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Per row: the id, n_words, the base measures, base_failed and kept. One pass, no shuffle."""
    rest = ordered_rules(docs, MORE_RULES, sample_rows, text_col)
    df = with_text(docs.select(id_col, text_col), text_col)
    df = measured(df, ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
    failed = F.lit(False)
    for rule in BASE_RULES:
        failed = failed | rule.rejects()
    df = df.withColumn(TMP + "failed", failed)
    df = cascade(df, rest, ~m("failed"))
    return df.select(id_col, *[m(c).alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        m("failed").alias("base_failed"), kept().alias("kept"))


def keep_good(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, text_col: str = "text") -> DataFrame:
    """The rows that no rule rejects, with their columns as they were."""
    df = cascade(with_text(docs, text_col), ordered_rules(docs, RULES, sample_rows, text_col))
    own = [F.col(f"`{c}`") for c in docs.columns]
    return df.select(*own, kept().alias(TMP + "kept")).filter(m("kept")).select(*own)


_WORD = "'[^ \\t-\\r]+'"
ORACLE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, {_WORD}) AS ws FROM d),
pos AS (SELECT r, ws, unnest(generate_series(1, len(ws))) AS i FROM w),
win AS (SELECT r, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c FROM pos WHERE i + 2 <= len(ws)),
cnt AS (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM win),
hit AS (SELECT r, count(DISTINCT p) AS n_repeat_words
        FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM cnt WHERE n > 1) GROUP BY r),
ln AS (SELECT r, count(*) AS n_lines, count(DISTINCT line) AS n_distinct
       FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)
       WHERE regexp_matches(line, {_WORD}) GROUP BY r),
f AS (SELECT w.doc_id, len(ws) AS n_words, length(regexp_replace(t, '[ \\t-\\r]', '', 'g')) AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        coalesce(n_lines - n_distinct, 0) AS n_dup_lines, coalesce(n_lines, 0) AS n_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words,
        length(regexp_replace(t, '[^!]', '', 'g')) AS bangs
      FROM w LEFT JOIN hit ON w.r = hit.r LEFT JOIN ln ON w.r = ln.r),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 10 * bangs > n_words OR word_chars < 3 * n_words
       OR word_chars > 12 * n_words OR 2 * n_dup_lines > n_lines) AS kept
FROM b
"""
