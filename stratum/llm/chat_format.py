"""Chat formatting with tool-call linking, in DataFrame functions.

Calls and results are linked by identifier with a hash join inside each conversation; calls are ordered
topologically by the calls they depend on; arguments are validated against the tools' schemas; each
call becomes one record of canonical JSON (sorted keys, no blanks), so no conversation is ever
collected into one row or task.

A dependency names one earlier call. Depths come from pointer doubling: each round looks twice as far,
so a chain of n calls takes about log2(n) joins. A call whose dependency is missing starts a chain; calls
on a cycle, or that depend on one, have depth null and come last.

Defined cases: of several calls or results with one identifier, the one of the smallest turn (then text)
counts and the number of all is reported; null identifiers never link, and they and results without a
call are rows of ``unlinked``; arguments that aren't a JSON
object are invalid and stay null in the record; an empty table gives an empty result; extra columns
don't matter.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import dropped, stored

#: Tool -> argument -> (JSON type, required, largest length or value or null). Production schemas.
SCHEMAS: Mapping[str, Mapping[str, tuple[str, bool, int | None]]] = {
    "search": {"query": ("string", True, 400), "turn": ("integer", True, None)},
    "summarise": {"query": ("string", True, 300), "turn": ("integer", True, 200),
                  "words": ("integer", True, None)},
}
TYPES = {"string": ("STRING",), "integer": ("BIGINT",), "number": ("BIGINT", "DOUBLE", "DECIMAL"),
         "boolean": ("BOOLEAN",)}


def valid(tool: Column, arguments: Column, schemas=SCHEMAS) -> Column:
    """Whether arguments (JSON text) fit the tool's schema: an object, all required keys, no other
    keys, each of its type and within its bound. An unknown tool is never valid."""
    value = F.try_parse_json(arguments)
    keys = F.json_object_keys(arguments)
    out = F.lit(False)
    for name, schema in schemas.items():
        fits = keys.isNotNull()
        if schema:
            fits = fits & (F.size(F.array_except(keys, F.array(*map(F.lit, schema)))) == 0)
        for key, (kind, required, most) in schema.items():
            own = F.try_variant_get(value, f"$.{key}", "variant")
            told = F.regexp_extract(F.schema_of_variant(own), "^[A-Z]+", 0)
            good = told.isin(*TYPES[kind])
            if most is not None:
                size = F.length(F.try_variant_get(value, f"$.{key}", "string")) if kind == "string" \
                    else F.try_variant_get(value, f"$.{key}", "double")
                good = good & (size <= most)
            missing = ~F.array_contains(keys, key)
            fits = fits & F.coalesce(good if required else missing | good, F.lit(False))
        out = F.when(tool == name, F.coalesce(fits, F.lit(False))).otherwise(out)
    return out


def first_of(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the smallest by ``order``, and how many there were. Aggregated map-side."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min(F.struct(*order, *[c for c in rest if c not in order])).alias("first"),
                                 F.count("*").alias("copies")) \
        .select(*keys, "first.*", "copies")


def depths(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, depth) of calls (conv_id, call_id, depends_on): the number of calls before it on
    its chain; null on a cycle."""
    known = calls.select(F.col("conv_id").alias("c"), F.col("call_id").alias("known"))
    links = calls.join(known, (F.col("c") == F.col("conv_id")) & (F.col("known") == F.col("depends_on")), "left") \
        .select("conv_id", "call_id", F.col("known").alias("up"),
                F.when(F.col("known").isNull(), 0).otherwise(1).cast("long").alias("depth"))
    links = stored(links, "chat_depths")
    n, seen = links.count(), 1
    while links.filter("up IS NOT NULL").limit(1).count():
        if seen > 2 * max(1, n):  # longer than any chain: what is left lies on or behind a cycle
            break
        above = links.select(F.col("conv_id").alias("c"), F.col("call_id").alias("at"),
                             F.col("up").alias("next"), F.col("depth").alias("more"))
        after = links.join(above, (F.col("c") == F.col("conv_id")) & (F.col("at") == F.col("up")), "left") \
            .select("conv_id", "call_id", F.col("next").alias("up"),
                    (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"))
        after = stored(after, "chat_depths")
        dropped(links)
        links, seen = after, seen * 2
    return links.select("conv_id", "call_id", F.when(F.col("up").isNull(), F.col("depth")).alias("depth"))


def linked_calls(calls: DataFrame, results: DataFrame, schemas=SCHEMAS) -> DataFrame:
    """Calls (conv_id, call_id, turn, tool, arguments, depends_on) and results (conv_id, call_id, turn,
    content) -> per call: conv_id, call_id, position (topological, from 1), depth, tool, n_calls and
    n_results of that identifier, linked, valid, and record (canonical JSON)."""
    named = calls.filter(F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()) \
        .select("conv_id", "call_id", "turn", "tool", "arguments", "depends_on")
    own = stored(first_of(named, ["conv_id", "call_id"], ["turn", "tool", "arguments"])
                 .withColumnRenamed("copies", "n_calls"), "chat_calls")
    answers = results.filter(F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()) \
        .select("conv_id", "call_id", F.col("turn").alias("result_turn"), F.col("content"))
    answers = first_of(answers, ["conv_id", "call_id"], ["result_turn", "content"]) \
        .withColumnRenamed("copies", "n_results")
    df = own.hint("shuffle_hash").join(answers, ["conv_id", "call_id"], "left") \
        .join(depths(own), ["conv_id", "call_id"])
    # places by depth: within a conversation a window of its calls alone, without their texts
    order = df.select("conv_id", "call_id", "depth", "turn")
    from pyspark.sql.window import Window
    by = Window.partitionBy("conv_id").orderBy(F.col("depth").asc_nulls_last(), "turn", "call_id")
    places = order.select("conv_id", "call_id", F.row_number().over(by).alias("position"))
    ok = valid(F.col("tool"), F.col("arguments"), schemas)
    df = df.join(places, ["conv_id", "call_id"]).withColumn("ok", ok)
    arguments = F.try_parse_json("arguments")  # a variant's keys are sorted
    record = F.to_json(F.struct(
        F.when(F.is_variant_null(arguments) | F.json_object_keys("arguments").isNull(), None)
        .otherwise(arguments).alias("arguments"),
        F.col("call_id").alias("id"), F.col("depends_on").alias("parent"), F.col("content").alias("result"),
        F.col("tool").alias("tool"), F.col("ok").alias("valid")), {"ignoreNullFields": "false"})
    return df.select("conv_id", "call_id", F.col("position").cast("long"), "depth", "tool",
                     F.col("n_calls").cast("long"), F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"),
                     F.col("n_results").isNotNull().alias("linked"), F.col("ok").alias("valid"),
                     record.alias("record"))


def unlinked(calls: DataFrame, results: DataFrame) -> DataFrame:
    """What ``linked_calls`` has no row for: (kind, conv_id, call_id, turn, text) of calls without a
    conversation or an identifier ('call', with their arguments) and of results without either, or whose
    call there isn't ('result', with their content). Each such row comes once for each time it is there."""
    named = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    told = calls.filter(named).select("conv_id", "call_id").distinct()
    orphans = results.filter(named).hint("shuffle_hash").join(told, ["conv_id", "call_id"], "left_anti")
    out = [("call", calls.filter(~named), "arguments"), ("result", results.filter(~named), "content"),
           ("result", orphans, "content")]
    parts = [df.select(F.lit(kind).alias("kind"), "conv_id", F.col("call_id").cast("string").alias("call_id"), "turn",
                       F.col(text).alias("text")) for kind, df, text in out]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def calls_of(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tool calls that conversations stand for: each user turn calls a tool with its text, named by the
    turn; the assistant's turn after it is that call's result; a call depends on the one two turns
    before it. (The conversations table holds no calls of its own.)"""
    user = conversations.filter((F.col("role") == "user") & F.col("conv_id").isNotNull()
                                & F.col("turn").isNotNull())
    number = lambda t: F.concat(F.lit("call-"), t.cast("string"))
    words = F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), "")).cast("long")
    tool = F.when(F.col("turn") % 4 == 0, F.lit("search")).otherwise(F.lit("summarise"))
    arguments = F.to_json(F.struct(F.col("turn").alias("turn"), F.col("text").alias("query"),
                                   F.when(tool == "summarise", words).alias("words")))
    calls = user.select("conv_id", number(F.col("turn")).alias("call_id"), "turn", tool.alias("tool"),
                        arguments.alias("arguments"), number(F.col("turn") - 2).alias("depends_on"))
    results = conversations.filter(F.col("role") == "assistant") \
        .select("conv_id", number(F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content"))
    return calls, results


ORACLE_SQL = """
WITH c AS (
  SELECT conv_id, turn, text, turn % 4 = 0 AS s, len(regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+')) AS words
  FROM conversations WHERE role = 'user'),
r AS (SELECT conv_id, turn - 1 AS turn, text FROM conversations WHERE role = 'assistant'),
o AS (
  SELECT conv_id, turn, s, text, words,
    turn - 2 * row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS chain FROM c),
p AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, chain ORDER BY turn) - 1 AS depth FROM o),
j AS (
  SELECT p.*, r.text AS result, r.conv_id IS NOT NULL AS linked,
    p.text IS NOT NULL AND CASE WHEN s THEN length(p.text) <= 400 ELSE length(p.text) <= 300 AND p.turn <= 200 END AS valid
  FROM p LEFT JOIN r ON p.conv_id = r.conv_id AND p.turn = r.turn)
SELECT conv_id, 'call-' || turn AS call_id,
  row_number() OVER (PARTITION BY conv_id ORDER BY depth, turn) AS position, depth,
  CASE WHEN s THEN 'search' ELSE 'summarise' END AS tool, 1 AS n_calls, CAST(linked AS BIGINT) AS n_results,
  linked, valid,
  '{"arguments":{' || CASE WHEN text IS NULL THEN '' ELSE '"query":' || to_json(text) || ',' END
    || '"turn":' || turn || CASE WHEN s THEN '' ELSE ',"words":' || words END
    || '},"id":"call-' || turn || '","parent":"call-' || (turn - 2) || '","result":'
    || coalesce(CAST(to_json(result) AS VARCHAR), 'null') || ',"tool":"'
    || CASE WHEN s THEN 'search' ELSE 'summarise' END || '","valid":' || valid || '}' AS record
FROM j
"""
