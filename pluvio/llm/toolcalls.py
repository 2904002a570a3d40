"""Linking of tool calls: results are hash-joined to calls by identifier, calls are brought into an order in which what a call
needs comes before it, arguments are validated against the tools' schemas, and each call is serialised as canonical JSON.

All of it is DataFrame code. A conversation may hold any share of the rows: joins go by conversation and identifier, places are
counted in blocks of a conversation, and no conversation is gathered in one row. If every call only needs calls of earlier turns,
the turns are the order and nothing is iterated; other conversations are peeled level by level, and calls on a cycle, or that need
one, come last without a level.

Tables: calls(conv_id, turn, call_id, name, arguments), results(conv_id, turn, call_id, content), needs(conv_id, call_id, needed).
Rows without conv_id or call_id take no part. Of several results of a call the first by turn counts, and their number is given.
Calls that share an identifier are all kept with status `repeated` and the same result. A result without a call is a row of
status `orphan`. Arguments that are no JSON object are invalid; a null name is an unknown tool.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pluvio.llm.common import table
from pluvio.session import stage

#: Turns of a conversation that are numbered together.
BLOCK = 4096

FIELD = "struct<type:string,required:boolean,least:double,most:double,one_of:array<string>>"


def schemas(spark: SparkSession, tools: dict[str, dict[str, dict]]) -> DataFrame:
    """name, fields of each tool. A field has a type (string, integer, number, boolean, array, object), and may be required, have
    least and most (a value's range, a string's length) and one_of."""
    def number(x):
        return None if x is None else float(x)

    rows = [
        (name, {f: (s["type"], bool(s.get("required")), number(s.get("least")), number(s.get("most")), s.get("one_of")) for f, s in fields.items()})
        for name, fields in tools.items()
    ]
    return spark.createDataFrame(rows, f"name string, fields map<string,{FIELD}>")


def canonical(text: Column) -> Column:
    """A JSON text with sorted keys and without blanks; null if it is not JSON."""
    return F.to_json(F.try_parse_json(text))


def _kind(value: Column) -> Column:
    shape = F.schema_of_variant(value)
    return (
        F.when(shape == "STRING", "string").when(shape == "BOOLEAN", "boolean").when(shape == "BIGINT", "integer")
        .when(shape.rlike("^(DECIMAL|DOUBLE|FLOAT)"), "number").when(shape.startswith("ARRAY"), "array").when(shape.startswith("OBJECT"), "object")
        .otherwise("null")
    )


def _error(entry: Column, fields: Column) -> Column:
    """What is wrong with one argument, or null."""
    key, value = entry["key"], entry["value"]
    spec = F.try_element_at(fields, key)
    kind = _kind(value)
    string = F.try_variant_get(value, "$", "string")
    amount = F.when(kind == "string", F.length(string).cast("double")).otherwise(F.try_variant_get(value, "$", "double"))
    fits = (kind == spec["type"]) | ((spec["type"] == "number") & (kind == "integer"))
    return (
        F.when(spec.isNull(), F.concat(F.lit("unknown "), key))
        .when(~fits, F.concat(F.lit("type "), key))
        .when(amount < spec["least"], F.concat(F.lit("small "), key))
        .when(amount > spec["most"], F.concat(F.lit("large "), key))
        .when(spec["one_of"].isNotNull() & ~F.array_contains(spec["one_of"], string), F.concat(F.lit("value "), key))
    )


def validated(calls: DataFrame, tools: DataFrame) -> DataFrame:
    """calls with canonical arguments and the sorted list of errors. tools: as schemas() makes it, a row per tool."""
    given = F.col("__llm_given")
    object_ = F.try_parse_json("arguments").try_cast("map<string,variant>")
    required = F.map_keys(F.map_filter("fields", lambda _, s: s["required"]))
    found = F.filter(F.transform(F.map_entries(given), lambda e: _error(e, F.col("fields"))), lambda x: x.isNotNull())
    missing = F.transform(F.array_except(required, F.map_keys(given)), lambda f: F.concat(F.lit("missing "), f))
    errors = (
        F.when(F.col("fields").isNull(), F.array(F.lit("unknown tool")))
        .when(given.isNull(), F.array(F.lit("no object")))
        .otherwise(F.array_sort(F.concat(found, missing)))
    )
    kept = [c for c in calls.columns if c not in ("errors", "fields", "__llm_given")]
    return (
        calls.select(*kept).join(F.broadcast(tools), "name", "left").withColumn("__llm_given", object_)
        .select(*kept, errors.alias("errors")).withColumn("arguments", canonical(F.col("arguments")))
    )


def levels(calls: DataFrame, needs: DataFrame) -> DataFrame:
    """conv_id, call_id, level of the calls of conversations in which some call needs one that is not of an earlier turn."""
    node = calls.groupBy("conv_id", "call_id").agg(F.min("turn").alias("turn"))
    ends = node.select("conv_id", F.col("call_id").alias("needed"), F.col("turn").alias("before"))
    edges = stage(needs.join(node, ["conv_id", "call_id"]).join(ends, ["conv_id", "needed"]), "needs")
    odd = edges.where("before >= turn").select("conv_id").distinct()
    left = stage(node.join(odd, "conv_id", "left_semi").select("conv_id", "call_id"), "open-calls")
    edges = edges.join(odd, "conv_id", "left_semi").select("conv_id", "call_id", "needed").distinct()
    done, level = left.limit(0).withColumn("level", F.lit(0)), 0
    while not left.isEmpty():
        waiting = edges.select("conv_id", "call_id").distinct()
        ready = stage(left.join(waiting, ["conv_id", "call_id"], "left_anti"), "ready")
        if ready.isEmpty():
            break
        done = stage(done.unionByName(ready.withColumn("level", F.lit(level))), "levels")
        left = stage(left.join(ready, ["conv_id", "call_id"], "left_anti"), "open-calls")
        met = ready.select("conv_id", F.col("call_id").alias("needed"))
        edges = stage(edges.join(met, ["conv_id", "needed"], "left_anti"), "needs")
        level += 1
    return done.unionByName(left.withColumn("level", F.lit(None).cast("int")))


def linked(calls: DataFrame, results: DataFrame, needs: DataFrame, tools: DataFrame) -> DataFrame:
    """conv_id, place, turn, call_id, name, status, n_results, errors, json: a row per call and per result without a call."""
    at = ["conv_id", "call_id"]
    known = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    calls = validated(calls.where(known).select("conv_id", "turn", "call_id", "name", "arguments"), tools)
    results = results.where(known).groupBy(*at).agg(
        F.min(F.struct("turn", "content")).alias("first"), F.count("*").alias("n_results"))
    times = calls.groupBy(*at).agg(F.count("*").alias("times"))
    joined = calls.join(times, at).join(results, at, "full_outer")
    order = levels(calls.select(*at, "turn"), needs.where(known & F.col("needed").isNotNull()).select(*at, "needed"))
    odd = order.select("conv_id").distinct().withColumn("odd", F.lit(True))
    status = (
        F.when(F.col("times").isNull(), "orphan").when(F.col("times") > 1, "repeated").when(F.col("first").isNull(), "pending").otherwise("linked")
    )
    rows = (
        joined.withColumn("status", status).join(order, at, "left").join(odd, "conv_id", "left")
        .withColumn("turn", F.coalesce("turn", "first.turn"))
        .withColumn("step", F.when(F.col("odd"), F.coalesce("level", F.lit((1 << 31) - 1)).cast("long")).otherwise(F.col("turn").cast("long")))
        .withColumn("n_results", F.coalesce("n_results", F.lit(0).cast("long")))
    )
    rest = F.to_json(F.struct("call_id", "conv_id", "errors", "name", F.col("first.content").alias("result"), "status", "turn"))
    rows = rows.withColumn("json", F.concat(F.lit('{"arguments":'), F.coalesce("arguments", F.lit("null")), F.lit(","), F.substr(rest, F.lit(2))))
    return placed(rows).select("conv_id", "place", "turn", "call_id", "name", "status", "n_results", "errors", "json")


def placed(rows: DataFrame) -> DataFrame:
    """rows with their place in the conversation, from 1, by step, turn and call_id. Steps are counted in blocks."""
    rows = rows.withColumn("block", F.coalesce(F.floor(F.col("step") / BLOCK), F.lit(-1)))
    sizes = rows.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    ahead = F.sum("n").over(Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    before = sizes.select("conv_id", "block", F.coalesce(ahead, F.lit(0)).alias("ahead"))
    own = F.row_number().over(Window.partitionBy("conv_id", "block").orderBy("step", "turn", "call_id", "json"))
    return rows.withColumn("own", own).join(before, ["conv_id", "block"]).withColumn("place", F.col("own") + F.col("ahead"))


#: The tools of the registered query: what the user asks is a call, the assistant's answer its result.
TOOLS = {
    "lookup": {"limit": {"type": "integer", "required": True, "least": 1, "most": 30}, "query": {"type": "string", "required": True, "least": 1, "most": 200}},
    "answer": {
        "question": {"type": "string", "required": True, "least": 1}, "style": {"type": "string", "one_of": ["long", "short"]},
        "words": {"type": "integer", "required": True, "least": 10, "most": 60},
    },
}


def from_conversations(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Calls, results and needs: a user's turn calls a tool, the assistant's next turn is the result, and a call needs the user's
    call two turns before."""
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text"))
    name = F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"))
    n = F.size(F.expr("filter(split(text, '[ \\n]+'), x -> x <> '')"))
    brief = F.length("text") <= 200
    object_ = F.to_json(F.struct("text"))
    quoted = F.substr(object_, F.lit(len('{"text":') + 1), F.length(object_) - len('{"text":}'))
    users = rows.where("role = 'user'")
    calls = users.select(
        "conv_id", "turn", name.alias("call_id"), F.when(brief, "lookup").otherwise("answer").alias("name"),
        F.when(brief, F.concat(F.lit('{ "query": '), quoted, F.lit(', "limit": '), n.cast("string"), F.lit("}")))
        .otherwise(F.concat(F.lit('{"words": '), n.cast("string"), F.lit(', "style": "'), F.when(n < 40, "short").otherwise("wordy"), F.lit('", "question": '), quoted, F.lit("}")))
        .alias("arguments"))
    answered = F.concat(F.col("conv_id").cast("string"), F.lit("-"), (F.col("turn") - 1).cast("string"))
    results = rows.where("role = 'assistant'").select("conv_id", "turn", answered.alias("call_id"), F.col("text").alias("content"))
    earlier = F.concat(F.col("conv_id").cast("string"), F.lit("-"), (F.col("turn") - 2).cast("string"))
    needs = users.select("conv_id", name.alias("call_id"), earlier.alias("needed"))
    return calls, results, needs


def op9_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results, needs = from_conversations(table(spark, sf_dir, "conversations"))
    return linked(calls, results, needs, schemas(spark, TOOLS)).select(
        "conv_id", "place", "turn", "call_id", "name", "status", "n_results", F.array_join("errors", "; ").alias("errors"), F.md5(F.col("json").cast("binary")).alias("json_md5"))
