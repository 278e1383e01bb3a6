"""Chat formatting with linked tool calls, on DataFrame functions alone.

Calls and results are hash-joined by identifier, calls are ordered by the
length of the chain of calls they wait for (pointer doubling, so a chain of n
calls takes about log2(n) rounds), arguments are checked field by field
against the schema of the tool, and each call becomes one line of canonical
JSON (sorted keys, no blanks).  A conversation is never gathered into one
row, so its length does not matter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lookup, materialize, read_table


def call_levels(calls: DataFrame, max_rounds: int = 64) -> DataFrame:
    """``(call_id, level)`` of ``calls(call_id, after_id)``: 0 for a call that
    waits for none of the others, else one more than the call it waits for; -1
    where the chain is a cycle or waits for one."""
    known = calls.select(F.col("call_id").alias("after_id"))
    now = calls.join(known, "after_id", "left_semi").select("call_id", F.col("after_id").alias("up"),
                                                            F.lit(1).cast("long").alias("level"))
    now = now.unionByName(calls.join(known, "after_id", "left_anti").select(
        "call_id", F.lit(None).cast("string").alias("up"), F.lit(0).cast("long").alias("level")))
    now = materialize(now, "call-levels")
    n = now.where("up is not null").count()
    total = now.count()
    for _ in range(max_rounds):
        # after k rounds every chain of up to 2**k calls has ended; more can only be a cycle
        if not n or (1 << _) > total:
            break
        above = now.select(F.col("call_id").alias("up"), F.col("up").alias("up2"), F.col("level").alias("more"))
        moved = (now.where("up is not null").join(above, "up").select(
            "call_id", F.col("up2").alias("up"), (F.col("level") + F.col("more")).alias("level")))
        now = materialize(moved.unionByName(now.where("up is null")), "call-levels")
        n = now.where("up is not null").count()
    return now.select("call_id", F.when(F.col("up").isNull(), F.col("level")).otherwise(-1).alias("level"))


def argument_errors(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """``(call_id, errors)`` of ``calls(call_id, name, arguments)``, arguments
    being JSON text, against ``schemas(name, field, kind, required)`` with kind
    one of string, integer, number, boolean, object, array.  Errors are sorted
    and comma-separated; valid calls have none."""
    parsed = calls.select("call_id", "name", F.try_parse_json("arguments").alias("_v"))
    kind = F.regexp_extract(F.schema_of_variant("_v"), r"^(\w+)", 1)
    is_object = F.coalesce(kind == "OBJECT", F.lit(False))
    broken = parsed.where(~is_object).select("call_id", F.lit("arguments: not an object").alias("error"))
    good = parsed.where(is_object)
    fields = calls.sparkSession.tvf.variant_explode(F.col("_v").outer())
    given = good.lateralJoin(fields).select(
        "call_id", "name", F.col("key").alias("field"), F.schema_of_variant("value").alias("_type"))
    head = F.regexp_extract("_type", r"^(\w+)", 1)
    given = given.select("call_id", "name", "field", F.when(head == "BIGINT", "integer").when(
        head.isin("DECIMAL", "DOUBLE", "FLOAT"), "number").when(head == "ARRAY", "array").when(
        head == "OBJECT", "object").when(head == "VOID", "null").otherwise(F.lower(head)).alias("_given"))
    wanted = schemas.select("name", "field", "kind")
    wrong = given.join(lookup(wanted), ["name", "field"], "left").where(
        F.col("kind").isNull() | ~((F.col("kind") == F.col("_given"))
                                   | ((F.col("kind") == "number") & (F.col("_given") == "integer"))))
    wrong = wrong.select("call_id", F.when(F.col("kind").isNull(), F.concat("field", F.lit(": unknown"))).otherwise(
        F.concat("field", F.lit(": not "), "kind")).alias("error"))
    must = good.select("call_id", "name").join(lookup(schemas.where("required").select("name", "field")), "name")
    absent = must.join(given.select("call_id", "field"), ["call_id", "field"], "left_anti").select(
        "call_id", F.concat("field", F.lit(": missing")).alias("error"))
    tools = schemas.select("name").distinct()
    unknown = good.join(lookup(tools), "name", "left_anti").select(
        "call_id", F.concat(F.lit("tool: unknown")).alias("error"))
    # at most a few errors a call: one per field of its schema or its own arguments
    return (broken.unionByName(wrong).unionByName(absent).unionByName(unknown).groupBy("call_id")
            .agg(F.array_join(F.array_sort(F.collect_set("error")), ",").alias("errors")))


def link_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call and per result without a call:
    ``call_id, level, status, errors, json, turns``.

    ``calls(call_id, after_id, name, arguments)``; ``results(call_id, content)``;
    status is ``linked``, ``no_result`` or ``no_call`` (then level and json's
    call fields are null).  Of calls or results that repeat an identifier the
    smallest (by name and arguments, or content) counts, and ``turns`` says how
    many calls and results the row stands for; rows without an identifier are
    left out; null content is null in the JSON; arguments that
    are no JSON are kept as a JSON string.  Empty inputs give an empty result."""
    one = calls.where("call_id is not null").groupBy("call_id").agg(
        F.min(F.struct("name", "arguments", "after_id")).alias("c"), F.count("*").alias("calls")).select(
        "call_id", "c.name", "c.arguments", "c.after_id", "calls")
    one = materialize(one, "calls")
    res = results.where("call_id is not null").groupBy("call_id").agg(
        F.min(F.struct("content")).alias("r"), F.count("*").alias("results")).select(
        "call_id", F.col("r.content").alias("content"), "results", F.lit(True).alias("_has"))
    linked = (one.withColumn("_call", F.lit(True)).join(res, "call_id", "full_outer")
              .join(call_levels(one), "call_id", "left").join(argument_errors(one, schemas), "call_id", "left"))
    arguments = F.coalesce(F.to_json(F.try_parse_json("arguments")), quoted("arguments"))   # keys of a variant are sorted
    line = F.concat(F.lit('{"arguments":'), arguments, F.lit(',"id":'), quoted("call_id"), F.lit(',"level":'),
                    F.coalesce(F.col("level").cast("string"), F.lit("null")), F.lit(',"name":'), quoted("name"),
                    F.lit(',"result":'), quoted("content"), F.lit("}"))
    status = F.when(F.col("_call").isNull(), "no_call").when(F.col("_has").isNull(), "no_result").otherwise("linked")
    return linked.select("call_id", "level", status.alias("status"),
                         F.coalesce("errors", F.lit("")).alias("errors"), line.alias("json"),
                         (F.coalesce("calls", F.lit(0)) + F.coalesce("results", F.lit(0))).cast("long").alias("turns"))


def quoted(name: str) -> Column:
    """A column as a JSON string, or ``null``."""
    text = F.regexp_extract(F.to_json(F.struct(F.col(name).alias("x"))), r'(?s)^\{"x":(.*)\}$', 1)
    return F.when(F.col(name).isNull(), F.lit("null")).otherwise(text)


def _linkable() -> Column:
    """True for the turns that are calls or results."""
    return F.coalesce(F.col("conv_id").isNotNull() & F.col("turn").isNotNull() & F.col("role").isin("user", "assistant"),
                      F.lit(False))


def plain_turns(messages: DataFrame) -> DataFrame:
    """The turns that are neither call nor result, in the columns of :func:`link_calls`:
    status ``message`` (a system turn or another role) or ``no_id`` (no
    conversation or turn number), one row a turn."""
    ident = F.concat(F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string"))
    rest = messages.where(~_linkable()).select(ident.alias("call_id"), "role", F.col("text").alias("content"))
    line = F.concat(F.lit('{"content":'), quoted("content"), F.lit(',"id":'), quoted("call_id"), F.lit(',"role":'),
                    quoted("role"), F.lit("}"))
    return rest.select("call_id", F.lit(None).cast("long").alias("level"),
                       F.when(F.col("call_id").isNull(), "no_id").otherwise("message").alias("status"),
                       F.lit("").alias("errors"), line.alias("json"), F.lit(1).cast("long").alias("turns"))


def conversation_calls(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results held by ``messages(conv_id, turn, role, text)``: a user
    turn asks tool ``answer`` (or ``summary`` from 1,000 characters on), which
    waits for the user turn before; the assistant turn that follows is its
    result.  A user turn whose text is a JSON object with ``arguments`` is the
    call it spells out: its ``name`` and its arguments as they stand, which may
    fail the check.  Turns of other roles, and turns without conversation or
    number (also null), are in :func:`plain_turns`; turns that repeat a
    number share one row of :func:`link_calls`, which counts them."""
    def ident(shift):
        return F.concat_ws(":", F.col("conv_id").cast("string"), (F.col("turn") + shift).cast("string"))
    placed = messages.where(_linkable())
    asks = placed.where("role = 'user'").withColumn("_spelled", F.when(F.ltrim("text").startswith("{"), F.try_parse_json("text")))
    given = F.try_variant_get("_spelled", "$.arguments", "variant")
    calls = asks.select(
        ident(0).alias("call_id"), ident(-2).alias("after_id"),
        F.when(given.isNotNull(), F.try_variant_get("_spelled", "$.name", "string"))
        .when(F.length("text") >= 1000, "summary").otherwise("answer").alias("name"),
        F.when(given.isNotNull(), F.to_json(given)).otherwise(
            F.to_json(F.struct(F.col("turn").alias("turn"), F.col("text").alias("prompt"),
                               F.length("text").alias("limit")))).alias("arguments"))
    results = placed.where("role = 'assistant'").select(ident(-1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


#: Tools of the conversations table; ``summary`` needs no turn number.
TOOLS = [("answer", "prompt", "string", True), ("answer", "turn", "integer", True), ("answer", "limit", "integer", False),
         ("summary", "prompt", "string", True), ("summary", "limit", "integer", True)]


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of the conversations: linked calls and results, and the turns that are neither."""
    messages = read_table(spark, sf_dir, "conversations")
    schemas = spark.createDataFrame(TOOLS, "name string, field string, kind string, required boolean")
    return link_calls(*conversation_calls(messages), schemas).unionByName(plain_turns(messages))


ORACLE = """
WITH RECURSIVE m AS (
  SELECT conv_id || ':' || turn AS id, conv_id || ':' || (turn - 1) AS answers, conv_id || ':' || (turn - 2) AS after_id,
         turn, role, text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL AND role IN ('user', 'assistant')),
rest AS (
  SELECT conv_id || ':' || turn AS id, role, text FROM conversations
  WHERE conv_id IS NULL OR turn IS NULL OR role IS NULL OR role NOT IN ('user', 'assistant')),
calls AS (
  SELECT id, min(after_id) AS after_id, min(turn) AS turn, min(text) AS text, count(*) AS k FROM m WHERE role = 'user' GROUP BY id),
results AS (SELECT answers AS id, min(text) AS content, count(*) AS k FROM m WHERE role = 'assistant' GROUP BY answers),
levels AS (
  SELECT c.id, 0::BIGINT AS level FROM calls c WHERE NOT EXISTS (SELECT 1 FROM calls p WHERE p.id = c.after_id)
  UNION ALL SELECT c.id, l.level + 1 FROM calls c JOIN levels l ON c.after_id = l.id)
SELECT coalesce(c.id, r.id) AS call_id, l.level,
       CASE WHEN c.id IS NULL THEN 'no_call' WHEN r.id IS NULL THEN 'no_result' ELSE 'linked' END AS status,
       CASE WHEN c.id IS NULL THEN ''
            WHEN length(c.text) >= 1000 THEN 'turn: unknown'
            WHEN c.text IS NULL THEN 'prompt: missing' ELSE '' END AS errors,
       '{"arguments":' || CASE WHEN c.id IS NULL THEN 'null' ELSE
         '{' || CASE WHEN c.text IS NULL THEN '' ELSE '"limit":' || length(c.text) || ',"prompt":' || to_json(c.text) || ',' END
         || '"turn":' || c.turn || '}' END
       || ',"id":' || to_json(coalesce(c.id, r.id)) || ',"level":' || coalesce(l.level::VARCHAR, 'null')
       || ',"name":' || CASE WHEN c.id IS NULL THEN 'null' WHEN length(c.text) >= 1000 THEN '"summary"' ELSE '"answer"' END
       || ',"result":' || CASE WHEN r.content IS NULL THEN 'null' ELSE to_json(r.content) END || '}' AS json,
       coalesce(c.k, 0) + coalesce(r.k, 0) AS turns
FROM calls c FULL OUTER JOIN results r ON r.id = c.id LEFT JOIN levels l ON l.id = c.id
UNION ALL
SELECT id, NULL, CASE WHEN id IS NULL THEN 'no_id' ELSE 'message' END, '',
       '{"content":' || coalesce(to_json(text)::VARCHAR, 'null') || ',"id":' || coalesce(to_json(id)::VARCHAR, 'null')
       || ',"role":' || coalesce(to_json(role)::VARCHAR, 'null') || '}', 1 FROM rest
"""
