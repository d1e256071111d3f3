"""Tool-call linking in chats, with DataFrame and SQL functions only.

Calls stand in assistant messages, {"tool_calls": [{"id", "name", "arguments", "parent_id"?}, ...]}, results in tool
messages, {"tool_call_id", "content"}. Calls and results are hash-joined by conversation and identifier, ordered
topologically along parent_id, checked against argument schemas and written as canonical JSON (sorted keys, no white
space, numbers in one form), one record for each call, so no conversation, however long, meets in one row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postalis.llm.common import durable

#: JSON-schema type -> pattern of the type that Spark finds in a parsed value.
TYPES = {"string": "STRING", "integer": "BIGINT|DECIMAL\\([0-9]+,0\\)", "number": "BIGINT|DECIMAL.*|DOUBLE|FLOAT", "boolean": "BOOLEAN", "object": "OBJECT.*", "array": "ARRAY.*", "null": "VOID"}


def calls_of(messages: DataFrame) -> DataFrame:
    """(conv_id, call_id, turn, place, tool, arguments, parent_id, n_calls): the first call of each identifier."""
    spoken = messages.filter((F.col("role") == "assistant") & F.col("text").contains('"tool_calls"'))
    spoken = spoken.select("conv_id", "turn", F.expr("try_variant_get(try_parse_json(text), '$.tool_calls', 'array<variant>')").alias("calls")).filter("calls is not null")
    each = spoken.select("conv_id", "turn", F.posexplode("calls").alias("place", "call"))
    found = each.select(
        "conv_id", "turn", "place",
        F.expr("try_variant_get(call, '$.id', 'string')").alias("call_id"),
        F.expr("try_variant_get(call, '$.name', 'string')").alias("tool"),
        F.expr("to_json(coalesce(try_variant_get(call, '$.arguments', 'variant'), parse_json('{}')))").alias("arguments"),
        F.expr("try_variant_get(call, '$.parent_id', 'string')").alias("parent_id"),
    ).filter("call_id is not null")
    first = F.min(F.struct("turn", "place", "tool", "arguments", "parent_id"))
    return found.groupBy("conv_id", "call_id").agg(first.alias("c"), F.count("*").alias("n_calls")).select("conv_id", "call_id", "c.*", "n_calls")


def results_of(messages: DataFrame) -> DataFrame:
    """(conv_id, call_id, result_turn, result, n_results): the first result of each identifier."""
    spoken = messages.filter(F.col("role") == "tool").select("conv_id", "turn", F.expr("try_parse_json(text)").alias("v"))
    found = spoken.select("conv_id", "turn", F.expr("try_variant_get(v, '$.tool_call_id', 'string')").alias("call_id"), F.expr("to_json(try_variant_get(v, '$.content', 'variant'))").alias("content")).filter("call_id is not null")
    first = F.min(F.struct("turn", "content"))
    return found.groupBy("conv_id", "call_id").agg(first.alias("r"), F.count("*").alias("n_results")).select("conv_id", "call_id", F.col("r.turn").alias("result_turn"), F.col("r.content").alias("result"), "n_results")


def depths(calls: DataFrame) -> DataFrame:
    """calls with depth, the number of calls above each along parent_id; null on and below a cycle.

    Pointers double each round, so a chain of n calls takes log2(n) rounds. A parent that isn't there counts as none.
    """
    known = calls.select("conv_id", F.col("call_id").alias("parent_id"), F.lit(True).alias("there"))
    rows = durable(calls.join(known, ["conv_id", "parent_id"], "left").withColumn("up", F.when(F.col("there"), F.col("parent_id"))).withColumn("depth", F.when(F.col("there"), 1).otherwise(0).cast("long")).drop("there"))
    open_, most = rows.agg(F.count("up"), F.count("*")).first()
    for _ in range(math.ceil(math.log2(max(2, most))) + 1):
        if not open_:
            break
        above = rows.select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"))
        rows = durable(rows.join(above, ["conv_id", "up"], "left").withColumn("depth", F.col("depth") + F.coalesce("more", F.lit(0))).withColumn("up", F.col("next")).drop("next", "more"))
        open_ = rows.agg(F.count("up")).first()[0]
    return rows.withColumn("depth", F.when(F.col("up").isNull(), F.col("depth"))).drop("up")


def errors(arguments: str, rules: str) -> Column:
    """Sorted faults of a call's arguments: no schema, or missing, unknown or mistyped arguments."""
    kind = "CASE r.type " + " ".join(f"WHEN '{t}' THEN '{p}'" for t, p in TYPES.items()).replace("\\", "\\\\") + " ELSE '.*' END"
    value = f"schema_of_variant(try_variant_get(parse_json({arguments}), concat('$[\"', r.argument, '\"]'), 'variant'))"
    return F.expr(f"""
        CASE WHEN {rules} IS NULL THEN array('no schema')
        WHEN json_object_keys({arguments}) IS NULL THEN array('not an object')
        ELSE array_sort(concat(
            transform(filter({rules}, r -> r.required AND NOT array_contains(json_object_keys({arguments}), r.argument)), r -> concat('missing ', r.argument)),
            transform(filter({rules}, r -> array_contains(json_object_keys({arguments}), r.argument) AND NOT regexp_like({value}, concat('^(', {kind}, ')$'))), r -> concat('type ', r.argument)),
            transform(array_except(json_object_keys({arguments}), transform({rules}, r -> r.argument)), a -> concat('unknown ', a)))) END""")


def link_tool_calls(messages: DataFrame, schemas: DataFrame) -> DataFrame:
    """(conv_id, call_id, tool, turn, place, depth, status, errors, record), one row for each identifier of a conversation.

    messages: conv_id, turn, role, text; schemas: tool, argument, type, required. Status: linked, unanswered (no
    result), orphan (a result without a call), early (the result's turn is not after the call's), cyclic (parents in a
    circle) or repeated (more calls than one, of which the first counts). (depth, turn, place) is a topological order.
    Rows with a null conv_id, turn, role or text and texts that aren't such JSON take no part; of repeated messages the
    first counts, ties by content; very long messages are taken whole and other columns, whatever their names, are left
    aside; an empty table gives an empty result. errors joins the faults by '; ', '' if none.
    """
    rows = messages.select("conv_id", "turn", "role", "text").dropna()
    rules = schemas.groupBy("tool").agg(F.collect_list(F.struct("argument", "type", "required")).alias("rules"))  # a row an argument
    calls = depths(calls_of(rows))
    both = calls.join(results_of(rows).hint("shuffle_hash"), ["conv_id", "call_id"], "full").join(rules, "tool", "left")
    status = (
        F.when(F.col("turn").isNull(), "orphan").when(F.col("n_calls") > 1, "repeated").when(F.col("depth").isNull(), "cyclic")
        .when(F.col("result_turn").isNull(), "unanswered").when(F.col("result_turn") <= F.col("turn"), "early").otherwise("linked")
    )
    checked = both.withColumn("status", status).withColumn("faults", F.when(F.col("turn").isNotNull(), errors("arguments", "rules")).otherwise(F.array().cast("array<string>")))
    record = F.expr("""to_json(named_struct('arguments', parse_json(arguments), 'call_id', call_id, 'conversation', conv_id, 'depth', depth,
        'errors', faults, 'parent_id', parent_id, 'result', parse_json(result), 'status', status, 'tool', tool, 'turn', turn), map('ignoreNullFields', 'false'))""")
    return checked.select("conv_id", "call_id", "tool", "turn", "place", "depth", "status", F.concat_ws("; ", "faults").alias("errors"), record.alias("record"))


def as_tool_chat(conversations: DataFrame) -> DataFrame:
    """Conversations without tool messages as ones with them: a user turn calls the tool ask (or follow_up, after the
    turn two before), the assistant turn after it is the result. By conv_id modulo 7, calls have a mistyped (1), missing
    (2) or unknown (3) argument, the first two call each other their parent (4), results come early (5), or a call stands
    twice (6). The JSON is only written here; linking parses it."""
    ident = "concat('c', conv_id, '-', {})"
    after = "if(turn < 2, null, turn - 2)"
    parent = f"case when turn >= 2 then {ident.format('turn - 2')} when turn = 0 and conv_id % 7 = 4 then {ident.format('2')} end"
    arguments = f"""case conv_id % 7 when 1 then parse_json(to_json(named_struct('turn', cast(turn as string), 'prompt', text, 'after', {after}))) when 2 then parse_json(to_json(named_struct('turn', turn, 'after', {after})))
        when 3 then parse_json(to_json(named_struct('turn', turn, 'prompt', text, 'after', {after}, 'mood', 'calm'))) else parse_json(to_json(named_struct('turn', turn, 'prompt', text, 'after', {after}))) end"""
    call = f"named_struct('id', {ident.format('turn')}, 'name', if(turn < 2, 'ask', 'follow_up'), 'arguments', {arguments}, 'parent_id', {parent})"
    spoken = f"to_json(named_struct('tool_calls', if(conv_id % 7 = 6, array({call}, {call}), array({call}))))"
    result = f"to_json(named_struct('tool_call_id', {ident.format('turn - 1')}, 'content', text))"
    rows = conversations.filter("role in ('user', 'assistant') and text is not null")
    said = F.expr("if(role = 'assistant' and conv_id % 7 = 5, turn - 2, turn)").alias("turn")
    return rows.select("conv_id", said, F.when(F.col("role") == "user", "assistant").otherwise("tool").alias("role"), F.expr(f"if(role = 'user', {spoken}, {result})").alias("text"))
