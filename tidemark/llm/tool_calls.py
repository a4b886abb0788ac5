"""Tool calls of conversations: linked to their results, ordered, validated and written as canonical JSON.

Calls and results meet in a hash join on (conversation, call id), so a conversation of any length is spread over tasks. A call
names the calls it comes after, one or a list; its step is the length of the longest path of calls before it. Calls after one
other call form chains, which pointer doubling shortens to their beginnings in a logarithmic number of joins; calls after
several then take the largest step of theirs, in as many rounds as such calls follow one another. Arguments are parsed once; their
fields are checked against the tool's schema, and the canonical form has sorted keys, no white space and no missing fields.
DataFrame functions only.

Defined cases: of calls (or results) with the same conversation and id the first by order counts, and ``repeats`` says how many
others there were; a call without result is ``open``, a result without call is ``stray``; missing calls that a call should come
after do not count, so a call after missing ones only is at step 0; calls on a cycle, or behind one, have a null step; arguments
that are null or no JSON object are invalid, as is an unknown tool; calls and results with a null conversation or id come back row
by row and link to nothing: the calls are open at step 0, the results stray; an empty table gives an empty table; other columns
are ignored.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import stage_table

KEYS = ["conv_id", "call_id"]
#: Prefix of the name that the parsed value of each schema type has.
_TYPES = {"string": "STRING", "integer": "BIGINT", "boolean": "BOOLEAN", "array": "ARRAY", "object": "OBJECT"}

#: tool -> argument -> (type, required)
Schemas = dict[str, dict[str, tuple[str, bool]]]


def _first(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The first row of each key by ``place``, and how many others there are."""
    held = F.min(F.struct("place", *columns)).alias("held")
    return rows.groupBy(*KEYS).agg(held, (F.count("*") - 1).alias("repeats")).select(*KEYS, "held.*", "repeats")


def _ahead(rows: DataFrame, key: str, **columns: str) -> DataFrame:
    """``rows`` by call id under the name ``key``, with columns renamed to the keywords."""
    return rows.select("conv_id", F.col("call_id").alias(key), *[F.col(old).alias(new) for new, old in columns.items()])


def _chains(rows: DataFrame, rounds: int) -> DataFrame:
    """``conv_id, call_id, root, far``: the call at which the chain of each call begins and how far it is; ``root`` is null on and
    behind cycles of such calls. ``rows`` has ``to``, the call before (null where a chain begins)."""
    rows = rows.withColumn("far", F.when(F.col("to").isNull(), 0).otherwise(1).cast("long"))
    for _ in range(rounds):
        rows = stage_table(rows, "chains")
        rows = rows.join(_ahead(rows, "to", _to="to", _far="far"), ["conv_id", "to"], "left").select(
            *KEYS, F.coalesce("_to", "to").alias("to"), (F.col("far") + F.coalesce("_far", F.lit(0))).alias("far")
        )
    # Whoever still has a call before its beginning after doubling past the longest possible chain is on a cycle, or behind one.
    rows = stage_table(rows, "chains")
    begins = rows.where("to IS NULL").select("conv_id", F.col("call_id").alias("to"), F.col("call_id").alias("_root"))
    root = F.when(F.col("to").isNull(), F.col("call_id")).otherwise(F.col("_root"))
    return rows.join(begins, ["conv_id", "to"], "left").select(*KEYS, root.alias("root"), "far")


def steps(calls: DataFrame) -> DataFrame:
    """``conv_id, call_id, step``: the longest path of calls before each. ``after`` is the id of a call, or an array of ids."""
    after = F.col("after")
    if calls.schema["after"].dataType.typeName() != "array":
        after = F.array(after)
    named = calls.select(*KEYS, F.explode(F.array_distinct(after)).alias("after"))
    edges = named.join(calls.select("conv_id", F.col("call_id").alias("after")), ["conv_id", "after"])
    before = edges.groupBy(*KEYS).agg(F.count("*").alias("n"), F.min("after").alias("only"))
    rows = calls.select(*KEYS).join(before, KEYS, "left").select(*KEYS, F.when(F.col("n") == 1, F.col("only")).alias("to"), (F.coalesce("n", F.lit(0)) > 1).alias("several"))
    rows = stage_table(rows, "calls-before")
    longest = calls.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 1
    chains = stage_table(_chains(rows.drop("several"), ceil(log2(longest + 1))), "chains")
    joins = rows.where("several").select(*KEYS)
    # Chains that begin with a call after none are done; the other beginnings get their steps round by round.
    begin = rows.where("to IS NULL AND NOT several").select("conv_id", F.col("call_id").alias("root"), F.lit(0).cast("long").alias("base"))
    if not joins.isEmpty():
        waiting = edges.join(joins, KEYS, "left_semi").join(_ahead(chains, "after", root="root", far="far"), ["conv_id", "after"])
        waiting, new = waiting.select(*KEYS, "root", (F.col("far") + 1).alias("far"), F.lit(None).cast("long").alias("base")), begin
        while True:
            known = new.withColumnRenamed("base", "_base")
            waiting = waiting.join(known, ["conv_id", "root"], "left").select(*KEYS, "root", "far", F.coalesce("base", "_base").alias("base"))
            waiting = stage_table(waiting, "waiting")
            ready = waiting.groupBy(*KEYS).agg(F.max(F.col("far") + F.col("base")).alias("base"), F.count("base").alias("n"), F.count("*").alias("of"))
            new = stage_table(ready.where("n = of").select("conv_id", F.col("call_id").alias("root"), "base"), "steps")
            if new.isEmpty():
                break
            begin = begin.unionByName(new)
            waiting = waiting.join(new.select("conv_id", F.col("root").alias("call_id")), KEYS, "left_anti")
    return chains.join(begin, ["conv_id", "root"], "left").select(*KEYS, (F.col("far") + F.col("base")).alias("step"))


def valid_arguments(tool: Column, arguments: Column, schemas: Schemas) -> Column:
    """Whether parsed ``arguments`` are an object with the fields the tool's schema asks for, of its types, and no others."""
    verdict = F.lit(False)
    names = F.json_object_keys(F.to_json(arguments))
    for name, fields in schemas.items():
        fits = F.startswith(F.schema_of_variant(arguments), F.lit("OBJECT"))
        for field, (kind, required) in fields.items():
            value = F.try_variant_get(arguments, f"$.{field}", "variant")
            typed = F.startswith(F.schema_of_variant(value), F.lit(_TYPES[kind]))
            fits = fits & (F.coalesce(typed, F.lit(False)) if required else F.coalesce(typed, F.lit(True)))
        known = F.size(F.array_except(names, F.array(*map(F.lit, fields)))) == 0
        verdict = F.when(tool == name, fits & F.coalesce(known, F.lit(True))).otherwise(verdict)
    return F.coalesce(verdict, F.lit(False))


def link(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """``conv_id, call_id, step, status, valid, repeats, json`` of every call and stray result.

    ``calls`` has ``conv_id, call_id, place, tool, arguments`` (JSON text) and ``after`` (an id or an array of ids); ``results`` has
    ``conv_id, call_id, place, content``."""
    keyed = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    first = stage_table(_first(calls.where(keyed), ["tool", "arguments", "after"]), "calls")
    bare_calls = calls.where(~keyed).select(*KEYS, "tool", "arguments", F.lit(0).cast("long").alias("step"), F.lit(True).alias("_called"))
    bare_results = results.where(~keyed).select(*KEYS, "content", F.lit(True).alias("_answered"))
    results = _first(results.where(keyed), ["content"]).select(*KEYS, "content", F.col("repeats").alias("_repeats"), F.lit(True).alias("_answered"))
    ordered = first.join(steps(first), KEYS).withColumn("_called", F.lit(True))
    both = ordered.join(results.hint("shuffle_hash"), KEYS, "full")
    for bare in (bare_calls, bare_results):
        both = both.unionByName(bare, allowMissingColumns=True)
    parsed = F.try_parse_json("arguments")
    line = F.to_json(
        F.struct(
            parsed.alias("arguments"), F.col("call_id").alias("id"), F.col("content").alias("result"), F.col("step").alias("step"),
            F.col("tool").alias("tool"), F.col("valid").alias("valid"),
        )
    )
    status = F.when(F.col("_called").isNull(), "stray").when(F.col("_answered").isNull(), "open").otherwise("linked")
    return both.withColumn("valid", F.col("_called").isNotNull() & valid_arguments(F.col("tool"), parsed, schemas)).select(
        *KEYS, "step", status.alias("status"), "valid",
        (F.coalesce("repeats", F.lit(0)) + F.coalesce("_repeats", F.lit(0))).alias("repeats"), line.alias("json"),
    )


#: The exchange of a plain conversation as calls of one tool.
REPLY: Schemas = {"reply": {"text": ("string", True), "turn": ("integer", True)}}


def exchanges(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of a plain conversation: what anybody but the assistant says asks for a reply, and an assistant's turn is the
    result of the turn before it. A call comes after the call before it, or after the one that the turn before it answers."""
    turns = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    asks = turns.where("NOT role <=> 'assistant'")
    answers = turns.where("role = 'assistant'")
    before = answers.select("conv_id", (F.col("turn") + 1).alias("turn"), F.lit(2).alias("back")).distinct()
    text = F.coalesce("text", F.lit(""))
    calls = asks.join(before, ["conv_id", "turn"], "left").select(
        "conv_id", F.col("turn").alias("call_id"), F.col("turn").alias("place"), F.lit("reply").alias("tool"),
        F.to_json(F.struct("turn", text.alias("text"))).alias("arguments"),
        (F.col("turn") - F.coalesce("back", F.lit(1))).alias("after"),
    )
    results = answers.select("conv_id", (F.col("turn") - 1).alias("call_id"), F.col("turn").alias("place"), text.alias("content"))
    return calls, results
