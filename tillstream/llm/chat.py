"""Chat formatting: tool calls linked to their results, ordered, validated and written as canonical JSON.

Calls and results meet in a hash join on their conversation and identifier, as identifiers need not differ between
conversations. A call may name others of its conversation that have to come before it; its depth is the longest way
to it. Calls with one predecessor form chains, which pointer doubling shortens in rounds that grow with the logarithm
of the longest one; what is left between calls with several predecessors is worked off in order, as long as one more
of them has all its predecessors done. Arguments are parsed as variants, checked against the tools' schemas, and written
with sorted keys and without white space. Only DataFrame functions are used, and every message stays a row of its own,
so no conversation meets in one task.

Cases: a call without result is `unanswered`, a result without call is an `orphan`, calls that wait for each other are
a `cycle` and have no step, nor have those behind them; several results of a call, and repeated rows, are all linked, and
all predecessors that rows of one call name hold; a null identifier links to nothing; messages without a conversation
are one of their own; an unknown or missing predecessor counts as none; arguments that are no JSON object, unknown tools, missing,
surplus and mistyped arguments are errors that are listed, and the message is kept; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.session import stored

#: Types of a schema, and how the type of a variant begins.
TYPES = {"string": "STRING", "integer": "BIGINT", "number": "BIGINT|DOUBLE|DECIMAL|FLOAT", "boolean": "BOOLEAN", "array": "ARRAY", "object": "OBJECT", "null": "VOID"}


def depths(calls: DataFrame) -> DataFrame:
    """(`conv_id`, `call_id`, `depth`) of each call: how many come before it on the longest way; null for those in or behind a cycle.

    calls: `conv_id`, `call_id` and `after`, an identifier or an array of them.
    """
    named = calls.where(F.col("call_id").isNotNull()).withColumn("call", F.struct("conv_id", "call_id"))
    after = F.col("after") if calls.schema["after"].dataType.typeName() == "array" else F.array("after")
    nodes = stored(named.select("call").distinct(), "calls")
    wanted = named.select("call", F.explode(after).alias("_id")).select("call", F.struct(F.col("call.conv_id").alias("conv_id"), F.col("_id").alias("call_id")).alias("up"))
    edges = stored(wanted.distinct().join(nodes.select(F.col("call").alias("up")), "up"), "edges")
    single = edges.groupBy("call").agg(F.count(F.lit(1)).alias("_n"), F.min("up").alias("up"))
    joints = stored(single.where("_n > 1").select("call"), "joints")
    # Along chains: where a chain begins (at a call without predecessors or with several) and how far it is from there.
    state = stored(nodes.join(single.where("_n = 1").select("call", "up"), "call", "left").select(
        "call", "up", F.coalesce("up", "call").alias("base"), F.when(F.col("up").isNull(), 0).otherwise(1).cast("long").alias("steps")), "chains")
    left = None
    while True:
        waiting = state.where("up IS NOT NULL").count()
        if waiting in (0, left):
            break
        left = waiting
        above = state.select(F.col("call").alias("up"), F.col("up").alias("_up"), F.col("base").alias("_base"), F.col("steps").alias("_steps"))
        state = stored(state.join(above, "up", "left").select(
            "call", F.col("_up").alias("up"), F.coalesce("_base", "base").alias("base"), (F.col("steps") + F.coalesce("_steps", F.lit(0))).alias("steps")), "chains")
    chains = state.where("up IS NULL").select("call", "base", "steps")
    bases = _joint_depths(edges, joints, chains)
    found = nodes.join(chains, "call", "left").join(bases, "base", "left").select("call", (F.col("steps") + F.col("depth")).alias("depth"))
    return found.select("call.conv_id", "call.call_id", "depth")


def _joint_depths(edges: DataFrame, joints: DataFrame, chains: DataFrame) -> DataFrame:
    """(`base`, `depth`) of the calls that begin a chain; those whose predecessors never are all done are missing."""
    roots = chains.select("base").distinct().join(joints.select(F.col("call").alias("base")), "base", "left_anti").withColumn("depth", F.lit(0).cast("long"))
    if joints.isEmpty():
        return roots
    into = edges.join(joints, "call").join(chains.select(F.col("call").alias("up"), "base", "steps"), "up", "left").select("call", "base", "steps")
    into = stored(into, "into")  # a predecessor in a cycle has no base, so its call never gets done
    done, before = stored(roots, "done"), -1
    while (now := done.count()) != before:
        before = now
        new = into.join(done, "base", "left").groupBy("call").agg(
            F.max(F.col("steps") + F.col("depth") + 1).alias("depth"), F.bool_and(F.col("depth").isNotNull()).alias("_all")).where("_all")
        done = stored(roots.union(new.select(F.col("call").alias("base"), "depth")), "done")
    return done


def _schema_errors(tool: dict, arguments: Column, text: Column) -> Column:
    """Errors of one tool's call, as an array."""
    properties, required = tool.get("properties", {}), set(tool.get("required", ()))
    checks = []
    for name in sorted(properties):
        kind = F.schema_of_variant(F.try_variant_get(arguments, f"$['{name}']", "variant"))
        wanted = properties[name].get("type")
        wrong = ~kind.rlike(f"^({TYPES[wanted]})") if wanted else F.lit(False)
        absent = F.lit(f"missing {name}" if name in required else None)
        checks.append(F.when(kind.isNull(), absent).when(wrong, F.lit(f"type of {name}")))
    keys = F.coalesce(F.json_object_keys(text), F.array().cast("array<string>"))
    surplus = F.transform(F.array_sort(F.array_except(keys, F.array(*[F.lit(p) for p in sorted(properties)]).cast("array<string>"))), lambda k: F.concat(F.lit("surplus "), k))
    found = F.array_compact(F.array(*checks).cast("array<string>"))
    return found if tool.get("additionalProperties", False) else F.concat(found, surplus)


def argument_errors(tools: dict[str, dict], name: Column, text: Column) -> Column:
    """What is wrong with a call's arguments (JSON text), as an array of texts; empty if nothing is."""
    arguments = F.try_parse_json(text)
    errors = F.array(F.lit("unknown tool"))
    for tool in sorted(tools):
        errors = F.when(name == tool, _schema_errors(tools[tool], arguments, text)).otherwise(errors)
    shape = F.schema_of_variant(arguments)
    return F.when(shape.isNull() | ~shape.startswith("OBJECT"), F.array(F.lit("no JSON object"))).otherwise(errors)


def linked(calls: DataFrame, results: DataFrame, tools: dict[str, dict]) -> DataFrame:
    """One row per call and per result.

    calls: `conv_id`, `turn`, `call_id`, `name`, `arguments` (JSON text), `after` (a call's id, an array of them, or null); results:
    `conv_id`, `turn`, `call_id`, `content`. Further columns are ignored. Gives `conv_id`, `turn`, `role`, `call_id`,
    `status`, `step` (even for calls, odd for their results), `errors` (joined texts, empty if valid) and `message`.
    """
    calls = calls.select("conv_id", "turn", "call_id", "name", "arguments", "after")
    results = results.select("conv_id", "turn", "call_id", "content")
    order = depths(calls).select(F.col("conv_id").alias("_conv"), F.col("call_id").alias("_call"), "depth", F.lit(True).alias("_known"))
    answered = results.where("call_id IS NOT NULL").select(F.col("conv_id").alias("_of"), F.col("call_id").alias("_answer")).distinct().withColumn("_has", F.lit(True))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("call_id") == F.col("_call"))
    met = F.col("conv_id").eqNullSafe(F.col("_of")) & (F.col("call_id") == F.col("_answer"))
    errors = F.array_join(argument_errors(tools, F.col("name"), F.col("arguments")), "; ")
    body = F.to_json(F.struct(
        F.coalesce(F.try_parse_json("arguments"), F.to_variant_object(F.struct(F.col("arguments").alias("text")))).alias("arguments"),
        F.col("call_id").alias("id"), "name", F.lit("call").alias("role")))
    asked = calls.join(order.hint("shuffle_hash"), same, "left").join(answered.hint("shuffle_hash"), met, "left")
    first = asked.select(
        "conv_id", "turn", F.lit("call").alias("role"), "call_id",
        F.when(F.col("_known") & F.col("depth").isNull(), "cycle").when(F.col("_has"), "linked").otherwise("unanswered").alias("status"),
        (2 * F.col("depth")).alias("step"), errors.alias("errors"), body.alias("message"))
    given = results.join(order.hint("shuffle_hash"), same, "left")
    text = F.to_json(F.struct("content", F.col("call_id").alias("id"), F.lit("result").alias("role")))
    second = given.select(
        "conv_id", "turn", F.lit("result").alias("role"), "call_id",
        F.when(F.col("_known").isNull(), "orphan").when(F.col("depth").isNull(), "cycle").otherwise("linked").alias("status"),
        (2 * F.col("depth") + 1).alias("step"), F.lit("").alias("errors"), text.alias("message"))
    return first.unionByName(second)


#: The tool that answers a user's turn.
RESPOND = {"respond": {"properties": {"prompt": {"type": "string"}, "turn": {"type": "integer"}}, "required": ["prompt", "turn"]}}


def of_conversations(turns: DataFrame) -> DataFrame:
    """Turns of conversations in this format: a user's turn calls `respond`, the assistant's next turn is the result.

    A call comes after that of two turns before, if there is one. Turns of other roles are messages of their own, with
    the step -1 and the status `plain`.
    """
    own = turns.select("conv_id", "turn", "role", "text")
    name = lambda turn: F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))
    calls = own.where("role = 'user'").select(
        "conv_id", "turn", name(F.col("turn")).alias("call_id"), F.lit("respond").alias("name"),
        F.to_json(F.struct(F.col("text").alias("prompt"), "turn")).alias("arguments"), name(F.col("turn") - 2).alias("after"))
    results = own.where("role = 'assistant'").select("conv_id", "turn", name(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    rest = own.where("role IS NULL OR role NOT IN ('user', 'assistant')").select(
        "conv_id", "turn", "role", F.lit(None).cast("string").alias("call_id"), F.lit("plain").alias("status"), F.lit(-1).cast("long").alias("step"),
        F.lit("").alias("errors"), F.to_json(F.struct(F.col("text").alias("content"), "role")).alias("message"))
    return linked(calls, results, RESPOND).unionByName(rest)
