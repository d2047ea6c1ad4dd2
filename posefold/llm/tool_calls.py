"""Chat formatting: tool calls linked to their results, in DataFrame functions only.

Calls and results meet in a hash join on the call's identifier. A call may name any number of calls it
comes after; its level is one more than the highest of theirs. Calls with one such reference are passed
over by doubling the references, so that a chain of n calls takes about log2(n) joins of narrow rows;
only calls that wait for several others are settled in rounds. Arguments are checked against the tools'
schemas, nested values too, and every call becomes one line of canonical JSON (sorted keys, no spaces).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posefold.llm.common import stage

TURN_SCHEMA = {
    "type": "object",
    "properties": {"text": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}},
    "required": ["text", "turn"],
    "additionalProperties": False,
}
CHAT_SCHEMAS = {"user": TURN_SCHEMA, "system": TURN_SCHEMA}
#: What ``schema_of_variant`` says of each JSON type.
_TYPES = {
    "string": "^STRING$", "integer": r"^(BIGINT|DECIMAL\(\d+,0\))$", "number": r"^(BIGINT|DOUBLE|DECIMAL\(\d+,\d+\))$",
    "boolean": "^BOOLEAN$", "array": "^ARRAY<", "object": "^OBJECT<", "null": "^VOID$",
}


_KEYWORDS = {
    "type", "properties", "required", "additionalProperties", "enum", "minimum", "maximum", "minLength", "maxLength",
    "items", "minItems", "maxItems",
}


def _of_type(value: Column, kind: str) -> Column:
    return F.coalesce(F.schema_of_variant(value).rlike(_TYPES[kind]), F.lit(False))


def _object_problems(value: Column, keys: Column, schema: dict, at: str) -> list[Column]:
    """Messages for the fields of an object, null where there is nothing to say."""
    prefix = f"{at}." if at else ""
    checks = []
    for name in schema.get("required", ()):
        checks.append(F.when(~F.coalesce(F.array_contains(keys, name), F.lit(False)), F.lit(f"{prefix}{name}: missing")))
    known = schema.get("properties", {})
    for name, rule in known.items():
        checks += _value_problems(F.try_variant_get(value, f"$['{name}']", "variant"), rule, prefix + name)
    if schema.get("additionalProperties", True) is False:
        others = F.array_except(keys, F.array(*map(F.lit, known)) if known else F.array().cast("array<string>"))
        named = F.lit(f"{at}: unknown: " if at else "unknown: ")
        checks.append(F.when(F.size(others) > 0, F.concat(named, F.array_join(F.array_sort(others), ","))))
    return checks


def _value_problems(value: Column, rule: dict, at: str) -> list[Column]:
    """Messages for a value that may be absent (null), which no rule but ``required`` minds."""
    if unknown := set(rule) - _KEYWORDS:
        raise ValueError(f"schema keywords that are not known: {sorted(unknown)}")
    checks = []
    found = F.schema_of_variant(value)
    as_text, as_number = F.try_variant_get(value, "$", "string"), F.try_variant_get(value, "$", "double")

    def wrong(condition: Column, what: str) -> None:
        checks.append(F.when(condition, F.lit(f"{at}: {what}")))

    if "type" in rule:
        wrong(~found.rlike(_TYPES[rule["type"]]), f"not of type {rule['type']}")
    if "enum" in rule:
        wrong(~as_text.isin([str(v) for v in rule["enum"]]), "not an allowed value")
    for word, test in (("minimum", as_number < rule.get("minimum", 0)), ("maximum", as_number > rule.get("maximum", 0))):
        if word in rule:
            wrong(test, f"beyond the {word}")
    for word, test in (
        ("minLength", F.char_length(as_text) < rule.get("minLength", 0)),
        ("maxLength", F.char_length(as_text) > rule.get("maxLength", 0)),
    ):
        if word in rule:
            wrong(found.rlike(_TYPES["string"]) & test, f"beyond the {word}")
    if rule.keys() & {"items", "minItems", "maxItems"}:
        elements = F.when(_of_type(value, "array"), F.try_variant_get(value, "$", "array<variant>"))
        for word, test in (("minItems", F.size(elements) < rule.get("minItems", 0)), ("maxItems", F.size(elements) > rule.get("maxItems", 0))):
            if word in rule:
                wrong(elements.isNotNull() & test, f"beyond the {word}")
        if "items" in rule:
            each = F.transform(elements, lambda e: F.array_compact(F.array(*_value_problems(e, rule["items"], f"{at}[]"), F.lit(None).cast("string"))))
            said = F.array_join(F.array_distinct(F.flatten(each)), "; ")
            checks.append(F.when(said != "", said))
    if rule.keys() & {"properties", "required", "additionalProperties"}:
        keys = F.json_object_keys(F.to_json(value))
        checks += [F.when(_of_type(value, "object"), check) for check in _object_problems(value, keys, rule, at)]
    return checks


def schema_errors(arguments: Column, schema: dict) -> Column:
    """Messages for what the JSON text lacks; empty if it fits. Knows ``type``, ``properties``,
    ``required``, ``additionalProperties``, ``enum``, ``minimum``, ``maximum``, ``minLength``,
    ``maxLength``, ``items``, ``minItems`` and ``maxItems`` at every depth (``a.b``, ``a[]``); any
    other keyword is an error where the query is built."""
    if unknown := set(schema) - _KEYWORDS:
        raise ValueError(f"schema keywords that are not known: {sorted(unknown)}")
    value = F.try_parse_json(arguments)
    checks = [F.when(~F.schema_of_variant(value).rlike(_TYPES["object"]), F.lit("not an object"))]
    checks += _object_problems(value, F.json_object_keys(arguments), schema, "")
    return F.when(value.isNull(), F.array(F.lit("not JSON"))).otherwise(F.array_compact(F.array(*checks)))


def call_errors(name: Column, arguments: Column, schemas: dict[str, dict]) -> Column:
    cases = [(name == tool, schema_errors(arguments, schema)) for tool, schema in schemas.items()]
    unknown = F.array(F.lit("unknown tool"))
    return reduce(lambda rest, case: F.when(case[0], case[1]).otherwise(rest), reversed(cases), unknown)


def topological_levels(calls: DataFrame) -> DataFrame:
    """``call_id, level`` of every call: the greatest number of calls that come before it, one after another.

    ``calls`` (``call_id``, ``after``) have a row for each reference, or one whose ``after`` is null;
    identifiers are not null. References to no call are left out, repeated ones count once. The level
    is null for calls in a cycle of references and for those that come after one. Null references
    join nothing. Rounds: log2 of the longest chain of single references, plus the greatest number of
    calls with several references along one way.
    """
    nodes = calls.select("call_id").distinct()
    references = calls.where("after IS NOT NULL").select("call_id", "after").distinct()
    references = references.join(nodes.select(F.col("call_id").alias("after")), "after", "left_semi")
    references = stage(references, "references")
    before = references.groupBy("call_id").agg(F.count(F.lit(1)).alias("n"), F.min("after").alias("up"))
    before = before.select("call_id", "n", F.when(F.col("n") == 1, F.col("up")).alias("up"))
    # A call with one reference points up; any other is an anchor: at level 0, or one that waits for several.
    state = nodes.join(before, "call_id", "left").select(
        "call_id",
        F.coalesce("up", "call_id").alias("up"),
        F.when(F.col("up").isNotNull(), 1).otherwise(0).cast("bigint").alias("steps"),
        F.col("up").isNull().alias("found"),
        F.coalesce(F.col("n") > 1, F.lit(False)).alias("waits"),
    )
    state = stage(state, "levels")
    for _ in range(max(1, state.count().bit_length() + 1)):
        if state.where("NOT found").limit(1).count() == 0:
            break
        above = state.select(
            F.col("call_id").alias("up"), F.col("up").alias("next"), F.col("steps").alias("more"), F.col("found").alias("known"), F.col("waits").alias("late")
        )
        moved = state.where("NOT found").join(above, "up").select(
            "call_id", F.col("next").alias("up"), (F.col("steps") + F.col("more")).alias("steps"),
            F.col("known").alias("found"), F.col("late").alias("waits"),
        )
        state = stage(state.where("found").unionByName(moved), "levels")
    direct = state.where("NOT (found AND waits)").select("call_id", F.when(F.col("found"), F.col("steps")).alias("level"))
    late = state.where("found AND waits")
    if late.limit(1).count() == 0:
        return direct
    settled = _settle(references, state)
    return direct.unionByName(
        late.join(settled.select(F.col("call_id").alias("up"), "level"), "up", "left").select("call_id", (F.col("level") + F.col("steps")).alias("level"))
    )


def _settle(references: DataFrame, state: DataFrame) -> DataFrame:
    """``call_id, level`` of the calls that wait for several others, as far as none of those is in a cycle."""
    waiting = state.where("waits AND up = call_id").select("call_id")
    ends = state.select(F.col("call_id").alias("after"), F.col("up").alias("anchor"), "steps", "found", "waits")
    # What each waits for: an anchor and the calls from there on. The level is known once the anchor's is.
    ways = references.join(waiting, "call_id", "left_semi").join(ends, "after").select(
        "call_id", F.when(F.col("waits"), F.col("anchor")).alias("anchor"), (F.col("steps") + 1).alias("more"),
        F.when(F.col("found") & ~F.col("waits"), 0).cast("bigint").alias("base"), "found",
    )
    ways = stage(ways.where("found OR anchor IS NULL").drop("found"), "ways")
    settled = None
    while True:
        level = F.when(F.count("base") == F.count(F.lit(1)), F.max(F.col("base") + F.col("more")))
        fresh = stage(ways.groupBy("call_id").agg(level.alias("level")).where("level IS NOT NULL"), "settled")
        settled = fresh if settled is None else settled.unionByName(fresh)
        if fresh.limit(1).count() == 0:
            return settled
        ways = ways.join(fresh.select("call_id"), "call_id", "left_anti")
        known = fresh.select(F.col("call_id").alias("anchor"), F.col("level").alias("found"))
        still = ways.where("base IS NULL AND anchor IS NOT NULL").join(known, "anchor", "left")
        still = still.withColumn("base", F.col("found")).drop("found")
        ways = stage(ways.where("base IS NOT NULL OR anchor IS NULL").unionByName(still), "ways")


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per identifier: ``call_id, name, status, level, valid, errors, n_calls, n_results, record``.

    ``calls`` have ``call_id``, ``name``, ``arguments`` (JSON) and ``after``, an identifier or an array of
    them; ``results`` have ``call_id`` and ``content``; other columns are not looked at. The status is ``answered``, ``unanswered``,
    ``orphan_result`` (no such call), ``cyclic`` or ``no_identifier`` (a null identifier; such rows stay
    apart). Rows that repeat an identifier are one row with their count; of texts that differ, the
    smallest counts and the call is not valid; of references that differ all count, and it is not valid either. Null names are unknown tools, null arguments no JSON.
    Empty tables give what the other one gives.
    """
    keyed = calls.where("call_id IS NOT NULL")
    several = calls.schema["after"].dataType.typeName() == "array"
    levels = topological_levels(keyed.select("call_id", F.explode_outer("after").alias("after") if several else "after"))
    named = F.array_sort(F.array_distinct(F.coalesce("after", F.array()))) if several else F.coalesce("after", F.lit(""))

    def fields(n: Column | str) -> list[Column]:
        return [
            F.min("name").alias("name"), F.min("arguments").alias("arguments"), F.count(F.lit(1)).alias("n_calls"),
            (
                F.coalesce(F.min("arguments") != F.max("arguments"), F.lit(False))
                | F.coalesce(F.min("name") != F.max("name"), F.lit(False))
                | (F.min(named) != F.max(named))
            ).alias("conflict"),
        ]

    sides = keyed.groupBy("call_id").agg(*fields("call_id"))
    answers = results.where("call_id IS NOT NULL").groupBy("call_id").agg(
        F.min("content").alias("content"),
        F.count(F.lit(1)).alias("n_results"),
        F.coalesce(F.min("content") != F.max("content"), F.lit(False)).alias("differ"),
    )
    # Both groupings have dealt their rows by identifier already: the joins move no text again.
    linked = sides.join(answers.hint("shuffle_hash"), "call_id", "full_outer").join(levels, "call_id", "left")
    nameless = (
        calls.where("call_id IS NULL")
        .select("call_id", "name", "arguments", F.lit(1).cast("bigint").alias("n_calls"), F.lit(False).alias("conflict"))
        .unionByName(
            results.where("call_id IS NULL").select(
                "call_id", F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("arguments"),
                F.lit(None).cast("bigint").alias("n_calls"), F.lit(False).alias("conflict"),
                "content", F.lit(1).cast("bigint").alias("n_results"),
            ),
            allowMissingColumns=True,
        )
    )
    rows = linked.unionByName(nameless, allowMissingColumns=True)
    is_call = F.col("n_calls").isNotNull()
    errors = F.concat(
        F.when(is_call, call_errors(F.col("name"), F.col("arguments"), schemas)).otherwise(F.array().cast("array<string>")),
        F.when(F.col("conflict"), F.array(F.lit("calls differ"))).otherwise(F.array().cast("array<string>")),
        F.when(F.col("differ"), F.array(F.lit("results differ"))).otherwise(F.array().cast("array<string>")),
    )
    status = (
        F.when(F.col("call_id").isNull(), "no_identifier")
        .when(~is_call, "orphan_result")
        .when(F.col("level").isNull(), "cyclic")
        .when(F.col("n_results").isNull(), "unanswered")
        .otherwise("answered")
    )
    checked = rows.withColumn("errors", errors).withColumn("status", status)
    checked = checked.withColumn("valid", is_call & (F.size("errors") == 0))
    record = F.to_json(
        F.struct(  # in the order of the keys
            F.try_parse_json("arguments").alias("arguments"), "call_id", F.col("content").alias("content"), "errors", "level", "name", "status", "valid"
        ),
        {"ignoreNullFields": "false"},
    )
    return checked.select(
        "call_id", "name", "status", "level", "valid", F.array_join("errors", "; ").alias("errors"),
        F.coalesce("n_calls", F.lit(0)).cast("bigint").alias("n_calls"), F.coalesce("n_results", F.lit(0)).cast("bigint").alias("n_results"),
        record.alias("record"),
    )


def chat_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversation turns as calls and results.

    A turn of the assistant is a result of the turn before it; any other turn is a call of the tool its
    role names, with its text and turn as arguments. A call comes after the latest of the two turns
    before it that is a call. Identifiers are ``conversation:turn``.
    """
    named = F.when(F.col("conv_id").isNotNull() & F.col("turn").isNotNull(), F.col("conv_id")).cast("string")
    turn = F.col("turn").cast("bigint")
    own = conversations.select(
        named.alias("conv"), turn.alias("turn"), F.col("role").alias("role"), F.col("text").alias("text"),
        F.coalesce(F.col("role") == "assistant", F.lit(False)).alias("is_result"),
    )
    identifier = lambda number: F.concat("conv", F.lit(":"), number.cast("string"))
    results = own.where("is_result").select(identifier(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    calls = own.where("NOT is_result")
    # Every call offers itself to the two turns after it; the nearer offer wins.
    offers = (
        calls.select("conv", F.col("turn").alias("from"), F.explode(F.array(F.lit(1), F.lit(2))).alias("step"))
        .where("conv IS NOT NULL")
        .groupBy("conv", (F.col("from") + F.col("step")).alias("turn"))
        .agg(F.max("from").alias("from"))
    )
    placed = (
        calls.where("conv IS NOT NULL").select("conv", "turn").distinct().join(offers, ["conv", "turn"], "left")
        .select(identifier(F.col("turn")).alias("call_id"), identifier(F.col("from")).alias("after"))
    )
    placed = stage(placed, "call-references")
    own_calls = calls.select(
        identifier(F.col("turn")).alias("call_id"), F.col("role").alias("name"), F.to_json(F.struct("text", "turn")).alias("arguments")
    )
    known = own_calls.where("call_id IS NOT NULL").join(placed, "call_id", "left")
    return known.unionByName(own_calls.where("call_id IS NULL"), allowMissingColumns=True), results


def format_chat(conversations: DataFrame, schemas: dict[str, dict] | None = None) -> DataFrame:
    """``link_tool_calls`` over the turns of ``conversations`` (``conv_id``, ``turn``, ``role``, ``text``)."""
    calls, results = chat_calls(conversations)
    return link_tool_calls(calls, results, CHAT_SCHEMAS if schemas is None else schemas)
