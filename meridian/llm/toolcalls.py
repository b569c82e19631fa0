"""Tool-call linking for chat records, DataFrame functions only.

Calls and results are joined by conversation and identifier. Calls are ordered so that each
comes after the calls it depends on: a conversation whose dependencies all
point backwards is in order by position; one with a dependency that points
forwards is put in order by rounds that release the calls whose dependencies
are done. Arguments are parsed and validated against the tool's schema, and
every call is written as canonical JSON: keys sorted, no white space.

Defined results, by ``status``: ``ok``; ``invalid_arguments`` (no JSON object,
a required key missing or null, a wrong type, or a key the schema doesn't
name); ``unknown_tool``; ``missing_dependency``; ``cycle``; ``no_result``;
``several_results`` (the first by position is used); ``orphan_result`` (a
result without a call, a row of its own). The first that holds, in the order
``cycle missing_dependency unknown_tool invalid_arguments several_results
no_result ok``, is given. Rows equal in every column count once; of calls
that share conversation and identifier the first by position is used. Null
identifiers meet nothing; null conversations are one. ``refused_calls`` gives
the calls that are not used: ``repeated_call`` and ``no_identifier``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.llm.common import ship, staged

# type name of a schema -> pattern of the parsed value's type
TYPES = {"string": "^STRING$", "integer": r"^(BIGINT|DECIMAL\(\d+,0\))$", "number": r"^(BIGINT|DOUBLE|DECIMAL.*)$",
         "boolean": "^BOOLEAN$", "array": "^ARRAY<.*", "object": "^OBJECT<.*"}

CALL_COLUMNS = ["conv_id", "call_id", "position", "name", "arguments", "depends_on"]
Schemas = dict[str, dict[str, tuple[str, bool]]]  # tool -> key -> (type, required)


def arguments_valid(name: Column, parsed: Column, schemas: Schemas) -> Column:
    """Whether the parsed arguments fit the schema; null for an unknown tool."""
    shape = F.schema_of_variant(parsed)
    # the keys at the top: what is left of the shape without nested types is
    # not needed, as the object's own keys come from a map of variants
    keys = F.map_keys(F.try_variant_get(parsed, "$", "map<string,variant>"))
    out = F.lit(None).cast("boolean")
    for tool, params in schemas.items():
        ok = shape.startswith("OBJECT<") & (F.size(F.array_except(keys, F.array(*[F.lit(k) for k in params]))) == 0)
        for key, (kind, required) in params.items():
            value = F.try_variant_get(parsed, f"$['{key}']", "variant")
            absent = value.isNull() | F.is_variant_null(value)
            fits = F.schema_of_variant(value).rlike(TYPES[kind])
            ok = ok & F.when(absent, F.lit(not required)).otherwise(fits)
        out = F.when(name == tool, F.coalesce(ok, F.lit(False))).otherwise(out)
    return out


def _conversation(conv_id: Column) -> Column:
    """Different for each conversation, and for none."""
    conv = conv_id.cast("string")
    return F.coalesce(F.concat(F.length(conv).cast("string"), F.lit(":"), conv), F.lit("-"))


def _key(conv_id: Column, call_id: Column) -> Column:
    """Different for each conversation and identifier; null without identifier."""
    return F.concat(_conversation(conv_id), F.lit(" "), call_id)


def _first_calls(calls: DataFrame) -> DataFrame:
    """The calls used: ``_key`` and, in ``c``, the columns; ``n`` rows share the key."""
    keyed = calls.select(*CALL_COLUMNS, _key(F.col("conv_id"), F.col("call_id")).alias("_key"))
    return keyed.where(F.col("_key").isNotNull()).groupBy("_key").agg(
        F.min(F.struct("position", "conv_id", "call_id", "name", "arguments", "depends_on")).alias("c"), F.count(F.lit(1)).alias("n"))


def _record(args: Column, result: Column) -> Column:
    """The canonical JSON of a call."""
    record = F.struct(F.coalesce(args, F.parse_json(F.lit("null"))).alias("arguments"), F.col("call_id").alias("call"),
                      F.sort_array(F.array_distinct(F.coalesce("depends_on", F.array().cast("array<string>")))).alias("depends_on"),
                      "name", result.alias("result"))
    return F.to_json(record, {"ignoreNullFields": "false"})


def order_calls(calls: DataFrame, deps: DataFrame) -> DataFrame:
    """``calls`` (``conv_id``, ``call_id``, ``position``, ...) with
    ``order_key`` (null in or behind a cycle). ``deps``: ``call_id``,
    ``dep_id``, both of calls that exist, in one conversation."""
    place = calls.select(F.col("call_id").alias("dep_id"), F.col("position").alias("dep_position"))
    back = (deps.join(calls.select("call_id", "conv_id", "position"), "call_id").join(place, "dep_id")
            .where(F.col("dep_position") >= F.col("position")).select("conv_id").distinct())
    back = staged(back, "backward")
    if back.isEmpty():
        return calls.withColumn("order_key", F.col("position"))
    left = staged(calls.join(back, "conv_id", "left_semi").select("call_id"), "calls")
    edges = staged(deps.join(left, "call_id", "left_semi"), "deps")
    done = None
    step = 0
    while True:
        ready = staged(left.join(edges, "call_id", "left_anti").withColumn("order_key", F.lit(step).cast("long")), "ready")
        if ready.isEmpty():
            break
        done = ready if done is None else done.unionByName(ready)
        left = staged(left.join(ready, "call_id", "left_anti"), "calls")
        edges = staged(edges.join(ready.select(F.col("call_id").alias("dep_id")), "dep_id", "left_anti"), "deps")
        step += 1
    released = done if done is not None else left.withColumn("order_key", F.lit(None).cast("long")).limit(0)
    marked = calls.join(back.withColumn("_back", F.lit(True)), "conv_id", "left").join(released, "call_id", "left")
    return marked.select(*calls.columns, F.when(F.col("_back"), F.col("order_key")).otherwise(F.col("position")).alias("order_key"))


def link(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """One row per call and per orphan result: ``conv_id``, ``call_id``,
    ``order_key``, ``name``, ``status``, ``canonical``.

    ``calls``: ``conv_id``, ``call_id``, ``position``, ``name``, ``arguments``
    (JSON), ``depends_on`` (array of call ids). ``results``: ``conv_id``,
    ``call_id``, ``position``, ``content``."""
    # inside, conv_id and call_id are keys that are never null
    known = staged(_first_calls(calls).select(
        _conversation(F.col("c.conv_id")).alias("conv_id"), F.col("_key").alias("call_id"), F.col("c.position"), F.col("c.name"),
        F.col("c.arguments"), F.col("c.depends_on"), F.col("c.conv_id").alias("_conv_id"), F.col("c.call_id").alias("_call_id")), "calls")
    wanted = known.select("call_id", "_conv_id", F.explode(F.array_distinct("depends_on")).alias("_wanted"))
    wanted = wanted.select("call_id", _key(F.col("_conv_id"), F.col("_wanted")).alias("dep_id"))
    met = wanted.join(known.select(F.col("call_id").alias("_dep")), F.col("dep_id") == F.col("_dep"), "left")
    missing = (met.where(F.col("_dep").isNull()).select("call_id").distinct().withColumn("_missing", F.lit(True)))
    deps = met.where(F.col("_dep").isNotNull()).select("call_id", "dep_id")
    ordered = order_calls(known, deps).join(missing, "call_id", "left")
    got = results.select("conv_id", "call_id", "position", "content").distinct().withColumn("_key", _key(F.col("conv_id"), F.col("call_id")))
    first = got.where(F.col("_key").isNotNull()).groupBy(F.col("_key").alias("call_id")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(F.struct("position", "content")).alias("_r"))
    parsed = ordered.join(first, "call_id", "left").withColumn("_args", F.try_parse_json("arguments"))
    valid = arguments_valid(F.col("name"), F.col("_args"), schemas)
    known_tool = F.coalesce(F.col("name").isin(*schemas), F.lit(False))
    status = (F.when(F.col("order_key").isNull() & F.col("position").isNotNull(), "cycle").when(F.col("_missing"), "missing_dependency")
              .when(~known_tool, "unknown_tool").when(~F.coalesce(valid, F.lit(False)), "invalid_arguments")
              .when(F.col("_n") > 1, "several_results").when(F.col("_n").isNull(), "no_result").otherwise("ok"))
    linked = parsed.select(F.col("_conv_id").alias("conv_id"), F.col("_call_id").alias("call_id"), "order_key", "name", "depends_on",
                           status.alias("status"), "_args", F.col("_r.content").alias("_content")).select(
        "conv_id", "call_id", "order_key", "name", "status", _record(F.col("_args"), F.col("_content")).alias("canonical"))
    orphans = got.join(known.select(F.col("call_id").alias("_key")), "_key", "left_anti").select(
        "conv_id", "call_id", F.col("position").alias("order_key"), F.lit(None).cast("string").alias("name"),
        F.lit("orphan_result").alias("status"),
        F.to_json(F.struct(F.col("call_id").alias("call"), F.col("content").alias("result")),
                  {"ignoreNullFields": "false"}).alias("canonical"))
    return linked.unionByName(orphans)


def refused_calls(calls: DataFrame) -> DataFrame:
    """The calls that ``link`` doesn't use, as rows like its own, each with its
    position as ``order_key`` and no result: a call without an identifier
    (``no_identifier``), and those after the first of a conversation's
    identifier (``repeated_call``)."""
    several = staged(_first_calls(calls).where(F.col("n") > 1).select(F.col("_key").alias("_used"), "c"), "repeated")
    rows = calls.select(*CALL_COLUMNS)
    unnamed = rows.where(F.col("call_id").isNull()).distinct().withColumn("status", F.lit("no_identifier"))
    again = (rows.join(several, _key(F.col("conv_id"), F.col("call_id")) == F.col("_used"))
             .where(~F.struct("position", "conv_id", "call_id", "name", "arguments", "depends_on").eqNullSafe(F.col("c")))
             .select(*CALL_COLUMNS).distinct().withColumn("status", F.lit("repeated_call")))
    return unnamed.unionByName(again).select(
        "conv_id", "call_id", F.col("position").alias("order_key"), "name", "status",
        _record(F.try_parse_json("arguments"), F.lit(None).cast("string")).alias("canonical"))


# The conversations table as calls and results: user and system turns call a
# tool with their turn and text, each depending on the call one or else two
# turns before; an assistant turn is the result of the turn before it. A turn
# of any other role calls a tool of its role's name, which no schema has.
CHAT_SCHEMAS: Schemas = {"answer": {"text": ("string", True), "turn": ("integer", True)},
                         "configure": {"text": ("string", True), "turn": ("integer", True)}}


def chat_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    def ident(shift: int) -> Column:
        return F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), (F.col("turn") - shift).cast("string"))

    asks = conversations.where(~F.coalesce(F.col("role") == "assistant", F.lit(False)))
    ids = asks.where(F.col("role").isin("user", "system")).select(ident(0).alias("id")).distinct()
    near, far = ids.select(F.col("id").alias("_near")), ids.select(F.col("id").alias("_far"))
    calls = (asks.select("conv_id", ident(0).alias("call_id"), F.col("turn").alias("position"),
                         F.when(F.col("role") == "user", "answer").when(F.col("role") == "system", "configure").otherwise(F.col("role")).alias("name"),
                         F.to_json(F.struct("turn", "text")).alias("arguments"), ident(1).alias("_1"), ident(2).alias("_2"))
             .join(near, F.col("_1") == F.col("_near"), "left").join(far, F.col("_2") == F.col("_far"), "left")
             .withColumn("depends_on", F.array_compact(F.array(F.coalesce("_near", "_far"))))
             .drop("_1", "_2", "_near", "_far"))
    results = conversations.where(F.col("role") == "assistant").select(
        "conv_id", ident(1).alias("call_id"), F.col("turn").alias("position"), F.col("text").alias("content"))
    return calls, results


ship(__name__)

ORACLE = r"""
WITH m AS (SELECT DISTINCT conv_id, turn, role, text, 'c' || conv_id || '-' || turn AS id,
                  'c' || conv_id || '-' || (turn - 1) AS id1, 'c' || conv_id || '-' || (turn - 2) AS id2 FROM conversations),
calls AS (SELECT id, min(conv_id) AS conv_id, min(turn) AS turn, min(role) AS role, min(text) AS text, min(id1) AS id1, min(id2) AS id2
          FROM m WHERE role IN ('user', 'system') GROUP BY id),
dep AS (
  SELECT c.*, coalesce(n.id, f.id) AS d FROM calls c LEFT JOIN calls n ON n.id = c.id1 LEFT JOIN calls f ON f.id = c.id2),
res AS (SELECT id1 AS id, count(*) AS n, arg_min(text, turn) AS text FROM m WHERE role = 'assistant' GROUP BY id1)
SELECT conv_id, dep.id AS call_id, turn AS order_key, CASE role WHEN 'user' THEN 'answer' ELSE 'configure' END AS name,
       CASE WHEN dep.text IS NULL THEN 'invalid_arguments' WHEN n > 1 THEN 'several_results' WHEN n IS NULL THEN 'no_result' ELSE 'ok' END AS status,
       '{"arguments":{' || CASE WHEN dep.text IS NULL THEN '' ELSE '"text":' || to_json(dep.text) || ',' END || '"turn":' || turn || '},"call":' || to_json(dep.id)
       || ',"depends_on":[' || coalesce(to_json(d)::VARCHAR, '') || '],"name":' || to_json(CASE role WHEN 'user' THEN 'answer' ELSE 'configure' END)
       || ',"result":' || coalesce(to_json(res.text)::VARCHAR, 'null') || '}' AS canonical
FROM dep LEFT JOIN res ON res.id = dep.id
UNION ALL
SELECT conv_id, id1, turn, NULL, 'orphan_result', '{"call":' || to_json(id1) || ',"result":' || coalesce(to_json(text)::VARCHAR, 'null') || '}'
FROM m WHERE role = 'assistant' AND id1 NOT IN (SELECT id FROM calls)
"""
