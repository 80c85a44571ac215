"""Tool-call linking for chat data.

Calls and results meet in a hash join on conversation and call id. A call waits for
the calls its ``after`` names; levels (0: waits for none) order a conversation so that
each call comes behind those it waits for, by (level, turn, position). Arguments are
checked against the tool's schema, a subset of JSON Schema, and call, arguments and
result are serialised as canonical JSON: sorted keys, no spaces, no escapes beyond
what JSON demands.

The result has one row per call and per result that links to none. Nothing is
gathered by conversation, so a conversation with a third of all turns is no task.
A conversation of up to ``TASK_REFERENCES`` references is ordered in one task; a longer
one by joins: chains by pointer jumping, and what is nested by counters of open
references, in which each reference is joined once.

Equal rows count once. Of calls with one id in a conversation the first by turn and
position is the call, the others get status "repeated_call"; of its results the first
behind it is linked, the others get "repeated_result". A result without its call is
"orphan_result", a call without result "no_result". References to unknown ids are
errors and do not order; calls in or behind a circle of references have no level and
status "circular". NULL ids match nothing; NULL arguments count as invalid JSON, and
so do numbers beyond the range of doubles and halves of surrogate pairs. Texts of any
length and depth are taken whole; JSON nested beyond what the parser takes is invalid.
1.0 is an integer, as in JSON Schema, and true is no number. Extra columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from starloom.llm.common import materialize, replicate
from starloom.session import scratch_path

TASK_REFERENCES = 200_000

CHECKED = T.StructType(
    [
        T.StructField("valid", T.BooleanType()),
        T.StructField("errors", T.ArrayType(T.StringType())),
        T.StructField("canonical", T.StringType()),
    ]
)

_TYPES = {
    "string": str,
    "boolean": bool,
    "object": dict,
    "array": list,
    "null": type(None),
}


def of_type(value, name: str) -> bool:
    if name == "integer" and isinstance(value, float):
        return value.is_integer()
    if name == "integer":
        return isinstance(value, int) and not isinstance(value, bool)
    if name == "number":
        return isinstance(value, (int, float)) and not isinstance(value, bool)
    return isinstance(value, _TYPES[name])


def equal(a, b) -> bool:
    """Equality of JSON values: true is not 1, at any depth."""
    if isinstance(a, bool) or isinstance(b, bool):
        return a is b
    if isinstance(a, list) and isinstance(b, list):
        return len(a) == len(b) and all(map(equal, a, b))
    if isinstance(a, dict) and isinstance(b, dict):
        return a.keys() == b.keys() and all(equal(a[k], b[k]) for k in a)
    return a == b


def violations(value, schema: dict, path: str = "$") -> list[str]:
    """What of ``value`` breaks ``schema`` (type, enum, minimum, maximum, required,
    properties, additionalProperties, items)."""
    out = []
    if "type" in schema and not of_type(value, schema["type"]):
        return [f"{path}: not of type {schema['type']}"]
    if "enum" in schema and not any(equal(value, other) for other in schema["enum"]):
        out.append(f"{path}: not in the list")
    # Limits bind numbers only.
    if "minimum" in schema and of_type(value, "number") and value < schema["minimum"]:
        out.append(f"{path}: below {schema['minimum']}")
    if "maximum" in schema and of_type(value, "number") and value > schema["maximum"]:
        out.append(f"{path}: above {schema['maximum']}")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{path}.{k}: missing" for k in schema.get("required", ()) if k not in value]
        for key in sorted(value):
            if key in known:
                out += violations(value[key], known[key], f"{path}.{key}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{path}.{key}: not known")
    if isinstance(value, list) and "items" in schema:
        for i, item in enumerate(value):
            out += violations(item, schema["items"], f"{path}[{i}]")
    return out


def canonical(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def _no_constant(name: str):
    raise ValueError(name)


def check(call_id, name, arguments, result, schemas: dict) -> tuple[bool, list[str], str | None]:
    """Validity, errors, canonical JSON (None if the arguments are no JSON)."""
    try:
        value = json.loads(arguments or "", parse_constant=_no_constant)
        # Numbers beyond all bounds and halves of surrogate pairs have no canonical form.
        canonical(value).encode("utf-8")
    except (ValueError, RecursionError):
        return False, ["$: not JSON"], None
    if name in schemas:
        errors = violations(value, schemas[name])
    else:
        errors = [f"unknown tool {name}"]
    body = {"arguments": value, "id": call_id, "name": name, "result": result}
    return not errors, errors, canonical(body)


def checked(call_id: Column, name: Column, arguments: Column, result: Column, schemas: dict) -> Column:
    @F.arrow_udf(CHECKED)
    def run(ids: pa.Array, names: pa.Array, args: pa.Array, results: pa.Array) -> pa.Array:
        rows = zip(ids.to_pylist(), names.to_pylist(), args.to_pylist(), results.to_pylist())
        out = [dict(zip(CHECKED.names, check(*row, schemas))) for row in rows]
        kind = pa.struct(
            [("valid", pa.bool_()), ("errors", pa.list_(pa.string())), ("canonical", pa.string())]
        )
        return pa.array(out, kind)

    return run(call_id, name, arguments, result)


LEVEL = T.StructType([T.StructField("level", T.LongType())])


def topological(references: list[tuple], places: dict) -> list[int | None]:
    """Levels of the calls numbered by ``places``, None where a circle holds one back.

    ``references``: (call, other) by number; others without a number wait for nothing.
    """
    level: list[int | None] = [None] * len(places)
    open_, high = [0] * len(places), [0] * len(places)
    waiting: dict[int, list[int]] = {}
    for call, other in references:
        if other in places:
            open_[places[call]] += 1
            waiting.setdefault(places[other], []).append(places[call])
    settled = [i for i, n in enumerate(open_) if not n]
    for i in settled:
        level[i] = 1
    while settled:
        behind = settled.pop()
        for i in waiting.get(behind, ()):
            high[i] = max(high[i], level[behind])
            open_[i] -= 1
            if not open_[i]:
                level[i] = high[i] + 1
                settled.append(i)
    return level


def _levels_in_tasks(references: DataFrame) -> DataFrame:
    """conv_id, call_id, level of conversations of bounded size, each in one task."""
    schema = T.StructType([references.schema["conv_id"], references.schema["call_id"], *LEVEL])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: tuple[list, list, list] = ([], [], [])

        def finish(conversation, pairs: list[tuple]) -> None:
            places: dict = {}
            for call, _ in pairs:
                places.setdefault(call, len(places))
            for call, level in zip(places, topological(pairs, places)):
                for column, value in zip(out, (conversation, call, level)):
                    column.append(value)

        pairs: list[tuple] = []
        conversation = None
        for batch in batches:
            for conv, call, other in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if pairs and conv != conversation:
                    finish(conversation, pairs)
                    pairs = []
                conversation = conv
                pairs.append((call, other))
            if len(out[0]) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, arrow)], schema=arrow)
                out = ([], [], [])
        if pairs:
            finish(conversation, pairs)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, arrow)], schema=arrow)

    grouped = references.select("conv_id", "call_id", "other").repartition("conv_id")
    return grouped.sortWithinPartitions("conv_id").mapInArrow(run, schema)


def _levels_by_rounds(references: DataFrame) -> DataFrame:
    """conv_id, call_id, level of conversations of any size, by joins.

    Calls with one reference form chains, which pointer jumping resolves to the call at
    their end in a logarithmic number of rounds; one that leads into a circle never
    ends and is left out. Calls with several references then settle in rounds: newly
    settled calls meet the references to them, each once, and lower the counters of the
    calls that wait. Rounds follow the nesting of such calls, not the length of chains.
    """
    key = ["conv_id", "call_id"]
    spark = references.sparkSession
    degree = references.groupBy(*key).agg(F.count("*").alias("n"))
    degree = materialize(degree, "tool-degrees")
    counted = references.join(degree, key)
    to = F.col("other").alias("to")
    jumps = materialize(
        counted.filter("n = 1").select(*key, to, F.lit(1).cast("long").alias("dist")), "tool-jumps"
    )
    longest = jumps.count()
    reached = 1
    while reached <= longest:
        ahead = jumps.select("conv_id", F.col("call_id").alias("to"), F.col("to").alias("next"), F.col("dist").alias("more"))
        step = jumps.join(ahead, ["conv_id", "to"], "left").select(
            *key,
            F.coalesce("next", "to").alias("to"),
            (F.col("dist") + F.coalesce("more", F.lit(0))).alias("dist"),
            F.col("next").isNotNull().alias("moved"),
        )
        step = materialize(step, "tool-jumps")
        jumps = step.drop("moved")
        reached *= 2
        if not step.filter("moved").take(1):
            break
    inside = jumps.select("conv_id", F.col("call_id").alias("to"))
    ended = materialize(jumps.join(inside, ["conv_id", "to"], "left_anti"), "tool-chains")

    chained = ended.select("conv_id", F.col("call_id").alias("other"), "to", "dist")
    branching = (
        counted.filter("n > 1")
        .join(chained, ["conv_id", "other"], "left")
        .select(*key, F.coalesce("to", "other").alias("to"), F.coalesce("dist", F.lit(0)).alias("dist"))
    )
    branching = materialize(branching, "tool-branches")
    waiting = materialize(
        branching.groupBy(*key).agg(F.count("*").alias("left"), F.lit(0).cast("long").alias("high")), "tool-counters"
    )
    # Ids that wait for nothing: those referred to that refer to none themselves.
    free = branching.select("conv_id", "to").unionByName(ended.select("conv_id", "to")).distinct()
    free = free.join(degree.select("conv_id", F.col("call_id").alias("to")), ["conv_id", "to"], "left_anti")
    path = scratch_path(spark, "tool-levels")
    newly = free.select("conv_id", "to", F.lit(0).cast("long").alias("level"))
    newly.write.mode("append").parquet(path)
    newly = spark.read.schema(newly.schema).parquet(path)
    schema = newly.schema
    while True:
        told = (
            branching.join(newly, ["conv_id", "to"])
            .groupBy(*key)
            .agg(F.count("*").alias("met"), F.max(F.col("level") + F.col("dist")).alias("reach"))
        )
        waiting = materialize(
            waiting.join(told, key, "left").select(
                *key,
                (F.col("left") - F.coalesce("met", F.lit(0))).alias("left"),
                F.greatest("high", F.coalesce("reach", F.lit(0))).alias("high"),
            ),
            "tool-counters",
        )
        done = waiting.filter(F.col("left") == 0)
        newly = materialize(
            done.select("conv_id", F.col("call_id").alias("to"), (F.col("high") + 1).alias("level")), "tool-settled"
        )
        waiting = waiting.filter(F.col("left") > 0)
        if not newly.take(1):
            break
        newly.write.mode("append").parquet(path)
    settled = spark.read.schema(schema).parquet(path)
    of_chains = ended.join(settled, ["conv_id", "to"]).select(*key, (F.col("level") + F.col("dist")).alias("level"))
    of_branches = settled.select("conv_id", F.col("to").alias("call_id"), "level").join(
        degree.select(*key), key, "left_semi"
    )
    solved = of_chains.unionByName(of_branches)
    return degree.select(*key).join(solved, key, "left")


def levels(nodes: DataFrame, references: DataFrame, task_references: int = TASK_REFERENCES) -> DataFrame:
    """conv_id, call_id, level of each node; NULL where a circle holds it back.

    ``references``: conv_id, call_id, other (the id it waits for), known ids only.
    Conversations of up to ``task_references`` references are ordered in a task each,
    larger ones by rounds of joins; the result is the same.
    """
    key = ["conv_id", "call_id"]
    waiting = materialize(references.distinct(), "tool-references")
    # Few conversations are that long: their ids are at most references / task_references.
    long = materialize(
        waiting.groupBy("conv_id").agg(F.count("*").alias("n")).filter(F.col("n") > task_references).select("conv_id"),
        "tool-long",
    )
    found = _levels_in_tasks(waiting.join(replicate(long), "conv_id", "left_anti"))
    if long.take(1):
        found = found.unionByName(_levels_by_rounds(waiting.join(replicate(long), "conv_id", "left_semi")))
    found = found.withColumn("waits", F.lit(True))
    return nodes.join(found, key, "left").select(
        *key, F.when(F.col("waits"), F.col("level")).otherwise(F.lit(0)).alias("level")
    )


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """``calls``: conv_id, turn, position, call_id, name, arguments, after (array);
    ``results``: conv_id, turn, position, call_id, content."""
    key = ["conv_id", "call_id"]
    calls = materialize(
        calls.select(*key, "turn", "position", "name", "arguments", "after").distinct(), "tool-calls"
    )
    results = results.select(*key, "turn", "position", "content").distinct()
    place = F.struct("turn", "position", "name", "arguments", "after")
    first = calls.groupBy(*key).agg(F.min(place).alias("first"))
    first = materialize(first.filter("conv_id is not null and call_id is not null"), "tool-first")
    main = first.select(*key, "first.*")
    extra = calls.join(
        first.select(*key, F.col("first").alias("first")), key, "left"
    ).filter(~F.coalesce(place.eqNullSafe(F.col("first")), F.lit(False)))

    told = results.join(
        main.select(*key, F.struct("turn", "position").alias("called")), key, "left"
    ).withColumn(
        "behind", F.coalesce(F.struct("turn", "position") > F.col("called"), F.lit(False))
    )
    told = materialize(told, "tool-results")
    answer = (
        told.filter("behind").groupBy(*key).agg(F.min(F.struct("turn", "position", "content")).alias("answer"))
    )
    answer = materialize(answer, "tool-answers")
    rest = told.join(answer, key, "left").withColumn(
        "linked",
        F.col("behind")
        & F.struct("turn", "position", "content").eqNullSafe(F.col("answer")),
    )
    rest = rest.filter(~F.col("linked"))

    asked = main.select(*key, F.explode("after").alias("other")).distinct()
    ids = main.select("conv_id", F.col("call_id").alias("other"))
    known = asked.join(ids, ["conv_id", "other"], "left_semi")
    unknown = asked.join(ids, ["conv_id", "other"], "left_anti")
    unknown = unknown.groupBy(*key).agg(F.sort_array(F.collect_set("other")).alias("unknown"))
    ordered = materialize(levels(main.select(*key), known), "tool-levels")

    linked = (
        main.join(answer.select(*key, "answer"), key, "left")
        .join(ordered, key, "left")
        .join(unknown, key, "left")
        .withColumn(
            "c", checked(F.col("call_id"), F.col("name"), F.col("arguments"), F.col("answer.content"), schemas)
        )
        .withColumn(
            "errors",
            F.concat(
                "c.errors",
                F.transform(
                    F.coalesce("unknown", F.array().cast("array<string>")),
                    lambda u: F.concat(F.lit("waits for unknown "), u),
                ),
            ),
        )
    )
    status = (
        F.when(F.col("level").isNull(), "circular")
        .when(F.col("answer").isNull(), "no_result")
        .otherwise("linked")
    )
    none = F.lit(None)
    rows = linked.select(
        *key,
        "turn",
        "position",
        status.alias("status"),
        F.col("level").cast("int").alias("level"),
        (F.size("errors") == 0).alias("valid"),
        "errors",
        F.col("answer.turn").alias("result_turn"),
        F.col("c.canonical").alias("canonical"),
    )

    def left_over(df: DataFrame, status: Column) -> DataFrame:
        return df.select(
            *key,
            "turn",
            "position",
            status.alias("status"),
            none.cast("int").alias("level"),
            F.lit(False).alias("valid"),
            F.array().cast("array<string>").alias("errors"),
            none.cast("bigint").alias("result_turn"),
            none.cast("string").alias("canonical"),
        )

    of_result = F.when(F.col("behind"), "repeated_result").otherwise("orphan_result")
    return rows.unionByName(left_over(extra, F.lit("repeated_call"))).unionByName(
        left_over(rest, of_result)
    )
