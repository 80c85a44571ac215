"""Queries of the operators, each over its whole table, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import (
    attribution,
    bpe,
    classifier,
    fm_index,
    jaccard,
    line_dedup,
    packing,
    pii,
    repair,
    rules,
    sharding,
    tools,
    variants,
)
from starloom.llm.common import importable, table, text_or_empty
from starloom.session import pin_utc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def under_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(importable(pin_utc(spark)), sf_dir)

    QUERIES[fn.__name__] = under_utc
    return under_utc


@query
def op1_quality_classifier(spark, sf_dir):
    return classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_bpe_round_trip(spark, sf_dir):
    digests = bpe.round_trip(text_or_empty("text"))
    return table(spark, sf_dir, "documents").select("doc_id", digests.alias("d")).select("doc_id", "d.*")


@query
def op3_ngram_jaccard_join(spark, sf_dir):
    found = jaccard.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "copy_id", "n_links")


@query
def op4_quality_rules(spark, sf_dir):
    verdict = rules.assess(text_or_empty("text"))
    return table(spark, sf_dir, "documents").select("doc_id", verdict.alias("v")).select("doc_id", "v.*")


@query
def op5_personal_data(spark, sf_dir):
    return pii.report(pii.find(table(spark, sf_dir, "documents")))


@query
def op6_sharding(spark, sf_dir):
    return sharding.assign(table(spark, sf_dir, "documents"))


@query
def op7_line_dedup(spark, sf_dir):
    out, total, removed = line_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id", F.col(total).alias("n_chunks"), F.col(removed).alias("n_removed"), "text"
    )


@query
def op8_tool_calls(spark, sf_dir):
    return tools.link(*derived_calls(table(spark, sf_dir, "conversations")), TOOLS)


@query
def op9_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return attribution.attribute_fields(docs, "doc_id", ["source", "lang"], "text", separator=" ")


@query
def op10_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found, name = fm_index.find(docs, table(spark, sf_dir, "benchmark"))
    hits = F.col(name)
    return found.select(
        "doc_id",
        hits["n_words"].alias("n_words"),
        hits["n_hit"].alias("n_hit"),
        F.size(hits["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(hits["items"]), ","), 256).alias("items_sha256"),
        fm_index.contaminated(hits).alias("contaminated"),
    )


@query
def op11_conversation_repair(spark, sf_dir):
    return repair.repair(table(spark, sf_dir, "conversations"), with_rows=False)[0]


@query
def op12_spelling_variants(spark, sf_dir):
    return variants.group(table(spark, sf_dir, "documents"))


@query
def op13_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


# --- tool calls in the conversations ---------------------------------------------

# What the derived calls may call.
TOOLS = {
    "search": {
        "type": "object",
        "required": ["query"],
        "properties": {
            "query": {"type": "string"},
            "limit": {"type": "integer", "minimum": 1, "maximum": 60},
        },
        "additionalProperties": False,
    },
    "convert": {
        "type": "object",
        "required": ["value", "unit"],
        "properties": {
            "value": {"type": "number"},
            "unit": {"type": "string", "enum": ["m", "km", "mi"]},
        },
    },
    "note": {
        "type": "object",
        "properties": {"tags": {"type": "array", "items": {"type": "string"}}},
    },
}


def derived_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations read as tool use.

    Every line an assistant wrote is a call, and every line of the next turn a result
    for the call at the same place. Lengths decide tool, arguments, what a call waits
    for, and which ids are wrong, so all cases occur: invalid arguments, missing and
    repeated results, unknown and circular references.
    """
    lines = conversations.select(
        "conv_id",
        "turn",
        "role",
        F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("position", "line"),
    ).withColumn("n", F.length("line"))

    def named(turn, position):
        return F.concat_ws("-", F.lit("call"), turn, position)

    n, position, turn = F.col("n"), F.col("position"), F.col("turn")
    text = F.substring_index("line", " ", 1)
    search = F.to_json(F.struct((n % 70).alias("limit"), text.alias("query")))
    convert = F.to_json(
        F.struct((n / 4).alias("value"), F.element_at(F.array(*map(F.lit, ["m", "km", "mi", "ft"])), (n % 4 + 1).cast("int")).alias("unit"))
    )
    note = F.to_json(F.struct(F.array(text, F.lit("seen")).alias("tags")))
    calls = lines.filter("role = 'assistant'").select(
        "conv_id",
        "turn",
        "position",
        F.when(n % 97 == 0, named(turn, position - 1)).otherwise(named(turn, position)).alias("call_id"),
        F.when(n % 4 == 0, "convert").when(n % 4 == 1, "note").when(n % 101 == 2, "guess").otherwise("search").alias("name"),
        F.when(n % 89 == 0, "{").when(n % 4 == 0, convert).when(n % 4 == 1, note).otherwise(search).alias("arguments"),
        F.filter(
            F.array(
                F.when((position > 0) & (n % 3 == 0), named(turn, position - 1)),
                F.when(n % 11 == 0, named(turn, position + 1)),
                F.when((turn > 1) & (position == 0), named(turn - 2, F.lit(0))),
            ),
            lambda x: x.isNotNull(),
        ).alias("after"),
    )
    results = lines.filter("role <> 'assistant'").select(
        "conv_id",
        "turn",
        "position",
        F.when(n % 13 == 0, named(turn - 1, position - 1)).otherwise(named(turn - 1, position)).alias("call_id"),
        F.col("line").alias("content"),
    )
    return calls, results
