"""The corpus pipeline: documents in, tokens out, one written table per stage.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and
returns a DataFrame that is written as Parquet and read again as the next one's docs.
All but the last return the columns of documents. ``n_chars`` follows the text.

1. quality rules: rejected documents go.
2. line dedup: repeated multi-line chunks leave the texts; no document goes.
3. near duplicates: one document of each group stays.
4. decontamination: contaminated documents go.
5. tokens: each text as token ids, with the digest of what they decode to.

Defined cases, per stage:

- NULL and empty texts have no words: the quality rules reject them. Where a stage gets
  one all the same, line dedup leaves it, near duplicates keeps one of all texts without
  words, decontamination keeps it, tokens gives it no ids.
- NULL ids: line dedup counts them last among occurrences, near duplicates prefers rows
  with an id; otherwise they are ids like others.
- Ties: of equal documents the smallest id stays, then the smallest digest of the text.
- Repeated rows: rows equal in id and text get the same verdict, lose the same lines, and
  one of them is left behind near duplicates.
- Very long texts are taken whole. Empty tables pass through. Extra columns are kept up
  to the last stage, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import bpe, fm_index, jaccard, line_dedup, rules
from starloom.llm.common import fresh, importable, materialize, table, text_or_empty


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    (verdict,) = fresh(docs, "verdict")
    judged = docs.withColumn(verdict, rules.assess(text_or_empty("text")))
    return judged.filter(F.col(verdict)["kept"]).select(*docs.columns)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned, _, _ = line_dedup.dedup(docs)
    length = F.length("text").cast("long")
    return cleaned.withColumn("n_chars", length).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found, hits = fm_index.find(docs, table(spark, sf_dir, "benchmark"))
    return found.filter(~fm_index.contaminated(F.col(hits))).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = bpe.encode_and_check(text_or_empty("text"))
    return docs.select("doc_id", "lang", "source", encoded.alias("e")).select(
        "doc_id", "lang", "source", "e.*"
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", repeated_lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

# Compression ratios, hashed paths and byte-pair merges are beyond SQL; the stages are
# tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(importable(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
