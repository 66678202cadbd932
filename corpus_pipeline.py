"""A training-text pipeline: five stages over `documents`, each of which uses one operator of tallyshelf.llm.

A stage gets the documents its predecessor kept and returns documents with the same columns; the last returns
tokens. Rows are told apart by all that a decision depends on, not by doc_id alone, so that ids may repeat or be
null. Copies of a row share its fate, except that the near-duplicate stage keeps one document of each group.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyshelf.llm.common import ship_code, stored, table
from tallyshelf.llm.decontaminate import find_items
from tallyshelf.llm.order_minhash import near_classes
from tallyshelf.llm.pieces import encode_documents
from tallyshelf.llm.quality import judge_quality
from tallyshelf.llm.repeats import remove_repeats

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _row_key() -> Column:
    return F.xxhash64("doc_id", "text", "lang")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and their language's perplexity band."""
    ship_code(spark)
    keyed = docs.select(_row_key().alias("doc_id"), "text", "lang")
    kept = judge_quality(keyed).filter("kept").select(F.col("doc_id").alias("_key")).distinct()
    return docs.withColumn("_key", _row_key()).join(kept, "_key", "left_semi").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each near-duplicate class; a null id comes after all others."""
    ship_code(spark)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "body")
    firsts = near_classes(docs).groupBy("root").agg(F.min(order).alias("first"))
    firsts = firsts.select(F.col("first.doc_id").alias("_id"), F.col("first.body").alias("_body"))
    bodies = docs.withColumn("_body", F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    same = F.col("_id").eqNullSafe(F.col("doc_id").cast("long")) & (bodies["_body"] == firsts["_body"])
    # Rows with the same id and text are one document.
    return bodies.join(firsts, same, "left_semi").dropDuplicates(["doc_id", "_body"]).select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without what earlier ones have in windows of fifty bytes."""
    ship_code(spark)
    rest = docs.drop("text")
    kept = remove_repeats(docs, carry=F.to_json(F.struct(*rest.columns)))
    row = F.from_json("carried", rest.schema)
    columns = {c: row[c] for c in rest.columns} | {"text": F.col("kept_text")}
    if "n_chars" in columns:
        columns["n_chars"] = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
    return kept.select(*[columns[c].alias(c) for c in docs.columns])


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    ship_code(spark)
    keyed = docs.select(_row_key().alias("doc_id"), "text")
    found = find_items(keyed, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("_key")).distinct()
    return docs.withColumn("_key", _row_key()).join(found, "_key", "left_anti").select(*docs.columns)


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether they decode to its text."""
    ship_code(spark)
    return encode_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_decontamination", benchmark_decontamination),
    ("piece_encoding", piece_encoding),
]

#: SQL cannot express the model, the sketches or the encoding; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
