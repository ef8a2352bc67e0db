"""From raw documents to packed training sequences: each stage works on what the one before kept.

Null text has no words, so quality rules reject it. Stages keep all columns of ``documents``; the
last returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowops.functions.maps import materialise
from flowops.llm.decontaminate import decontaminate
from flowops.llm.jaccard import keep_first
from flowops.llm.linededup import line_dedup
from flowops.llm.packing import pack, token_pieces
from flowops.llm.quality import quality
from flowops.session import scratch_path, ship_code

CAPACITY = 2048
#: Words whose ids a worker remembers: executors also hold what the stages before left in memory.
REMEMBERED = 50_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    judged = quality(docs, [F.struct("*").alias("row")]).select("row", "kept")
    # a filter on the verdict itself would count everything again wherever a rule names it
    return materialise(judged, {"kept": F.col("kept")}).where("kept").select("row.*")


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that occurred before go; a document of which no word is left goes too."""
    rest = line_dedup(docs, [F.struct("*").alias("row")]).where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    length = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("row.n_chars")).cast(docs.schema["n_chars"].dataType)
    changed = {"text": F.col("text"), "n_chars": length}
    return rest.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest id."""
    return keep_first(docs, "doc_id", "text", width=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat enough of a benchmark go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate(docs.select(F.struct("*").alias("row"), "text"), items, id_col="row").where("not contaminated").select("row.*")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of what is left, placed in sequences."""
    pieces = token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), CAPACITY, remembered=REMEMBERED)
    return pack(pieces, CAPACITY).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_deduplication),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

#: SQL cannot express the packing; tests hold the rows against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    ship_code(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
