"""Corpus pipeline: toxicity -> near duplicates -> repeated passages -> packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each as Parquet in the shared checkpoint folder and reads it as the next one's
docs. All stages but the last return the columns of ``documents``:

- toxicity: documents scored 0.3 or more are rejected; null texts stay.
- near_dedup: of each group of near duplicates the smallest doc_id stays;
  documents without words are groups of their own. Shingles have two words, as
  the contract of operator 7 has it, whose decisions the stage carries out.
- suffix_dedup: bytes covered by a 50-byte string of a smaller document go,
  except parts of a character of which a byte stays; ``n_chars`` follows; a
  document whose text goes entirely stays with an empty one.
- packing: the pieces and their places in sequences of 4096 tokens.

Rows without doc_id name no document and end in the first stage; rows that share
a doc_id keep their own columns. Empty tables
pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.llm import common as C
from threadlens.llm.packing import pack
from threadlens.llm.parsing import suffix_dedup
from threadlens.llm.sketches import near_duplicates
from threadlens.llm.toxicity import score, train

#: The passages stage has no SQL twin; tests hold the stages against brute force.
ORACLE_SQL = None
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
THRESHOLD = 0.3
SHINGLE = 2


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    scored = score(docs, train(docs, labels), extra=COLUMNS[1:])
    return scored.where(F.col("score") < THRESHOLD).select(*COLUMNS)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = near_duplicates(docs, shingle=SHINGLE).where("kept").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi").select(*COLUMNS)


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    texts = suffix_dedup(docs, with_text=True, extra=("lang", "source"))
    return texts.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [("toxicity", toxicity_stage), ("near_dedup", near_dedup_stage),
          ("suffix_dedup", suffix_dedup_stage), ("packing", packing_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = C.stage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
