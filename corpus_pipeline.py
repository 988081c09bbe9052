"""The corpus pipeline: documents through toxicity, near-dedup, decontamination, PII and packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns of
documents. Documents without an id can't be told apart by one and are never taken for copies.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm import decontaminate, minhash, packing, pii, toxicity
from panelforge.llm.common import read_table, stage_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon calls toxic go. Null and empty texts stay; repeated rows are judged each; without labels
    or documents nothing goes."""
    lexicon = toxicity.train(docs, read_table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.score_toxicity(docs, lexicon).where("predicted = 0").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked at five-word similarity 0.8 or more the smallest doc_id stays, with all its rows. Documents
    without words or id are linked with nothing and stay; an empty table gives no row."""
    found = minhash.near_duplicates(docs.select("doc_id", "text"), percent=80, banding=minhash.Banding(rows=10))
    return docs.join(found.where("not kept").select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a hit on at least a twentieth of their words go. Texts without words stay, as does everything if the
    benchmark is empty; repeated rows are judged each."""
    found = decontaminate.find_contamination(docs, read_table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.where(~decontaminate.is_contaminated(F.col("n_words"), F.col("n_hit"))).select(*docs.columns)


def replace_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Entities become surrogates, and n_chars (where there is one) follows the new text. Texts without an entity, null
    ones among them, stay as they are; no row goes."""
    out = pii.replace_entities(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_entities") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece, as in ``packing.pack``: null text is its end id alone, an empty table gives no row."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("pii", replace_pii),
    ("packing", pack_sequences),
]

#: Toxicity scores and token ids are beyond SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage's rows are written to the shared folder and reread as the next one's documents, so that each runs once."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage_table(spark, name, functools.partial(stage, spark, docs, sf_dir))
    return docs
