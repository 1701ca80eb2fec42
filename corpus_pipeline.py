"""From raw documents to packed sequences: quality rules, line dedup, near-duplicates, packing.

Each stage takes what the one before it kept and decides over all of it; all but the last return
the columns of ``documents``. Packing needs token ids, which SQL does not have, so ``ORACLE_SQL``
is None and the stages are tested against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from occspark.llm.linededup import drop_boilerplate_lines
from occspark.llm.packing import pack_documents
from occspark.llm.quality import apply_quality_rules
from occspark.llm.simhash import drop_near_duplicates
from occspark.plans.shared import cut, spread

ORACLE_SQL = None


def _carried(docs: DataFrame) -> DataFrame:
    """The columns that a stage reads beside the whole row, so that its own columns clash with none."""
    return docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("__row"), "doc_id", "text", "source")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    return apply_quality_rules(_carried(docs), carry_text=False).filter("kept").select("__row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without boilerplate lines; ``n_chars`` is counted again."""
    out = drop_boilerplate_lines(_carried(docs))
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return out.select(*(new[c].alias(c) if c in new else F.col(f"__row.{c}") for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each near-duplicate component."""
    return drop_near_duplicates(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each one's result written before the next reads it."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs)
    return docs
