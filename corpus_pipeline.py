"""The corpus pipeline: toxicity, quality, near duplicates, secrets, packing.

Rows: null and empty texts pass through the stages as texts without words (one of them stays in near
duplicates) and are packed as their end token alone; very long texts are read whole; repeated rows and
ties have one verdict, and of equal texts one row stays; null ids are kept and never name anything; an
empty table yields an empty one. All stages but the last keep every column of documents, whatever its
name, and read doc_id and text only (secrets renews n_chars, where there is one).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from impactory.llm import line_quality, packing, secret_scan, simhash, toxicity
from impactory.llm.common import load, materialize

STAGES = [
    ("toxicity", toxicity.keep_clean),
    ("quality", line_quality.keep_good),
    ("near_duplicates", simhash.keep_one),
    ("secrets", secret_scan.redact),
    ("packing", packing.pack_stage),
]

#: The stages apply trained models and connected components, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each result is written as Parquet and read again."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
