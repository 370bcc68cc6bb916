"""Stages of the pipeline where tasks share a small heap."""

import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from impactory.llm import line_quality, toxicity
from impactory.llm.common import BYTES_PER_GROUP, ROWS_PER_BATCH, materialize

NAMES = ("spark.sql.parquet.columnarReaderBatchSize", "parquet.block.size")
#: Eight files of 4096 different texts of 10 KB, which compress well; eight tasks of half a GB.
RUN = """
import sys
from pyspark.sql import SparkSession, functions as F
spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", f"file://{sys.argv[1]}/shared").getOrCreate()
from impactory.llm import line_quality, toxicity
stage = {"toxicity": toxicity.keep_clean, "quality": line_quality.keep_good}[sys.argv[2]]
docs = spark.read.parquet(f"{sys.argv[1]}/documents.parquet")
stage(spark, docs, sys.argv[1]).write.parquet(f"{sys.argv[1]}/out")
print("rows", spark.read.parquet(f"{sys.argv[1]}/out").count())
"""


@pytest.fixture
def settings(spark):
    yield
    for name in NAMES:
        spark.conf.unset(name)


@pytest.mark.parametrize("stage", ["toxicity", "quality"])
def test_a_stage_on_long_rows(spark, tmp_path, stage):
    spark.range(8 * 4096, numPartitions=8).select(F.col("id").alias("doc_id"), F.concat(F.col("id").cast("string"), F.repeat(F.lit(" word"), 2000)).alias("text")).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    env = os.environ | {"PYTHONPATH": str(Path(__file__).resolve().parents[2]), "PYSPARK_SUBMIT_ARGS": "--driver-memory 512m pyspark-shell"}
    done = subprocess.run([sys.executable, "-c", RUN, str(tmp_path), stage], env=env, capture_output=True, text=True, timeout=300)
    assert done.stdout.strip().endswith(f"rows {8 * 4096}"), done.stderr[-2000:]


def test_row_groups_of_a_stage_are_small(spark, tmp_path, settings):
    import pyarrow.parquet as pq

    spark.range(3000, numPartitions=1).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *(F.sha2(F.concat(F.col("id"), F.lit(f":{k}")), 512) for k in range(100))).alias("text")).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = materialize(line_quality.keep_good(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)), "test-groups")
    groups = [pq.ParquetFile(f.removeprefix("file://")).metadata.num_row_groups for f in out.inputFiles()]
    assert out.count() == 3000 and max(groups) > 1
    assert int(spark.conf.get(NAMES[0])) == ROWS_PER_BATCH and int(spark.conf.get(NAMES[1])) == BYTES_PER_GROUP


def test_smaller_settings_stay(spark, tmp_path, settings):
    spark.conf.set(NAMES[0], "64")
    spark.conf.set(NAMES[1], "1048576")
    spark.createDataFrame([(1, "a text")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert toxicity.keep_clean(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)).count() == 1
    assert [spark.conf.get(n) for n in NAMES] == ["64", "1048576"]
