"""Readers of citation graphs, score tables and concept tables in tab-separated files.

A path may be a file, a gzip file or a folder of parts. Quoting is off, so an id may start with a quote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas


def _reader(spark: SparkSession, header: bool = False):
    return spark.read.options(sep="\t", quote="", escape="", nullValue="\\N", header=header, mode="PERMISSIVE")


def read_graph(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Lines of a graph file; hash-partitioned by paper if a number of partitions is given."""
    lines = _reader(spark).schema(schemas.GRAPH).csv(path)
    return lines.repartition(partitions, "paper") if partitions else lines


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    return _reader(spark, header=True).schema(schemas.SCORES).csv(path)


def read_concepts(spark: SparkSession, path: str) -> DataFrame:
    return _reader(spark).schema(schemas.CONCEPTS).csv(path)


def write_tsv(df: DataFrame, path: str, header: bool = True, gzip: bool = False, null: str = "\\N") -> str:
    writer = df.write.mode("overwrite").options(sep="\t", quote="", escape="", nullValue=null, emptyValue="")
    (writer.option("compression", "gzip") if gzip else writer).csv(path, header=header)
    return path


def decode_ids(column: str):
    """Ids carry commas as comma_char in graph files."""
    return F.replace(F.col(column), F.lit("comma_char"), F.lit(","))


def rank_name(metric: str, source: str, **parameters: object) -> str:
    """The folder name of a ranking: metric, input name without .gz, parameters in order."""
    name = source.rstrip("/").rsplit("/", 1)[-1].removesuffix(".gz")
    return "_".join([metric, name, *(f"{k}{v}" for k, v in parameters.items())])
