"""Schemas of the input files."""

from pyspark.sql import types as T

GRAPH = T.StructType([
    T.StructField("paper", T.StringType()),
    T.StructField("citation_data", T.StringType()),
    T.StructField("prev_score", T.FloatType()),
    T.StructField("pub_year", T.IntegerType()),
])
METRICS = ("pagerank", "attrank", "3y-cc", "cc")
SCORES = T.StructType([
    *(T.StructField(c, T.StringType()) for c in ("openaire_id", "pid", "type", "year")),
    *(T.StructField(c, T.DoubleType()) for c in ("pagerank", "attrank", "cc", "3y-cc")),
])
CONCEPTS = T.StructType([T.StructField("doi", T.StringType()), T.StructField("concept", T.StringType()), T.StructField("confidence", T.DoubleType())])
