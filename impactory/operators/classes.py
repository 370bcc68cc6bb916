"""Percentile classes that never split ties, and normalized scores.

A paper is in the top p if at most off(p) papers have its score or a higher one, off(p) = max(1, int(N p)).
The running count over distinct scores is a distributed prefix sum: scores are range-partitioned, each
partition's total is known to all, and counts run within partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixpoint import drop, save
from ..sources.tsv import decode_ids

TOPS = (("top001", 1e-4), ("top01", 1e-3), ("top1", 1e-2), ("top10", 1e-1))


def offsets(n: int, clamp: str = "compat") -> dict[str, int]:
    """Papers allowed in each top share. compat: the 0.1 % one is 1 wherever the 0.01 % one is; fixed: each on its own."""
    if clamp not in {"compat", "fixed"}:
        raise ValueError(f"unknown clamp {clamp}")
    raw = {k: int(n * p) for k, p in TOPS}
    out = {k: max(1, v) for k, v in raw.items()}
    if clamp == "compat" and raw["top001"] <= 1:
        out["top01"] = 1
    return out


def histogram(scores: DataFrame) -> DataFrame:
    """(score, n); null is a score that comes last."""
    return scores.groupBy("score").agg(F.count("*").alias("n"))


def running_count(hist: DataFrame) -> DataFrame:
    """(score, n, cumulative): how many papers have the score or a higher one."""
    spark = hist.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = hist.repartitionByRange(parts, F.col("score").desc_nulls_last()).withColumn("part", F.spark_partition_id())
    dealt = save(dealt, "histogram")
    totals = {r["part"]: r["n"] for r in dealt.groupBy("part").agg(F.sum("n").alias("n")).collect()}  # a row for each partition
    before, so_far = {}, 0
    for part in sorted(totals):
        before[part], so_far = so_far, so_far + totals[part]
    base = F.create_map(*(F.lit(x) for kv in before.items() for x in kv))[F.col("part")] if before else F.lit(0)
    within = F.sum("n").over(Window.partitionBy("part").orderBy(F.col("score").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0))
    out = dealt.select("score", "n", (within + base).cast("long").alias("cumulative"))
    out._saved_at = dealt._saved_at
    return out


def thresholds(scores: DataFrame, clamp: str = "compat") -> DataFrame:
    """One row: n_papers, max_score, and the least score in each top share (null if a tie at the top is too large for it).

    The scores are read once: the number of papers is that of their histogram.
    """
    hist = save(histogram(scores), "scores")
    off = offsets(hist.agg(F.sum("n")).first()[0] or 0, clamp)
    counts = running_count(hist)
    cuts = [F.min(F.when(F.col("cumulative") <= off[k], F.col("score"))).alias(k) for k, _ in TOPS]
    out = save(counts.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_papers"), F.max("score").alias("max_score"), *cuts), "thresholds")
    drop(hist, counts)
    return out


def _class(score: Column, cuts: list[tuple[str, Column]], last: str) -> Column:
    out = F.lit(last)
    for name, cut in reversed(cuts):
        out = F.when(score >= cut, name).otherwise(out)
    return out


def classify(scores: DataFrame, metric: str, clamp: str = "compat", cuts: DataFrame | None = None) -> DataFrame:
    """doi, <metric>, normalized_<metric>, three_point_class, five_point_class; cuts: thresholds() of the scores, if known already."""
    t = F.broadcast(thresholds(scores, clamp) if cuts is None else cuts)  # one row
    x = F.col("score")
    three = _class(x, [("A", F.col("top001")), ("B", F.col("top1"))], "C")
    five = _class(x, list(zip("ABCD", (F.col(k) for k, _ in TOPS), strict=True)), "E")
    return scores.join(t).select(decode_ids("paper").alias("doi"), x.alias(metric), F.try_divide(x.cast("double"), F.col("max_score").cast("double")).alias(f"normalized_{metric}"), three.alias("three_point_class"), five.alias("five_point_class"))


def report(scores: DataFrame, clamp: str = "compat", cuts: DataFrame | None = None) -> DataFrame:
    """(percentage, score): the printed table of cut-offs."""
    t = thresholds(scores, clamp) if cuts is None else cuts
    rows = [F.struct(F.lit(100 * p).alias("percentage"), F.col(k).cast("double").alias("score")) for k, p in TOPS]
    return t.select(F.explode(F.array(*rows)).alias("r")).select("r.percentage", "r.score")
