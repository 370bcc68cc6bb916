"""Concepts of papers, field-weighted citation impact, and impact classes within each concept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixpoint import drop, save
from ..sources.schemas import METRICS
from .classes import TOPS

LABELS = ("C1", "C2", "C3", "C4", "C5")


def scores_by_id(scores: DataFrame) -> DataFrame:
    """One row per openaire_id: the largest of each metric, the least type and year."""
    return scores.groupBy("openaire_id").agg(*(F.max(F.col(f"`{m}`")).alias(m) for m in METRICS), F.min("type").alias("type"), F.min("year").alias("year"))


def bridge(scores: DataFrame) -> DataFrame:
    return scores.select("openaire_id", "pid")


def concept_confidence(concepts: DataFrame, ids: DataFrame, min_confidence: float | None = None) -> DataFrame:
    """(openaire_id, concept, confidence): the largest confidence over a paper's pids."""
    if min_confidence is not None:
        concepts = concepts.where(F.col("confidence") >= min_confidence)
    found = concepts.join(ids, F.col("doi") == F.col("pid"))
    return found.groupBy("openaire_id", "concept").agg(F.max("confidence").alias("confidence"))


def top_concepts(confidence: DataFrame, k: int = 3) -> DataFrame:
    """The k concepts of highest confidence of each paper; ties go to the concept that sorts first."""
    rank = F.row_number().over(Window.partitionBy("openaire_id").orderBy(F.desc_nulls_last("confidence"), "concept"))
    return confidence.withColumn("rn", rank).where(F.col("rn") <= k).drop("rn")


def fact(top: DataFrame, by_id: DataFrame) -> DataFrame:
    """One row per paper and concept: id, concept, metrics, type, year."""
    return top.join(by_id, "openaire_id").select(F.col("openaire_id").alias("id"), "concept", *(F.col(f"`{m}`") for m in METRICS), "type", "year")


def expected(d: DataFrame) -> DataFrame:
    """Mean citations by concept, type and year; null unless positive."""
    mean = d.groupBy("concept", "type", "year").agg(F.avg("cc").alias("a"), F.avg(F.col("`3y-cc`")).alias("b"))
    return mean.select("concept", "type", "year", *(F.when(F.col(c) > 0, F.col(c)).alias(n) for c, n in (("a", "expected_cc"), ("b", "expected_3y"))))


def fwci(d: DataFrame) -> DataFrame:
    """d with fwci and 3y-fwci: citations over the expected ones; null where those are, or where type or year is null."""
    e = expected(d.select("concept", "type", "year", "cc", F.col("`3y-cc`")))
    joined = d.join(e, ["concept", "type", "year"], "left")
    return joined.withColumn("fwci", F.col("cc") / F.col("expected_cc")).withColumn("3y-fwci", F.col("`3y-cc`") / F.col("expected_3y")).drop("expected_cc", "expected_3y")


def offset(n: Column, share: float) -> Column:
    return F.greatest(F.lit(1).cast("long"), F.floor(n * F.lit(share)))


def topic_offsets(d: DataFrame) -> DataFrame:
    """(concept, n, and the papers allowed in each top share)."""
    counts = d.groupBy("concept").agg(F.count("*").alias("n"))
    return counts.select("concept", "n", *(offset(F.col("n"), p).alias(f"{k}_offset") for k, p in TOPS))


def running_count_by_concept(d: DataFrame) -> DataFrame:
    """(concept, metric, value, n, cumulative): one pass for all metrics.

    A prefix sum in two levels, as a concept may hold most papers: values are dealt by ranges, counts run
    within a range, and each range of a concept and metric begins at the total of those before it.
    """
    pairs = F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(f"`{m}`").alias("value")) for m in METRICS))).alias("p")
    hist = d.select("concept", pairs).groupBy("concept", F.col("p.metric").alias("metric"), F.col("p.value").alias("value")).agg(F.count("*").alias("n"))
    parts = int(d.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = save(hist.repartitionByRange(parts, "concept", "metric", F.desc_nulls_last("value")).withColumn("part", F.spark_partition_id()), "running")
    group = Window.partitionBy("concept", "metric")
    totals = dealt.groupBy("concept", "metric", "part").agg(F.sum("n").alias("total"))  # a row for each range, and one for each concept and metric
    before = totals.select("concept", "metric", "part", F.coalesce(F.sum("total").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    within = F.sum("n").over(Window.partitionBy("concept", "metric", "part").orderBy(F.desc_nulls_last("value")).rowsBetween(Window.unboundedPreceding, 0))
    out = dealt.withColumn("within", within).join(before, ["concept", "metric", "part"]).select("concept", "metric", "value", "n", (F.col("within") + F.col("before")).alias("cumulative"))
    out._saved_at = dealt._saved_at
    return out


def topic_thresholds(d: DataFrame) -> DataFrame:
    """(concept, and for each metric its four cut-offs): one pivoting aggregate."""
    counts = running_count_by_concept(d)
    run = counts.join(topic_offsets(d), "concept")
    cuts = [
        F.min(F.when((F.col("metric") == m) & (F.col("cumulative") <= F.col(f"{k}_offset")), F.col("value"))).alias(f"{m}_{k}")
        for m in METRICS
        for k, _ in TOPS
    ]
    out = save(run.groupBy("concept").agg(*cuts), "cuts")
    drop(counts)
    return out


def topic_classes(d: DataFrame, cuts: DataFrame) -> DataFrame:
    """d with a class C1 to C5 per metric; C5 where no cut-off is reached."""

    def label(m: str) -> Column:
        out = F.lit(LABELS[4])
        for name, (k, _) in reversed(list(zip(LABELS, TOPS, strict=False))):
            out = F.when(F.col(f"`{m}`") >= F.col(f"`{m}_{k}`"), name).otherwise(out)
        return out.alias(f"{m}_class")

    return d.join(cuts, "concept", "left").select(*(F.col(f"`{c}`") for c in d.columns), *(label(m) for m in METRICS))


def report(cuts: DataFrame) -> DataFrame:
    """The table of cut-offs by concept: a row each, in order, named as in the output."""
    return cuts.distinct().orderBy("concept")


def by_pid(d: DataFrame, ids: DataFrame, keep_null: bool = True) -> DataFrame:
    """Rows of d for every pid of their paper, as identifier; papers without a pid stay as null unless told otherwise."""
    rows = d.join(ids.select(F.col("openaire_id").alias("id"), F.col("pid").alias("identifier")), "id").drop("id")
    return rows if keep_null else rows.where(F.col("identifier").isNotNull())
