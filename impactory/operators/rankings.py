"""Rankings of papers: citation counts, RAM, ECM, PageRank and attention-based rank."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixpoint import drop, iterate, save
from ..functions.graph import CitationGraph, sane_year

ERROR, START = "error", 1000.0


def citation_count(g: CitationGraph, limit_year: int | None = None, require_nonnegative: bool = False) -> DataFrame:
    """(paper, score): references to each paper, repeats included; with a limit, only those at most so many years later.

    A limit of 0 or None is none. Citations from before the cited paper count unless require_nonnegative.
    """
    edges = g.edges
    if limit_year:
        cited = g.nodes.select(F.col("paper").alias("dst"), F.col("pub_year").alias("dst_year"))
        gap = F.col("src_year") - F.col("dst_year")
        near = (gap <= limit_year) & (gap >= 0) if require_nonnegative else gap <= limit_year
        edges = edges.join(cited, "dst").where(near)
    counts = edges.groupBy("dst").agg(F.count("*").alias("n"))
    return g.nodes.select("paper").join(counts, F.col("paper") == F.col("dst"), "left").select("paper", F.coalesce("n", F.lit(0)).alias("score"))


def ram(g: CitationGraph, gamma: float, current_year: int) -> DataFrame:
    """(paper, score): each citation weighs gamma to the power of the citing paper's age."""
    year = sane_year(F.col("src_year"), current_year)
    sums = g.edges.select("dst", F.pow(F.lit(gamma), current_year - year).alias("w")).groupBy("dst").agg(F.sum("w").alias("s"))
    return g.nodes.select("paper").join(sums, F.col("paper") == F.col("dst"), "left").select("paper", F.coalesce("s", F.lit(0.0)).alias("score"))


def ecm(g: CitationGraph, alpha: float, gamma: float, current_year: int, tolerance: float, max_iter: int = 500, log=None, resume: str | None = None) -> DataFrame:
    """(paper, score, year): sums over citation paths, each step weighing alpha * gamma ** age of the citing paper. A graph without papers has no rows."""
    own, g = g, g.saved
    if g.nodes.isEmpty():
        return g.nodes.select("paper", F.lit(0.0).alias("score"), F.col("pub_year").alias("year"))
    year = sane_year(F.col("src_year"), current_year)
    step_weight = F.col("weight") * alpha * F.pow(F.lit(gamma), current_year - year)
    edges = save(g.inner.select("src", "dst", step_weight.alias("w")), "ecm-edges", by="src")

    def step(state: DataFrame, _: dict) -> DataFrame:
        sent = edges.join(state.where("r > 0").select(F.col("paper").alias("src"), "r"), "src")
        got = state.join(sent.groupBy("dst").agg(F.sum(F.col("w") * F.col("r")).alias("in")), F.col("paper") == F.col("dst"), "left")
        into = F.coalesce("in", F.lit(0.0))
        return got.select("paper", "pub_year", into.alias("r"), (F.col("total") + into).alias("total"))

    start = g.nodes.select("paper", "pub_year", F.lit(1.0).alias("r"), F.lit(0.0).alias("total"))
    out, _ = iterate(start, step, {ERROR: F.max("r")}, ERROR, tolerance, max_iter, "ecm", "paper", log, resume, {"alpha": alpha, "gamma": gamma, "year": current_year})
    drop(edges)
    if own is not g:
        drop(g.nodes, g.edges)
    return out.select("paper", F.col("total").alias("score"), sane_year(F.col("pub_year"), current_year).alias("year"))


def contributions(edges: DataFrame, state: DataFrame) -> DataFrame:
    """(dst, in): what papers get from those that cite them, each sharing its score among its references."""
    sent = edges.join(state.select(F.col("paper").alias("src"), "score"), "src")
    return sent.groupBy("dst").agg(F.sum(F.col("score") * F.col("share")).alias("in"))


def dangling_mass(state: DataFrame):
    return F.coalesce(F.sum(F.when(F.col("dangling"), F.col("score"))), F.lit(0.0))


def _power(g: CitationGraph, start: DataFrame, alpha: float, jump, tolerance: float, max_iter: int, log, resume: str | None, run: dict) -> DataFrame:
    """(paper, score): the fixpoint of alpha * (received + dangling mass / N) + jump over start, of paper, dangling, score and what jump reads.

    Edges stay in buckets of the citing paper and the state in those of the paper, so a step moves sums by cited paper only.
    """
    n = g.nodes.count()
    if not n:
        return start.select("paper", "score")
    edges = save(g.inner.select("src", "dst", "share"), "edges", by="src")
    kept = [c for c in start.columns if c != "score"]

    def step(state: DataFrame, seen: dict) -> DataFrame:
        got = state.withColumnRenamed("score", "old").drop("change")
        got = got.join(contributions(edges, state), F.col("paper") == F.col("dst"), "left")
        new = alpha * (F.coalesce("in", F.lit(0.0)) + seen["mass"] / n) + jump
        return got.withColumn("score", new).select(*kept, "score", F.abs(F.col("score") - F.col("old")).alias("change"))

    measures = {ERROR: F.max("change"), "mass": dangling_mass(start)}
    out, _ = iterate(start.withColumn("change", F.lit(START)), step, measures, ERROR, tolerance, max_iter, "rank", "paper", log, resume, run | {"papers": n})
    drop(edges)
    return out.select("paper", "score")


def pagerank(g: CitationGraph, alpha: float, tolerance: float, max_iter: int = 500, log=None, resume: str | None = None) -> DataFrame:
    """(paper, score) from the initial scores of the file; dangling papers give their score to all alike. resume: see iterate()."""
    own, g = g, g.saved
    n = g.nodes.count()
    start = g.nodes.select("paper", "dangling", F.col("initial").alias("score"))
    out = _power(g, start, alpha, F.lit((1 - alpha) / n if n else 0.0), tolerance, max_iter, log, resume, {"alpha": alpha})
    if own is not g and n:
        drop(g.nodes, g.edges)
    return out


def pagerank_one_step(g: CitationGraph, alpha: float) -> DataFrame:
    n = g.nodes.count()
    start = g.nodes.select("paper", "dangling", F.col("initial").alias("score"))
    mass = start.agg(dangling_mass(start).alias("m")).first()["m"]
    got = start.join(contributions(g.inner, start), F.col("paper") == F.col("dst"), "left")
    return got.select("paper", (alpha * (F.coalesce("in", F.lit(0.0)) + mass / n) + (1 - alpha) / n).alias("score"))


def age_vector(g: CitationGraph, rho: float, current_year: int, null_year: str = "null") -> DataFrame:
    """(paper, age): exp(rho * (current + 1 - year)), normalized to sum 1. null_year: null keeps null years, zero counts them as year 0."""
    if null_year not in {"null", "zero"}:
        raise ValueError(f"unknown null_year {null_year}")
    year = sane_year(F.col("pub_year"), current_year)
    year = F.coalesce(year, F.lit(0)) if null_year == "zero" else year
    raw = g.nodes.select("paper", F.exp(rho * (current_year + 1 - year)).alias("raw"))
    total = raw.agg(F.sum("raw").alias("total"))
    return raw.join(F.broadcast(total)).select("paper", F.try_divide("raw", "total").alias("age"))  # total is one row


def attention_vector(g: CitationGraph, start_year: int, current_year: int) -> DataFrame:
    """(paper, attention): the share of the citations made since start_year; those to papers outside count in the total."""
    recent = g.edges.where(sane_year(F.col("src_year"), current_year) >= start_year).groupBy("dst").agg(F.count("*").alias("n"))
    total = recent.agg(F.sum("n").alias("total"))
    return recent.join(F.broadcast(total)).select(F.col("dst").alias("paper"), (F.col("n") / F.col("total")).alias("attention"))  # total is one row


def attrank_vectors(g: CitationGraph, rho: float, current_year: int, start_year: int, null_year: str = "null") -> DataFrame:
    age = age_vector(g, rho, current_year, null_year)
    attention = attention_vector(g, start_year, current_year)
    return age.join(attention, "paper", "left").select("paper", F.coalesce("attention", F.lit(0.0)).alias("attention"), "age")


def attrank(g: CitationGraph, alpha: float, beta: float, gamma: float, rho: float, current_year: int, start_year: int, tolerance: float, null_year: str = "null", max_iter: int = 500, log=None, resume: str | None = None) -> DataFrame:
    """(paper, score): PageRank whose jumps follow recent attention (beta) and age (gamma)."""
    own, g = g, g.saved
    vectors = attrank_vectors(g, rho, current_year, start_year, null_year)
    start = g.nodes.select("paper", "dangling", F.col("initial").alias("score")).join(vectors, "paper")
    run = {"alpha": alpha, "beta": beta, "gamma": gamma, "rho": rho, "years": [start_year, current_year], "null_year": null_year}
    out = _power(g, start, alpha, beta * F.col("attention") + gamma * F.col("age"), tolerance, max_iter, log, resume, run)
    if own is not g and not g.nodes.isEmpty():
        drop(g.nodes, g.edges)
    return out
