"""Command line: python -m impactory.cli pagerank|attrank|cc|ram|ecm|topics ..."""

from __future__ import annotations

import argparse
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.fixpoint import Files, Scratch, save
from .functions.graph import CitationGraph, graph_of, parse
from .operators import classes, rankings, topics
from .sources import tsv

LABELS = {"cc": "CC", "ram": "RAM", "ecm": "ECM", "pagerank": "PR", "attrank": "AttRank"}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="impactory")
    sub = out.add_subparsers(dest="command", required=True)
    for name in LABELS:
        p = sub.add_parser(name)
        p.add_argument("input")
        p.add_argument("output")
        p.add_argument("--partitions", type=int)
        p.add_argument("--mode", choices=("permissive", "strict", "asis"), default="permissive")
        p.add_argument("--clamp", choices=("compat", "fixed"), default="compat")
        if name in {"pagerank", "attrank", "ecm"}:
            p.add_argument("--alpha", type=float, required=True)
            p.add_argument("--error", type=float, required=True)
            p.add_argument("--resume", help="shared folder for finished steps: a run that was cut off goes on from there; deleted when the output is written")
        if name in {"attrank", "ram", "ecm"}:
            p.add_argument("--current-year", type=int, required=True)
            p.add_argument("--gamma", type=float, required=True)
        if name == "attrank":
            for flag in ("--beta", "--rho"):
                p.add_argument(flag, type=float, required=True)
            p.add_argument("--start-year", type=int, required=True)
            p.add_argument("--null-year", choices=("null", "zero"), default="null")
        if name == "cc":
            p.add_argument("--limit-year", type=int)
            p.add_argument("--prefix", default="CC")
    p = sub.add_parser("topics")
    p.add_argument("scores")
    p.add_argument("concepts")
    p.add_argument("output")
    p.add_argument("--top", type=int, default=3)
    p.add_argument("--min-confidence", type=float)
    p.add_argument("--drop-null-pids", action="store_true")
    p.add_argument("--scores-folder", default="bip-db", help="folder of the citation impact files below the output")
    return out


def told(step: int, error: float, seconds: float) -> None:
    print(f"step {step}\terror {error:g}\t{seconds:.1f} s", flush=True)


def scores_of(g: CitationGraph, a: argparse.Namespace) -> tuple[DataFrame, str, dict[str, object]]:
    """Scores (of ECM with the year), the name of the metric's column, and the parameters that name the output."""
    if a.command == "pagerank":
        return rankings.pagerank(g, a.alpha, a.error, log=told, resume=a.resume), "pr", {"a": a.alpha, "error": a.error}
    if a.command == "attrank":
        got = rankings.attrank(g, a.alpha, a.beta, a.gamma, a.rho, a.current_year, a.start_year, a.error, a.null_year, log=told, resume=a.resume)
        return got, "attrank", {"a": a.alpha, "b": a.beta, "c": a.gamma, "rho": a.rho, "year": f"{a.start_year}-{a.current_year}", "error": a.error}
    if a.command == "ram":
        return rankings.ram(g, a.gamma, a.current_year), "ram", {"c": a.gamma, "year": a.current_year}
    if a.command == "ecm":
        return rankings.ecm(g, a.alpha, a.gamma, a.current_year, a.error, log=told, resume=a.resume), "ecm", {"c": a.gamma, "year": a.current_year, "a": a.alpha, "error": a.error}
    return rankings.citation_count(g, a.limit_year), f"{a.limit_year}-cc" if a.limit_year else "cc", {}


def rank(spark: SparkSession, a: argparse.Namespace) -> str:
    """Parse the graph once, score its papers once, print the cut-offs and write the classes (and, of ECM, the years)."""
    began = time.time()
    g = graph_of(parse(tsv.read_graph(spark, a.input, a.partitions), a.mode)).saved
    print(f"graph\t{time.time() - began:.1f} s", flush=True)
    scored, metric, named = scores_of(g, a)
    scores = save(scored, "scored")
    label = a.prefix if a.command == "cc" else LABELS[a.command]
    if a.command == "cc" and a.limit_year:
        label = f"{a.limit_year}-year_{label}"
    began = time.time()
    cuts = classes.thresholds(scores, a.clamp)
    summary = cuts.first()
    print(f"papers\t{summary['n_papers']}\nmax\t{summary['max_score']}\ncut-offs\t{time.time() - began:.1f} s\nPercentage\tScore")
    for r in classes.report(scores, a.clamp, cuts).collect():  # four rows
        print(f"{r['percentage']:g}%\t{r['score']}")
    name = tsv.rank_name(label, a.input, **named)
    out = tsv.write_tsv(classes.classify(scores, metric, a.clamp, cuts), f"{a.output.rstrip('/')}/{name}")
    if "year" in scores.columns:
        tsv.write_tsv(scores.select(tsv.decode_ids("paper").alias("doi"), F.col("score").alias(metric), "year"), f"{a.output.rstrip('/')}/years_{name}")
    if getattr(a, "resume", None):
        Files(spark, a.resume).delete()
    return out


def write_topics(spark: SparkSession, a: argparse.Namespace) -> list[str]:
    out, impact = a.output.rstrip("/"), f"{a.output.rstrip('/')}/{a.scores_folder}"
    raw = tsv.read_scores(spark, a.scores)
    ids = topics.bridge(raw)
    top = save(topics.top_concepts(topics.concept_confidence(tsv.read_concepts(spark, a.concepts), ids, a.min_confidence), a.top), "concepts")
    d = save(topics.fwci(topics.fact(top, topics.scores_by_id(raw))), "fact")
    cuts = topics.topic_thresholds(d)
    # A row for each concept goes by, one partition at a time.
    names = cuts.columns
    print("\t".join(names))
    for r in topics.report(cuts).toLocalIterator():
        print("\t".join(str(r[c]) for c in names))
    pids = save(topics.by_pid(topics.topic_classes(d, cuts), ids, not a.drop_null_pids), "pids")
    classes_ = [F.col(f"`{m}_class`") for m in topics.METRICS]
    plain = {"header": False, "gzip": True, "null": ""}
    paths = [
        tsv.write_tsv(top.orderBy("openaire_id", "confidence"), f"{out}/concepts", header=False),
        tsv.write_tsv(d.select("id", "concept", "fwci"), f"{impact}/FWCI_openaire_ids.txt.gz", **plain),
        tsv.write_tsv(d.select("id", "concept", "3y-fwci"), f"{impact}/3-year_FWCI_openaire_ids.txt.gz", **plain),
        tsv.write_tsv(pids.select("identifier", "concept", *classes_), f"{out}/topics"),
        tsv.write_tsv(pids.select("identifier", "concept", "fwci"), f"{impact}/FWCI.txt.gz", **plain),
        tsv.write_tsv(pids.select("identifier", "concept", "3y-fwci"), f"{impact}/3-year_FWCI.txt.gz", **plain),
    ]
    print(f"rows\t{pids.count()}")
    return paths


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"impactory-{a.command}").getOrCreate()
    with Scratch(spark):
        print(write_topics(spark, a) if a.command == "topics" else rank(spark, a))


if __name__ == "__main__":
    main()
