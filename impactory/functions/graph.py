"""The citation graph: parsed nodes and an edge table.

A node's references keep repeats and ids outside the graph: both count in its out-degree. Only edges
between nodes carry scores, so others are dropped once, after the out-degree is taken.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .fixpoint import drop, save

NO_REFERENCES = "0"
#: So many repeated papers may be broadcast, with names of so many bytes in all.
FEW, FEW_BYTES = 1_000_000, 64 << 20


def cited_papers(data: str = "citation_data") -> Column:
    """All fields but the last two, with their separators, as a list by commas; null for null data."""
    fields = F.split(F.col(data), r"\|")
    return F.split(F.array_join(F.slice(fields, 1, F.greatest(F.size(fields) - 2, F.lit(0))), "|"), ",")


def initial_score(data: str = "citation_data") -> Column:
    """The last field, null if it isn't a number."""
    return F.element_at(F.split(F.col(data), r"\|"), -1).try_cast("double")


def repeated_papers(parsed: DataFrame) -> DataFrame:
    """(paper): those of several rows, null included. Only names are shuffled, counted before that."""
    return parsed.groupBy("paper").count().where("count > 1").select("paper")


def first_of_each(parsed: DataFrame, repeated: DataFrame, few: bool) -> DataFrame:
    """parsed with the first row of each repeated paper only. Rows of other papers stay where they are, if few are repeated."""
    again = repeated.select(F.col("paper").alias("again"))
    again, same = F.broadcast(again) if few else again, parsed["paper"].eqNullSafe(F.col("again"))
    packed = parsed.join(again, same, "left_semi").groupBy("paper").agg(F.min(F.struct("pub_year", "initial", "cited")).alias("x"))
    return parsed.join(again, same, "left_anti").unionByName(packed.select("paper", "x.cited", "x.initial", "x.pub_year"))


def parse(lines: DataFrame, mode: str = "permissive") -> DataFrame:
    """Lines to (paper, cited, initial, pub_year). strict raises on repeated papers; permissive keeps the first line of each.

    permissive writes the parsed lines, looks for repeated names in that column alone, and regroups the lines of those
    only: references of other papers are never shuffled. Names are broadcast if they are few, by their number and
    bytes; beyond that, rows are joined by name.
    """
    out = lines.select("paper", cited_papers().alias("cited"), initial_score().alias("initial"), F.col("pub_year").try_cast("int").alias("pub_year"))
    if mode == "strict":
        if not repeated_papers(out).isEmpty():
            raise ValueError("a paper occurs in several lines")
        return out
    if mode == "permissive":
        once = save(out, "parsed")
        names = save(repeated_papers(once), "repeated", {"n": F.count("*"), "bytes": F.coalesce(F.sum(F.octet_length(F.col("paper").cast("string"))), F.lit(0))})
        if not names._measures["n"]:
            drop(names)
            return once
        return first_of_each(once, names, names._measures["n"] <= FEW and names._measures["bytes"] <= FEW_BYTES)
    if mode != "asis":
        raise ValueError(f"unknown mode {mode}")
    return out


def is_dangling() -> Column:
    return F.get("cited", F.lit(0)) == NO_REFERENCES


def citing(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.get("cited", F.lit(0)) != NO_REFERENCES)


def sane_year(year: Column, current: int) -> Column:
    """Years before 1000 or after the current one become 0; null stays null."""
    return F.when((year < 1000) | (year > current), F.lit(0)).otherwise(year)


@dataclass
class CitationGraph:
    """nodes: paper, pub_year, initial, dangling, n_out. edges: src, dst, src_year; one row per reference, of all references. parsed: what both come from."""

    nodes: DataFrame
    edges: DataFrame
    parsed: DataFrame | None = None

    @property
    def saved(self) -> CitationGraph:
        """The same, parsed once: written, nodes bucketed by paper and edges by the citing paper. drop() deletes it."""
        if hasattr(self.nodes, "_saved_at"):
            return self
        fresh = self.parsed is not None and not hasattr(self.parsed, "_saved_at")
        once = save(self.parsed, "parsed") if fresh else None
        own = self if once is None else graph_of(once)
        out = CitationGraph(save(own.nodes, "nodes", by="paper"), save(own.edges, "edges", by="src"))
        if once is not None:
            drop(once)
        return out

    @property
    def inner(self) -> DataFrame:
        """Edges to nodes: src, dst, weight (how often src cites dst), share (of src's references)."""
        out = self.nodes.select(F.col("paper").alias("src"), "n_out")
        pairs = self.edges.groupBy("src", "dst").agg(F.count("*").alias("weight"), F.max("src_year").alias("src_year"))
        known = self.nodes.select(F.col("paper").alias("dst"))
        return pairs.join(known, "dst", "left_semi").join(out, "src").select("src", "dst", "src_year", "weight", (F.col("weight") / F.col("n_out")).alias("share"))


def graph_of(parsed: DataFrame) -> CitationGraph:
    nodes = parsed.select("paper", "pub_year", "initial", is_dangling().alias("dangling"), F.size("cited").alias("n_out"))
    edges = citing(parsed).select(F.col("paper").alias("src"), F.explode("cited").alias("dst"), F.col("pub_year").alias("src_year"))
    return CitationGraph(nodes, edges, parsed)
