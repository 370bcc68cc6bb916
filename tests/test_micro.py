"""Hand-written graphs and tables: parsing, ties, years, fixpoints."""

import math

import pytest
from pyspark.sql import functions as F

from impactory.functions import graph as G
from impactory.functions.fixpoint import iterate
from impactory.operators import classes as C
from impactory.operators import rankings as R
from impactory.operators import topics as T
from impactory.sources import schemas, tsv


def graph(spark, rows, mode="asis"):
    """rows: (paper, citation_data, year)."""
    lines = spark.createDataFrame([(p, d, 0.0, y) for p, d, y in rows], schemas.GRAPH)
    return G.graph_of(G.parse(lines, mode))


def scores(df):
    return {r["paper"]: r["score"] for r in df.collect()}


def test_ids_with_separators_and_dangling_rule(spark):
    g = graph(spark, [("a|b", "c,d|e|2|0.25", 2000), ("c", "0|0|0.25", 2001), ("d|e", "0,a|b|1|0.5", None), ("x", None, 2000)])
    assert {(r["src"], r["dst"]) for r in g.edges.collect()} == {("a|b", "c"), ("a|b", "d|e")}
    nodes = {r["paper"]: r for r in g.nodes.collect()}
    assert nodes["c"]["dangling"] and nodes["d|e"]["dangling"] and nodes["x"]["dangling"] is None
    assert nodes["a|b"]["initial"] == 0.25 and nodes["x"]["initial"] is None
    decoded = spark.createDataFrame([("acomma_charb",)], "id string").select(tsv.decode_ids("id").alias("d")).first()["d"]
    assert decoded == "a,b"


def test_repeats_self_references_and_missing_papers(spark):
    g = graph(spark, [("a", "b,b,a,ghost|4|0.5", 2000), ("b", "0|0|0.5", 2001)])
    assert scores(R.citation_count(g)) == {"a": 1, "b": 2}
    one = scores(R.pagerank_one_step(g, 0.5))
    assert one["a"] == pytest.approx(0.5 * (0.5 / 4 + 0.25) + 0.25)
    assert one["b"] == pytest.approx(0.5 * (0.5 * 2 / 4 + 0.25) + 0.25)


def test_years_and_limits(spark):
    rows = [("a", "d|1|0", 2005), ("b", "d|1|0", 1990), ("c", "d|1|0", None), ("e", "d|1|0", 3000), ("d", "0|0|0", 2000)]
    g = graph(spark, rows)
    assert scores(R.citation_count(g, 5))["d"] == 2  # 2005, and 1990 from before
    assert scores(R.citation_count(g, 5, require_nonnegative=True))["d"] == 1
    assert scores(R.citation_count(g, 0))["d"] == 4
    assert scores(R.ram(g, 0.5, 2010))["d"] == pytest.approx(0.5**5 + 0.5**20)


def test_no_dangling_no_citations_and_zero_max(spark):
    g = graph(spark, [("a", "b|1|0.5", 2000), ("b", "a|1|0.5", 2000)])
    got = scores(R.pagerank(g, 0.5, 1e-9))
    assert got["a"] == pytest.approx(0.5) and got["b"] == pytest.approx(0.5)
    alone = graph(spark, [("a", "0|0|1", 2000)])
    out = C.classify(R.citation_count(alone), "cc").first()
    assert out["cc"] == 0 and out["normalized_cc"] is None


def test_pagerank_sums_to_one_and_ignores_partitioning(spark):
    rows = [(f"p{i}", (",".join(f"p{j}" for j in range(i) if (i + j) % 3 == 0) or "0") + "|0|0.05", 2000 + i) for i in range(20)]
    g = graph(spark, rows)
    a = scores(R.pagerank(g, 0.5, 1e-10))
    assert sum(a.values()) == pytest.approx(1)
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    b = scores(R.pagerank(g, 0.5, 1e-10))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert all(a[k] == pytest.approx(b[k]) for k in a)


def test_cycle_of_two_in_path_sums(spark):
    g = graph(spark, [("a", "b|1|0", 2010), ("b", "a|1|0", 2010)])
    got = R.ecm(g, 0.5, 0.5, 2011, 1e-12).collect()
    assert all(r["score"] == pytest.approx(0.25 / 0.75) and r["year"] == 2010 for r in got)


def test_null_years_in_attention_rank(spark):
    g = graph(spark, [("a", "b|1|0.5", None), ("b", "0|0|0.5", 2000)])
    args = (0.2, 0.5, 0.3, -0.1, 2005, 2000, 1e-9)
    assert scores(R.attrank(g, *args))["a"] is None
    assert scores(R.attrank(g, *args, null_year="zero"))["a"] is not None
    with pytest.raises(ValueError):
        R.age_vector(g, -0.1, 2005, "other")


def test_offsets_and_clamps():
    assert C.offsets(9_999) == {"top001": 1, "top01": 1, "top1": 99, "top10": 999}
    assert C.offsets(10_000) == {"top001": 1, "top01": 1, "top1": 100, "top10": 1000}
    assert C.offsets(10_000, "fixed")["top01"] == 10
    assert C.offsets(20_000) == {"top001": 2, "top01": 20, "top1": 200, "top10": 2000}
    with pytest.raises(ValueError):
        C.offsets(1, "other")


def test_ties_never_split(spark):
    df = spark.createDataFrame([(f"p{i}", float(100 - i // 30)) for i in range(300)], "paper string, score double")
    cuts = C.thresholds(df).first()
    assert cuts["top001"] is None and cuts["top1"] is None and cuts["top10"] == 100.0
    by = {r["five_point_class"]: r["n"] for r in C.classify(df, "x").groupBy("five_point_class").agg(F.count("*").alias("n")).collect()}
    assert by == {"D": 30, "E": 270}


def test_running_count_over_many_partitions_with_nulls(spark):
    values = [float(i % 37) for i in range(500)] + [None] * 3
    df = spark.createDataFrame([(f"p{i}", v) for i, v in enumerate(values)], "paper string, score double")
    for r in C.running_count(C.histogram(df)).collect():
        expect = len(values) if r["score"] is None else sum(v is not None and v >= r["score"] for v in values)
        assert r["cumulative"] == expect


def test_top_concepts_ties_nulls_and_unmatched(spark):
    scores_ = spark.createDataFrame([("o1", "d1"), ("o1", "d2"), ("o2", "d3")], "openaire_id string, pid string")
    concepts = spark.createDataFrame([("d1", "c3", 0.5), ("d2", "c1", 0.5), ("d1", "c2", 0.5), ("d1", "c4", None), ("d1", "c5", 0.9), ("d9", "c1", 1.0)], schemas.CONCEPTS)
    got = T.top_concepts(T.concept_confidence(concepts, scores_)).collect()
    assert {r["concept"] for r in got} == {"c5", "c1", "c2"}


def test_empty_graph(spark):
    g = graph(spark, [])
    assert R.citation_count(g).count() == 0 and R.pagerank(g, 0.5, 1e-6).count() == 0 and R.ram(g, 0.5, 2000).count() == 0
    assert R.ecm(g, 0.5, 0.5, 2000, 1e-6).count() == 0 and R.ecm(g, 0.5, 0.5, 2000, 1e-6).columns == ["paper", "score", "year"]
    assert C.classify(R.citation_count(g), "cc").count() == 0


def test_repeated_papers(spark):
    rows = [("a", "b|1|0.5", 2000), ("a", "c|1|0.5", 1999), ("b", "0|0|0.5", 2000)]
    with pytest.raises(ValueError):
        graph(spark, rows, "strict")
    assert graph(spark, rows, "permissive").nodes.count() == 2
    with pytest.raises(ValueError):
        graph(spark, rows, "other")


def test_fixpoint_guards(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    with pytest.raises(ValueError):
        iterate(df, lambda s, _: s, {"error": F.max("x")}, "error", 0)
    with pytest.raises(RuntimeError):
        iterate(df, lambda s, _: s, {"error": F.max("x")}, "error", 0.5, max_iter=3)
    with pytest.raises(ValueError):
        iterate(df, lambda s, _: s, {"error": F.max(F.lit(None).cast("double"))}, "error", 0.5)


def test_quotes_and_bad_lines_in_files(spark, tmp_path):
    (tmp_path / "g.tsv").write_text('"a\tb|1|x\t0\t\\N\nb\t0|0|0.5\tzzz\t2001\nshort\n')
    rows = {r["paper"]: r for r in G.parse(tsv.read_graph(spark, str(tmp_path / "g.tsv")), "asis").collect()}
    assert rows['"a']["pub_year"] is None and rows['"a']["initial"] is None and rows["b"]["initial"] == 0.5
    assert rows["short"]["cited"] is None


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_ansi_modes(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        g = graph(spark, [("a", "b|1|0.25", 2000), ("b", "0|0|bad", 2001)])
        assert math.isclose(scores(R.pagerank_one_step(g, 0.5))["b"], 0.5 * 0.25 + 0.25)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_command_line(spark, tmp_path):
    from impactory import cli

    (tmp_path / "g.tsv").write_text("a\tb|1|0.5\t0\t2000\nb\t0|0|0.5\t0\t2001\n")
    a = cli.parser().parse_args(["pagerank", str(tmp_path / "g.tsv"), str(tmp_path / "out"), "--alpha", "0.5", "--error", "1e-6"])
    path = cli.rank(spark, a)
    assert path.endswith("PR_g.tsv_a0.5_error1e-06")
    assert tsv._reader(spark, header=True).csv(path).columns == ["doi", "pr", "normalized_pr", "three_point_class", "five_point_class"]
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["pagerank", "x", "y", "--alpha", "0.5", "--error", "zero?"])


def test_a_step_moves_sums_only(spark):
    """Edges and state stay in their buckets: the one exchange is that of the sums by cited paper."""
    from impactory.functions.fixpoint import drop, save
    from impactory.operators import rankings

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        edges = save(spark.createDataFrame([(f"p{i}", f"p{i // 2}", 1.0) for i in range(50)], "src string, dst string, share double"), "edges", by="src")
        state = save(spark.createDataFrame([(f"p{i}", 0.02) for i in range(50)], "paper string, score double"), "rank", by="paper")
        got = state.join(rankings.contributions(edges, state), F.col("paper") == F.col("dst"), "left").select("paper", F.col("in"))
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(dst") == 1 and plan.count("Exchange") == 1
        assert got.agg(F.sum("in")).first()[0] == pytest.approx(1.0)
        drop(edges, state)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_command_line_reports_and_years(spark, tmp_path, capsys):
    from impactory import cli

    lines = ["a\tb,c|2|0.25\t0\t2001", "b\tc|1|0.25\t0\t2000", "c\t0|0|0.25\t0\t1999", "d\ta|1|0.25\t0\t\\N"]
    (tmp_path / "g.tsv").write_text("\n".join(lines) + "\n")
    a = cli.parser().parse_args(["ecm", str(tmp_path / "g.tsv"), str(tmp_path / "out"), "--alpha", "0.5", "--error", "1e-6", "--current-year", "2002", "--gamma", "0.5"])
    path = cli.rank(spark, a)
    said = capsys.readouterr().out
    assert "step 1\t" in said and "papers\t4" in said and "max\t" in said and "Percentage\tScore" in said
    years = {r["doi"]: r["year"] for r in spark.read.csv(str(tmp_path / "out" / f"years_{path.rsplit('/', 1)[-1]}"), sep="\t", header=True, nullValue="\\N").collect()}
    assert years == {"a": "2001", "b": "2000", "c": "1999", "d": None}


def test_shared_folder_is_asked_for_on_a_cluster(spark, monkeypatch):
    from impactory.functions import fixpoint

    class Elsewhere:
        class sparkContext:
            master = "yarn"
            getCheckpointDir = staticmethod(lambda: None)

        class conf:
            get = staticmethod(lambda *_: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        fixpoint.shared_folder(Elsewhere)
