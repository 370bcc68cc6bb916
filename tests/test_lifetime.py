"""Who deletes written tables, repeated papers without moving references, and fixpoints that go on after a driver is lost."""

import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from impactory import cli
from impactory.functions import graph as G
from impactory.functions.fixpoint import Files, Scratch, iterate, save, shared_folder
from impactory.operators import rankings as R
from impactory.sources import schemas

ROWS = [(f"p{i}", ",".join(f"p{(i * k + 1) % 40}" for k in range(1, 2 + i % 4)) + f"|{1 + i % 4}|0.025" if i % 7 else "0|0|0.025", 0.0, 1990 + i % 20) for i in range(40)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def state_of(spark):
    return Files(spark, shared_folder(spark)).names(), sorted(r[0] for r in spark.sql("SHOW DATABASES").collect()), spark.sql("SHOW TABLES").count()


def test_a_scope_deletes_files_and_entries(spark):
    before = state_of(spark)
    with Scratch(spark) as outer:
        a = save(spark.range(10).toDF("x"), "a", by="x")
        with Scratch(spark) as inner:
            b = save(spark.range(5).toDF("x"), "b")
            assert b.count() == 5 and b._saved_at.startswith(inner.folder)
        assert not inner.files.exists() and a.count() == 10 and a._saved_at.startswith(outer.folder)
    assert not outer.files.exists() and state_of(spark) == before
    with pytest.raises(ZeroDivisionError), Scratch(spark) as failed:
        save(spark.range(5).toDF("x"), "c", by="x")
        1 / 0
    assert not failed.files.exists() and state_of(spark) == before


@pytest.mark.parametrize("command", ["pagerank", "attrank", "ecm", "cc", "topics"])
def test_commands_leave_nothing(spark, tmp_path, command):
    (tmp_path / "g.tsv").write_text("".join(f"{p}\t{d}\t0\t{y}\n" for p, d, _, y in [*ROWS, ROWS[3]]))
    (tmp_path / "scores.tsv").write_text("")
    (tmp_path / "concepts.tsv").write_text("")
    where, numbers = [str(tmp_path / "g.tsv"), str(tmp_path / "out")], {"alpha": "0.5", "error": "1e-4"}
    if command in {"attrank", "ecm"}:
        numbers |= {"current-year": "2010", "gamma": "0.3"}
    if command == "attrank":
        numbers |= {"beta": "0.2", "rho": "-0.1", "start-year": "2005"}
    if command in {"pagerank", "attrank", "ecm"}:
        numbers["resume"] = str(tmp_path / "steps")
    if command == "cc":
        numbers = {}
    if command == "topics":
        from impactory.plans import fixtures as X

        sf = "/root/testdata/sf0.001"
        from impactory.sources import tsv

        with Scratch(spark):
            where = [tsv.write_tsv(X.topic_scores(spark, sf), str(tmp_path / "s")), tsv.write_tsv(X.topic_concepts(spark, sf), str(tmp_path / "c"), header=False), str(tmp_path / "out")]
        numbers = {}
    before = state_of(spark)
    cli.main([command, *where, *(x for k, v in numbers.items() for x in (f"--{k}", v))])
    assert state_of(spark) == before and not (tmp_path / "steps").exists() and any((tmp_path / "out").iterdir())


def test_references_of_single_papers_stay_where_they_are(spark):
    lines = spark.createDataFrame(ROWS, schemas.GRAPH)
    with Scratch(spark):
        assert "Exchange" not in plan_of(G.parse(lines))  # nothing repeated: the written rows
        once = save(G.parse(lines, "asis"), "once")
        names = plan_of(G.repeated_papers(once))
        assert "cited" not in names and "ReadSchema: struct<paper:string>" in names
        plan = plan_of(G.first_of_each(once, G.repeated_papers(once), few=True))
        anti = plan[plan.index("LeftAnti") :]
        own = anti[: anti.index("BroadcastExchange")]
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange" not in own and "cited" in own


@pytest.mark.parametrize("few", [True, False])
def test_the_first_of_repeated_lines(spark, few, monkeypatch):
    monkeypatch.setattr(G, "FEW", 10 if few else 0)
    rows = [*ROWS, ("p3", "p1|1|0.5", 0.0, 1980), ("p3", "p2|1|0.5", 0.0, 1980), ("p3", "p9|1|0.1", 0.0, None), (None, "p1|1|0.5", 0.0, 2000), (None, "p2|1|0.5", 0.0, 1999)]
    with Scratch(spark):
        parsed = G.parse(spark.createDataFrame(rows, schemas.GRAPH).repartition(3), "asis")
        want = parsed.groupBy("paper").agg(F.min(F.struct("pub_year", "initial", "cited")).alias("x")).select("paper", "x.cited", "x.initial", "x.pub_year")
        got = G.parse(spark.createDataFrame(rows, schemas.GRAPH).repartition(3))
        assert got.columns == want.columns and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


KILLED = """
import os, sys
from pyspark.sql import SparkSession
from tests.test_lifetime import ROWS, scores_of
spark = SparkSession.builder.master("local[2]").config(map={"spark.sql.shuffle.partitions": "3", "spark.ui.enabled": "false", "spark.checkpoint.dir": sys.argv[1]}).getOrCreate()
scores_of(spark, sys.argv[2], sys.argv[3], lambda k, error, seconds: k == 3 and os._exit(9))
"""


def scores_of(spark, what, resume, log=None):
    g = G.graph_of(G.parse(spark.createDataFrame(ROWS, schemas.GRAPH)))
    if what == "ecm":
        return R.ecm(g, 0.5, 0.5, 2010, 1e-9, log=log, resume=resume)
    return R.pagerank(g, 0.5, 1e-9, log=log, resume=resume)


@pytest.mark.parametrize("what", ["pagerank", "ecm"])
def test_a_killed_driver_goes_on(spark, tmp_path, what):
    """The driver's process ends after the third step; another one makes the rest and gets the same scores."""
    resume, root = f"file://{tmp_path}/steps", str(Path(__file__).resolve().parent.parent)
    env = os.environ | {"PYTHONPATH": root}
    ended = subprocess.run([sys.executable, "-c", KILLED, f"file://{tmp_path}/other", what, resume], cwd=root, env=env, timeout=200, capture_output=True)
    assert ended.returncode == 9, ended.stderr[-2000:]
    whole, rest = [], []
    with Scratch(spark):
        want = {r["paper"]: r["score"] for r in scores_of(spark, what, None, lambda k, *_: whole.append(k)).collect()}
        got = {r["paper"]: r["score"] for r in scores_of(spark, what, resume, lambda k, *_: rest.append(k)).collect()}
        assert rest == whole[3:] and len(rest) > 1 and got == pytest.approx(want, abs=1e-12)
        again = []  # a finished run has nothing left to do
        assert {r["paper"]: r["score"] for r in scores_of(spark, what, resume, lambda k, *_: again.append(k)).collect()} == got and again == []
        if what == "pagerank":
            with pytest.raises(ValueError, match="another run"):
                R.pagerank(G.graph_of(G.parse(spark.createDataFrame(ROWS, schemas.GRAPH))), 0.4, 1e-9, resume=resume)


def test_a_state_without_an_entry_is_written_again(spark, tmp_path):
    """Cut off between the state and its entry, and before the old state is deleted."""
    resume = f"file://{tmp_path}/steps"
    halve = lambda s, _: s.select((F.col("x") / 2).alias("x"))
    start, measures = spark.createDataFrame([(64.0,)], "x double"), {"error": F.max("x")}

    def stop(k, *_):
        if k == 2:
            raise KeyboardInterrupt

    with Scratch(spark):
        with pytest.raises(KeyboardInterrupt):
            iterate(start, halve, measures, "error", 1.0, log=stop, resume=resume)
        Files(spark, f"{resume}/steps").put("_3.draft", "cut off")
        Files(spark, f"{resume}/states").put("3-orphan", "cut off")
        out, k = iterate(start, halve, measures, "error", 1.0, resume=resume)
        assert k == 7 and out.first()["x"] == 0.5
