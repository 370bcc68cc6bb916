"""Written tables, the scope that owns them, and a driver for fixpoints that a lost driver can resume."""

from __future__ import annotations

import atexit
import json
import tempfile
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or what setCheckpointDir named. In local mode a temporary one will do; a cluster must name it."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="impactory-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


class Files:
    """A folder of a shared file system, by Spark's own means of reaching it."""

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm, self._conf, self.folder = spark._jvm, spark._jsc.hadoopConfiguration(), folder.rstrip("/")

    def _at(self, name: str):
        path = self._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)
        return path.getFileSystem(self._conf), path

    def exists(self, name: str = "") -> bool:
        fs, path = self._at(name)
        return fs.exists(path)

    def delete(self, name: str = "") -> None:
        fs, path = self._at(name)
        fs.delete(path, True)

    def names(self) -> list[str]:
        fs, path = self._at("")
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def put(self, name: str, content: str) -> None:
        """A small file, whole or not at all: written under another name and renamed."""
        fs, path = self._at(name)
        _, draft = self._at(f"_{name}.{uuid.uuid4().hex}")
        out = fs.create(draft)
        out.write(bytearray(content.encode()))
        out.close()
        if not fs.rename(draft, path):
            raise OSError(f"{path.toString()} is there already")

    def get(self, name: str) -> str:
        fs, path = self._at(name)
        read = fs.open(path)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(read, "UTF-8")
        finally:
            read.close()


class Scratch:
    """Owns every table that save() writes while it is open: files in a folder of its own below the shared one,
    catalog entries in a database of its own. Leaving it deletes both, whatever still refers to them.

        with Scratch(spark):
            pagerank(g, 0.5, 1e-9).write.parquet(out)
    """

    _open: list[Scratch] = []
    _roots: dict[str, Scratch] = {}

    def __init__(self, spark: SparkSession):
        self.spark, self.name = spark, f"impactory_{uuid.uuid4().hex}"
        self.files = Files(spark, f"{shared_folder(spark)}/{self.name}")
        self._database = False

    @classmethod
    def current(cls, spark: SparkSession) -> Scratch:
        """The innermost open one, or that of the application, which lasts until Python ends."""
        own = [s for s in cls._open if s.spark.sparkContext is spark.sparkContext]
        if own:
            return own[-1]
        app = spark.sparkContext.applicationId
        if app not in cls._roots:
            cls._roots[app] = cls(spark)
            atexit.register(cls._roots[app]._at_exit)
        return cls._roots[app]

    @property
    def folder(self) -> str:
        return self.files.folder

    @property
    def database(self) -> str:
        if not self._database:
            self.spark.sql(f"CREATE DATABASE {self.name} LOCATION '{self.folder}/database'")
            self._database = True
        return self.name

    def clear(self) -> None:
        if self._database:
            self.spark.sql(f"DROP DATABASE IF EXISTS {self.name} CASCADE")
            self._database = False
        self.files.delete()

    def _at_exit(self) -> None:
        if self.spark.sparkContext._jsc is not None:  # not stopped yet
            self.clear()

    def __enter__(self) -> Scratch:
        self._open.append(self)
        return self

    def __exit__(self, *_) -> None:
        self._open.remove(self)
        self.clear()


def _bucketed(spark: SparkSession, path: str, schema: str, by: str, n: int) -> DataFrame:
    """A written table of buckets, under a name of the open scope."""
    table = f"{Scratch.current(spark).database}.t_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {table} ({schema}) USING parquet CLUSTERED BY (`{by}`) SORTED BY (`{by}`) INTO {n} BUCKETS LOCATION '{path}'")
    out = spark.table(table)
    out._saved_table, out._saved_at = table, path
    return out


def _schema(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def save(df: DataFrame, name: str, measures: dict[str, Column] | None = None, by: str | None = None, path: str | None = None) -> DataFrame:
    """df as a written table: cuts lineage, and lost executors lose nothing. Measures are taken while it is written.

    by: a column by whose hash the table is bucketed, in as many buckets as a shuffle has partitions, so that
    joins and groupings by it need no exchange of this side. The open Scratch owns it, but for its files where a path is given.
    """
    spark = df.sparkSession
    scope = Scratch.current(spark)
    path = path or f"{scope.folder}/{name}-{uuid.uuid4().hex}"
    seen = Observation()
    rows = df.observe(seen, *(c.alias(k) for k, c in measures.items())) if measures else df
    if by:
        table, n = f"{scope.database}.t_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows.repartition(n, by).write.format("parquet").bucketBy(n, by).sortBy(by).option("path", path).saveAsTable(table)
        out = spark.table(table)
        out._saved_table, out._buckets = table, n
    else:
        rows.write.parquet(path)
        out = spark.read.schema(df.schema).parquet(path)
    out._saved_at = path
    out._measures = seen.get if measures else None
    return out


def drop(*tables: DataFrame) -> None:
    """Delete tables made by save(), before their scope would."""
    for df in tables:
        if hasattr(df, "_saved_table"):
            df.sparkSession.sql(f"DROP TABLE IF EXISTS {df._saved_table}")
        if hasattr(df, "_saved_at"):
            Files(df.sparkSession, df._saved_at).delete()


class StepLog:
    """The finished steps of one fixpoint, in a folder that outlives the driver.

    A step's state is written first, then its entry: number, state, measures, columns and buckets. So the
    last entry always names a whole state, wherever a run was cut off; a state without an entry is written again.
    run says what is computed; an entry of something else is refused.
    """

    def __init__(self, spark: SparkSession, folder: str, run: dict):
        self.spark, self.run = spark, json.loads(json.dumps(run))
        self.entries, self.states = Files(spark, f"{folder.rstrip('/')}/steps"), f"{folder.rstrip('/')}/states"

    def last(self, by: str | None) -> tuple[int, DataFrame, dict] | None:
        done = [int(n) for n in self.entries.names() if n.isdigit()]
        if not done:
            return None
        e = json.loads(self.entries.get(str(max(done))))
        if e["run"] != self.run:
            raise ValueError(f"the log is that of another run: {e['run']}, not {self.run}")
        if by:
            state = _bucketed(self.spark, e["state"], e["schema"], by, e["buckets"])
        else:
            state = self.spark.read.schema(e["schema"]).parquet(e["state"])
            state._saved_at = e["state"]
        return e["step"], state, e["measures"]

    def place(self, step: int) -> str:
        return f"{self.states}/{step}-{uuid.uuid4().hex}"

    def add(self, step: int, state: DataFrame, measures: dict) -> None:
        entry = {"step": step, "state": state._saved_at, "measures": measures, "schema": _schema(state), "buckets": getattr(state, "_buckets", None), "run": self.run}
        self.entries.put(str(step), json.dumps(entry))


def iterate(
    state: DataFrame,
    step: Callable[[DataFrame, dict], DataFrame],
    measures: dict[str, Column],
    error: str,
    tolerance: float,
    max_iter: int = 500,
    name: str = "state",
    by: str | None = None,
    log: Callable[[int, float, float], None] | None = None,
    resume: str | None = None,
    run: dict | None = None,
) -> tuple[DataFrame, int]:
    """Repeat step until the measure named error is below tolerance; the last state and the number of steps.

    Each step is one action: the write itself yields the measures, the error and whatever the next step needs.
    The state is bucketed by a column if by names one. log is told each step's number, error and seconds.
    resume: a folder for the states and a log of steps. Where it holds a log of the same run (of the parameters
    in run), the steps after the last one logged are made only. The folder is the caller's to delete.
    """
    if not tolerance > 0:
        raise ValueError("the tolerance must be positive")
    steps = StepLog(state.sparkSession, resume, {"name": name, **(run or {})}) if resume else None
    found = steps.last(by) if steps else None
    if found:
        k, now, seen = found
    else:
        k, now = 0, save(state, name, measures, by, steps.place(0) if steps else None)
        seen = now._measures
        if steps:
            steps.add(0, now, seen)
    while k == 0 or not seen[error] < tolerance:
        if k == max_iter:
            raise RuntimeError(f"no convergence after {max_iter} steps; error {seen[error]}")
        began, k = time.time(), k + 1
        new = save(step(now, seen), name, measures, by, steps.place(k) if steps else None)
        seen = new._measures
        if steps:
            steps.add(k, new, seen)
        drop(now)
        now = new
        if log:
            log(k, seen[error], time.time() - began)
        if seen[error] is None:
            raise ValueError("no score can be compared: are all initial scores null?")
    return now, k
