"""The queries of the citation-impact operators and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import graph as G
from ..functions.fixpoint import Scratch, drop, save
from ..operators import classes as C
from ..operators import rankings as R
from ..operators import topics as T
from ..sources import tsv
from ..sources.schemas import METRICS
from . import fixtures as X

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
PARTS, ORDERS, TOPICS = f"WITH {X.P_SQL}", f"WITH {X.O_SQL}", f"WITH {X.T_SQL}"
DIGITS = 9
NOW_P, NOW_O = 2021, 2001


def query(name: str, sql: str):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        ORACLES[name] = sql
        return f

    return add


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(f"`{c}`"), DIGITS) for c in columns})


def written(df: DataFrame, **options) -> str:
    return tsv.write_tsv(df, f"{Scratch.current(df.sparkSession).folder}/tsv-{uuid.uuid4().hex}", **options)


# ---- Sources and sinks


@query("scan_graph_tsv", f"{PARTS} SELECT paper, pub_year, round(s0, 9) AS initial FROM p_nodes")
def scan_graph_tsv(spark, d):
    lines = tsv.read_graph(spark, written(X.lines(spark, d), header=False), partitions=8)
    return rounded(G.parse(lines, "asis").select("paper", "pub_year", "initial"), "initial")


@query("scan_graph_gzip", f"{PARTS} SELECT src, dst, count(*) AS n FROM p_edges GROUP BY 1, 2")
def scan_graph_gzip(spark, d):
    lines = tsv.read_graph(spark, written(X.lines(spark, d), header=False, gzip=True))
    return G.graph_of(G.parse(lines, "asis")).edges.groupBy("src", "dst").agg(F.count("*").alias("n"))


@query("scan_scores_header", f"{TOPICS} SELECT openaire_id, pid, type, year, pagerank, attrank, cc, \"3y-cc\" FROM scores")
def scan_scores_header(spark, d):
    return tsv.read_scores(spark, written(X.topic_scores(spark, d)))


@query("scan_concepts", f"{TOPICS} SELECT doi, concept, round(confidence, 9) AS confidence FROM concepts")
def scan_concepts(spark, d):
    return rounded(tsv.read_concepts(spark, written(X.topic_concepts(spark, d), header=False)), "confidence")


def _rank_sql(scores: str, metric: str, with_cte: str = PARTS) -> str:
    """Classes of a CTE scores(paper, score)."""
    return f"""{with_cte}, {scores},
n AS (SELECT count(*) AS n FROM scores),
off AS (SELECT greatest(1, CAST(floor(n * 0.0001::DOUBLE) AS BIGINT)) AS a, CASE WHEN floor(n * 0.0001::DOUBLE) <= 1 THEN 1 ELSE greatest(1, CAST(floor(n * 0.001::DOUBLE) AS BIGINT)) END AS b,
  greatest(1, CAST(floor(n * 0.01::DOUBLE) AS BIGINT)) AS c, greatest(1, CAST(floor(n * 0.1::DOUBLE) AS BIGINT)) AS d FROM n),
ranked AS (SELECT paper, score, max(score) OVER () AS m, count(*) OVER (ORDER BY score DESC NULLS LAST RANGE UNBOUNDED PRECEDING) AS cum FROM scores)
SELECT replace(paper, 'comma_char', ',') AS doi, score AS "{metric}", round(CASE WHEN m <> 0 THEN score::DOUBLE / m::DOUBLE END, 9) AS "normalized_{metric}",
CASE WHEN score IS NULL THEN 'C' WHEN cum <= a THEN 'A' WHEN cum <= c THEN 'B' ELSE 'C' END AS three_point_class,
CASE WHEN score IS NULL THEN 'E' WHEN cum <= a THEN 'A' WHEN cum <= b THEN 'B' WHEN cum <= c THEN 'C' WHEN cum <= d THEN 'D' ELSE 'E' END AS five_point_class FROM ranked, off"""


def _count_sql(edges: str, nodes: str) -> str:
    return f"scores AS (SELECT paper, count(src) AS score FROM {nodes} LEFT JOIN {edges} ON dst = paper GROUP BY 1)"


CC_P, CC_O = _count_sql("p_edges", "p_nodes"), _count_sql("o_edges", "o_nodes")


def _ranked(df: DataFrame, metric: str) -> DataFrame:
    return rounded(C.classify(df, metric), f"normalized_{metric}")


@query("sink_rank_tsv", _rank_sql(CC_P, "cc"))
def sink_rank_tsv(spark, d):
    out = C.classify(R.citation_count(X.graph(spark, d)), "cc")
    path = written(out)
    return rounded(tsv._reader(spark, header=True).schema(out.schema).csv(path), "normalized_cc")


def _sunk(df: DataFrame, metric: str) -> DataFrame:
    """Classes of scores written and read again."""
    out = C.classify(df, metric)
    return rounded(tsv._reader(df.sparkSession, header=True).schema(out.schema).csv(written(out)), metric, f"normalized_{metric}")


@query("sink_fwci_gzip", f"{TOPICS} SELECT id, concept, round(fwci, 9) AS fwci, round(\"3y-fwci\", 9) AS \"3y-fwci\" FROM fwci")
def sink_fwci_gzip(spark, d):
    out = T.fwci(_fact(spark, d)).select("id", "concept", "fwci", "3y-fwci")
    path = written(out, header=False, gzip=True, null="")
    return rounded(spark.read.options(sep="\t", quote="", nullValue="").schema(out.schema).csv(path), "fwci", "3y-fwci")


# ---- Parsing


@query("parse_initial_score", f"{PARTS} SELECT paper, round(s0, 9) AS initial FROM p_nodes")
def parse_initial_score(spark, d):
    return rounded(X.lines(spark, d).select("paper", G.initial_score().alias("initial")), "initial")


@query("parse_outlinks", f"{PARTS} SELECT paper, coalesce(string_agg(dst, ',' ORDER BY dst), '0') AS refs, greatest(count(dst), 1) AS n_refs FROM p_nodes LEFT JOIN g_edges ON src = paper GROUP BY 1")
def parse_outlinks(spark, d):
    return G.parse(X.lines(spark, d, "G"), "asis").select("paper", F.array_join("cited", ",").alias("refs"), F.size("cited").cast("long").alias("n_refs"))


@query("decode_ids", f"{PARTS} SELECT paper || ',x' AS doi FROM p_nodes")
def decode_ids(spark, d):
    return X.lines(spark, d).select(F.concat("paper", F.lit("comma_charx")).alias("id")).select(tsv.decode_ids("id").alias("doi"))


@query("citing_nodes", f"{PARTS} SELECT DISTINCT src AS paper FROM p_edges")
def citing_nodes(spark, d):
    return G.citing(G.parse(X.lines(spark, d), "asis")).select("paper")


@query("dangling_nodes", f"{PARTS} SELECT paper FROM p_nodes WHERE paper NOT IN (SELECT src FROM p_edges)")
def dangling_nodes(spark, d):
    return X.graph(spark, d).nodes.where("dangling").select("paper")


@query("graph_stats", f"{PARTS}, {CC_P} SELECT count(*) AS n_nodes, max(score) AS max_score, count(DISTINCT score) AS n_scores FROM scores")
def graph_stats(spark, d):
    return C.histogram(R.citation_count(X.graph(spark, d))).agg(F.sum("n").alias("n_nodes"), F.max("score").alias("max_score"), F.count("score").alias("n_scores"))


@query("year_sanitize", f"{PARTS} SELECT paper, CASE WHEN pub_year < 1000 OR pub_year > {NOW_P} THEN 0 ELSE pub_year END AS year FROM p_nodes")
def year_sanitize(spark, d):
    return X.graph(spark, d).nodes.select("paper", G.sane_year(F.col("pub_year"), NOW_P).alias("year"))


# ---- Citation counts and time-aware counts


@query("citation_count", f"{PARTS}, {CC_P} SELECT * FROM scores")
def citation_count(spark, d):
    return R.citation_count(X.graph(spark, d))


@query("citation_count_orders", f"{ORDERS}, {CC_O} SELECT * FROM scores")
def citation_count_orders(spark, d):
    return R.citation_count(X.graph(spark, d, "O"))


NEAR = "scores AS (SELECT n.paper, count(e.src) FILTER (WHERE s.pub_year - n.pub_year <= 3) AS score FROM {0}_nodes n LEFT JOIN {0}_edges e ON e.dst = n.paper LEFT JOIN {0}_nodes s ON s.paper = e.src GROUP BY 1)"


@query("cc_limited", f"{PARTS}, {NEAR.format('p')} SELECT * FROM scores")
def cc_limited(spark, d):
    return R.citation_count(X.graph(spark, d), 3)


@query("cc_limited_orders", f"{ORDERS}, {NEAR.format('o')} SELECT * FROM scores")
def cc_limited_orders(spark, d):
    return R.citation_count(X.graph(spark, d, "O"), 3)


@query("fill_uncited", f"{PARTS}, {CC_P} SELECT * FROM scores WHERE score = 0")
def fill_uncited(spark, d):
    return R.citation_count(X.graph(spark, d)).where("score = 0")


SANE = f"CASE WHEN s.pub_year < 1000 OR s.pub_year > {NOW_P} THEN 0 ELSE s.pub_year END"


RAM = f"SELECT n.paper, round(coalesce(sum(pow(0.5::DOUBLE, {NOW_P} - {SANE})), 0), 9) AS score FROM p_nodes n LEFT JOIN p_edges e ON e.dst = n.paper LEFT JOIN p_nodes s ON s.paper = e.src GROUP BY 1"


@query("ram", f"{PARTS} {RAM}")
def ram(spark, d):
    return rounded(R.ram(X.graph(spark, d), 0.5, NOW_P), "score")


ECM = f"""WITH RECURSIVE {X.P_SQL},
w AS (SELECT src, dst, sum(0.5::DOUBLE * pow(0.5::DOUBLE, {NOW_P} - {SANE})) AS w FROM p_edges JOIN p_nodes s ON s.paper = src GROUP BY 1, 2),
r AS (SELECT 0 AS it, paper, 1.0::DOUBLE AS r, 1000.0::DOUBLE AS err FROM p_nodes
  UNION ALL SELECT it, paper, r, max(r) OVER () AS err FROM (SELECT max(r.it) OVER () + 1 AS it, n.paper, coalesce(x.s, 0.0) AS r
  FROM p_nodes n LEFT JOIN (SELECT w.dst, sum(w.w * r.r) AS s FROM w JOIN r ON r.paper = w.src GROUP BY 1) x ON x.dst = n.paper CROSS JOIN (SELECT max(it) AS it FROM r WHERE err >= 1e-9) r WHERE r.it IS NOT NULL))
SELECT r.paper, round(sum(CASE WHEN it > 0 THEN r ELSE 0 END), 9) AS score, max(CASE WHEN pub_year < 1000 OR pub_year > {NOW_P} THEN 0 ELSE pub_year END) AS year FROM r JOIN p_nodes USING (paper) GROUP BY 1"""


@query("ecm", ECM)
def ecm(spark, d):
    return rounded(R.ecm(X.graph(spark, d), 0.5, 0.5, NOW_P, 1e-9), "score")


# ---- PageRank and attention-based rank

OUT = "od AS (SELECT src, count(*) AS n_out FROM {e} GROUP BY 1), ew AS (SELECT e.src, e.dst, count(*)::DOUBLE / max(n_out) AS share FROM {e} e JOIN od USING (src) GROUP BY 1, 2)"


def _step(alpha: float, nodes: str, jump: str, scores: str) -> str:
    """Scores (paper, score) after a step over the relation scores."""
    return f"""SELECT n.paper, {alpha}::DOUBLE * (coalesce(x.s, 0.0) + coalesce((SELECT sum(score) FROM {scores} WHERE paper NOT IN (SELECT src FROM od)), 0.0) / (SELECT count(*) FROM {nodes})) + {jump} AS score
  FROM {nodes} n LEFT JOIN (SELECT ew.dst, sum(ew.share * r.score) AS s FROM ew JOIN {scores} r ON r.paper = ew.src GROUP BY 1) x ON x.dst = n.paper"""


def _power_sql(cte: str, edges: str, nodes: str, alpha: float, jump: str, more: str = "", last: str = "SELECT paper, round(score, 9) AS score FROM scores") -> str:
    extra = f", {more}" if more else ""
    named = "v" if more else nodes
    return f"""WITH RECURSIVE {cte}, {OUT.format(e=edges)}{extra},
r AS (SELECT 0 AS it, paper, s0 AS score, 1000.0::DOUBLE AS err FROM {nodes}
  UNION ALL SELECT it, paper, score, max(abs(score - old)) OVER () AS err FROM (SELECT o.it + 1 AS it, y.paper, y.score, o.score AS old
  FROM ({_step(alpha, named, jump, "r")}) y JOIN r o ON o.paper = y.paper WHERE o.err >= 1e-9)),
scores AS (SELECT paper, score FROM r WHERE it = (SELECT max(it) FROM r))
{last}"""


JUMP = "(1 - 0.5::DOUBLE) / (SELECT count(*) FROM {0})"


@query("dangling_mass", f"{PARTS} SELECT round(sum(s0), 9) AS mass FROM p_nodes WHERE paper NOT IN (SELECT src FROM p_edges)")
def dangling_mass(spark, d):
    state = X.graph(spark, d).nodes.select("dangling", F.col("initial").alias("score"))
    return rounded(state.agg(R.dangling_mass(state).alias("mass")), "mass")


@query("pagerank_one_step", f"{PARTS}, {OUT.format(e='g_edges')}, s AS (SELECT paper, s0 AS score FROM p_nodes) SELECT paper, round(score, 9) AS score FROM ({_step(0.5, 'p_nodes', JUMP.format('p_nodes'), 's')})")
def pagerank_one_step(spark, d):
    return rounded(R.pagerank_one_step(X.graph(spark, d, "G"), 0.5), "score")


@query("pagerank", _power_sql(X.P_SQL, "p_edges", "p_nodes", 0.5, JUMP.format("p_nodes")))
def pagerank(spark, d):
    return rounded(R.pagerank(X.graph(spark, d), 0.5, 1e-9), "score")


@query("pagerank_orders", _power_sql(X.O_SQL, "o_edges", "o_nodes", 0.5, JUMP.format("o_nodes")))
def pagerank_orders(spark, d):
    return rounded(R.pagerank(X.graph(spark, d, "O"), 0.5, 1e-9), "score")


@query("pagerank_ghosts", _power_sql(X.P_SQL, "g_edges", "p_nodes", 0.5, JUMP.format("p_nodes")))
def pagerank_ghosts(spark, d):
    return rounded(R.pagerank(X.graph(spark, d, "G"), 0.5, 1e-9), "score")


def _vectors(null_year: str) -> str:
    year = f"CASE WHEN pub_year < 1000 OR pub_year > {NOW_P} THEN 0 ELSE pub_year END"
    year = f"coalesce({year}, 0)" if null_year == "zero" else year
    return f"""y AS (SELECT paper, CASE WHEN pub_year < 1000 OR pub_year > {NOW_P} THEN 0 ELSE pub_year END AS year FROM p_nodes),
age AS (SELECT paper, a / (SELECT sum(exp(-0.16::DOUBLE * ({NOW_P} + 1 - {year}))) FROM p_nodes) AS age FROM (SELECT paper, exp(-0.16::DOUBLE * ({NOW_P} + 1 - {year})) AS a FROM p_nodes)),
rec AS (SELECT dst AS paper, count(*) AS n FROM g_edges JOIN y ON y.paper = src WHERE year >= 2018 GROUP BY 1),
att AS (SELECT paper, n::DOUBLE / (SELECT sum(n) FROM rec) AS attention FROM rec),
v AS (SELECT paper, coalesce(attention, 0.0) AS attention, age FROM age LEFT JOIN att USING (paper))"""


@query("attrank_age_vector", f"{PARTS}, {_vectors('null')} SELECT paper, round(age, 9) AS age FROM age")
def attrank_age_vector(spark, d):
    return rounded(R.age_vector(X.graph(spark, d), -0.16, NOW_P), "age")


@query("attrank_attention", f"{PARTS}, {_vectors('null')} SELECT paper, round(attention, 9) AS attention FROM att")
def attrank_attention(spark, d):
    return rounded(R.attention_vector(X.graph(spark, d, "G"), 2018, NOW_P), "attention")


@query("attrank_vectors", f"{PARTS}, {_vectors('null')} SELECT paper, round(attention, 9) AS attention, round(age, 9) AS age FROM v")
def attrank_vectors(spark, d):
    return rounded(R.attrank_vectors(X.graph(spark, d, "G"), -0.16, NOW_P, 2018), "attention", "age")


ATT_JUMP = "0.5::DOUBLE * n.attention + 0.3::DOUBLE * n.age"


def _attrank(null_year: str):
    def run(spark, d):
        return rounded(R.attrank(X.graph(spark, d, "G"), 0.2, 0.5, 0.3, -0.16, NOW_P, 2018, 1e-9, null_year), "score")

    return run


for _name, _null in (("attrank", "null"), ("attrank_zero_year", "zero")):
    query(_name, _power_sql(X.P_SQL, "g_edges", "p_nodes", 0.2, ATT_JUMP, _vectors(_null)))(_attrank(_null))


# ---- Classes


@query("score_histogram", f"{PARTS}, {CC_P} SELECT score, count(*) AS n FROM scores GROUP BY 1")
def score_histogram(spark, d):
    return C.histogram(R.citation_count(X.graph(spark, d)))


@query("running_count_global", f"{PARTS}, {CC_P} SELECT score, n, CAST(sum(n) OVER (ORDER BY score DESC) AS BIGINT) AS cumulative FROM (SELECT score, count(*) AS n FROM scores GROUP BY 1)")
def running_count_global(spark, d):
    return C.running_count(C.histogram(R.citation_count(X.graph(spark, d))))


def _cuts_sql(cte: str, scores: str) -> str:
    return f"""{_rank_sql(scores, "cc", cte).split("SELECT replace(")[0]}
SELECT max(n) AS n_papers, max(m) AS max_score, min(score) FILTER (WHERE cum <= a) AS top001, min(score) FILTER (WHERE cum <= b) AS top01, min(score) FILTER (WHERE cum <= c) AS top1, min(score) FILTER (WHERE cum <= d) AS top10 FROM ranked, off, n"""


for _name, _which, _cte, _scores in (("global_thresholds", "P", PARTS, CC_P), ("global_thresholds_orders", "O", ORDERS, CC_O)):
    query(_name, _cuts_sql(_cte, _scores))(lambda spark, d, w=_which: C.thresholds(R.citation_count(X.graph(spark, d, w))))


@query("threshold_report", f"SELECT unnest([0.01, 0.1, 1.0, 10.0])::DOUBLE AS percentage, unnest([top001, top01, top1, top10])::DOUBLE AS score FROM ({_cuts_sql(PARTS, CC_P)})")
def threshold_report(spark, d):
    return rounded(C.report(R.citation_count(X.graph(spark, d))), "percentage")


def _only(sql: str, column: str) -> str:
    return f"SELECT doi, {column} FROM ({sql})"


@query("classes_3", _only(_rank_sql(CC_P, "cc"), "cc, three_point_class"))
def classes_3(spark, d):
    return C.classify(R.citation_count(X.graph(spark, d)), "cc").select("doi", "cc", "three_point_class")


@query("classes_5", _only(_rank_sql(CC_P, "cc"), "cc, five_point_class"))
def classes_5(spark, d):
    return C.classify(R.citation_count(X.graph(spark, d)), "cc").select("doi", "cc", "five_point_class")


@query("normalized_scores", _only(_rank_sql(CC_P, "cc"), "normalized_cc"))
def normalized_scores(spark, d):
    return _ranked(R.citation_count(X.graph(spark, d)), "cc").select("doi", "normalized_cc")


@query("cc_classes_orders", _rank_sql(CC_O, "cc", ORDERS))
def cc_classes_orders(spark, d):
    return _ranked(R.citation_count(X.graph(spark, d, "O")), "cc")


_PR = _power_sql(X.P_SQL, "p_edges", "p_nodes", 0.5, JUMP.format("p_nodes"), last="")


@query("pagerank_classes", _rank_sql("scores AS (SELECT paper, round(score, 9) AS score FROM raw)", "pr", _PR.replace("\nscores AS", "\nraw AS").rstrip()))
def pagerank_classes(spark, d):
    return _ranked(rounded(R.pagerank(X.graph(spark, d), 0.5, 1e-9), "score"), "pr")


@query("sink_pagerank_tsv", _rank_sql("scores AS (SELECT paper, round(score, 9) AS score FROM raw)", "pr", _PR.replace("\nscores AS", "\nraw AS").rstrip()))
def sink_pagerank_tsv(spark, d):
    return _sunk(rounded(R.pagerank(X.graph(spark, d), 0.5, 1e-9), "score"), "pr")


_ATT = _power_sql(X.P_SQL, "g_edges", "p_nodes", 0.2, ATT_JUMP, _vectors("null"), last="")


@query("sink_attrank_tsv", _rank_sql("scores AS (SELECT paper, round(score, 9) AS score FROM raw)", "attrank", _ATT.replace("\nscores AS", "\nraw AS").rstrip()))
def sink_attrank_tsv(spark, d):
    return _sunk(rounded(R.attrank(X.graph(spark, d, "G"), 0.2, 0.5, 0.3, -0.16, NOW_P, 2018, 1e-9), "score"), "attrank")


@query("sink_ram_tsv", _rank_sql(f"scores AS ({RAM})", "ram"))
def sink_ram_tsv(spark, d):
    return _sunk(rounded(R.ram(X.graph(spark, d), 0.5, NOW_P), "score"), "ram")


@query("sink_ecm_years_tsv", f"SELECT paper AS doi, score AS ecm, year FROM ({ECM})")
def sink_ecm_years_tsv(spark, d):
    rows = R.ecm(X.graph(spark, d), 0.5, 0.5, NOW_P, 1e-9).select(tsv.decode_ids("paper").alias("doi"), F.col("score").alias("ecm"), "year")
    return rounded(tsv._reader(spark, header=True).schema(rows.schema).csv(written(rows)), "ecm")


# ---- Topics


def _top3(spark, d):
    scores = X.topic_scores(spark, d)
    return T.top_concepts(T.concept_confidence(X.topic_concepts(spark, d), T.bridge(scores)))


def _fact(spark, d):
    """Written once: the queries read it several times."""
    scores = save(X.topic_scores(spark, d), "scores")
    top = T.top_concepts(T.concept_confidence(X.topic_concepts(spark, d), T.bridge(scores)))
    out = save(T.fact(top, T.scores_by_id(scores)), "fact")
    drop(scores)
    return out


@query("scores_by_id", f"{TOPICS} SELECT * FROM by_id")
def scores_by_id(spark, d):
    return T.scores_by_id(X.topic_scores(spark, d))


@query("concept_max_confidence", f"{TOPICS} SELECT openaire_id, concept, round(confidence, 9) AS confidence FROM conf")
def concept_max_confidence(spark, d):
    return rounded(T.concept_confidence(X.topic_concepts(spark, d), T.bridge(X.topic_scores(spark, d))), "confidence")


@query("top3_concepts", f"{TOPICS} SELECT openaire_id, concept, round(confidence, 9) AS confidence FROM top3")
def top3_concepts(spark, d):
    return rounded(_top3(spark, d), "confidence")


@query("topic_concept_map", f"{TOPICS} SELECT openaire_id, concept, round(confidence, 9) AS confidence FROM top3 ORDER BY openaire_id, confidence")
def topic_concept_map(spark, d):
    return rounded(_top3(spark, d), "confidence").orderBy("openaire_id", "confidence")


@query("topic_fact", f"{TOPICS} SELECT * FROM fact")
def topic_fact(spark, d):
    return _fact(spark, d)


@query("expected_citations", f"{TOPICS} SELECT concept, type, year, round(CASE WHEN a > 0 THEN a END, 9) AS expected_cc, round(CASE WHEN b > 0 THEN b END, 9) AS expected_3y FROM expect")
def expected_citations(spark, d):
    return rounded(T.expected(_fact(spark, d)), "expected_cc", "expected_3y")


@query("fwci", f"{TOPICS} SELECT id, concept, round(fwci, 9) AS fwci, round(\"3y-fwci\", 9) AS \"3y-fwci\" FROM fwci")
def fwci(spark, d):
    return rounded(T.fwci(_fact(spark, d)).select("id", "concept", "fwci", "3y-fwci"), "fwci", "3y-fwci")


@query("fwci_by_pid", f"{TOPICS} SELECT pid AS identifier, concept, round(fwci, 9) AS fwci, round(\"3y-fwci\", 9) AS \"3y-fwci\" FROM fwci JOIN scores ON openaire_id = id")
def fwci_by_pid(spark, d):
    rows = T.fwci(_fact(spark, d)).select("id", "concept", "fwci", "3y-fwci")
    return rounded(T.by_pid(rows, T.bridge(X.topic_scores(spark, d))).select("identifier", "concept", "fwci", "3y-fwci"), "fwci", "3y-fwci")


@query("topic_offsets", f"{TOPICS} SELECT * FROM offs")
def topic_offsets(spark, d):
    return T.topic_offsets(_fact(spark, d))


@query("running_count_by_concept", f"{TOPICS} SELECT * FROM run")
def running_count_by_concept(spark, d):
    return T.running_count_by_concept(_fact(spark, d))


_CUTS = ", ".join(f"min(value) FILTER (WHERE metric = '{m}' AND cumulative <= {k}_offset) AS \"{m}_{k}\"" for m in METRICS for k, _ in C.TOPS)
_TOPIC_CUTS = f"{TOPICS}, cuts AS (SELECT concept, {_CUTS} FROM run JOIN offs USING (concept) GROUP BY 1)"


@query("topic_thresholds", f"{_TOPIC_CUTS} SELECT * FROM cuts")
def topic_thresholds(spark, d):
    return T.topic_thresholds(_fact(spark, d))


@query("merge_thresholds_outer", f"{_TOPIC_CUTS} SELECT concept, \"cc_top10\", \"3y-cc_top10\" FROM cuts")
def merge_thresholds_outer(spark, d):
    return T.topic_thresholds(_fact(spark, d)).select("concept", "cc_top10", "3y-cc_top10")


@query("topic_threshold_report", f"{_TOPIC_CUTS} SELECT DISTINCT * FROM cuts ORDER BY concept")
def topic_threshold_report(spark, d):
    return T.topic_thresholds(_fact(spark, d)).distinct().orderBy("concept")


_LABELS = ", ".join("CASE " + " ".join(f"WHEN \"{m}\" >= \"{m}_{k}\" THEN '{c}'" for c, (k, _) in zip(T.LABELS, C.TOPS, strict=False)) + f" ELSE 'C5' END AS \"{m}_class\"" for m in METRICS)


@query("topic_classes", f"{_TOPIC_CUTS} SELECT fact.id, fact.concept, {_LABELS} FROM fact LEFT JOIN cuts USING (concept)")
def topic_classes(spark, d):
    f = _fact(spark, d)
    return T.topic_classes(f, T.topic_thresholds(f)).select("id", "concept", *(f"{m}_class" for m in METRICS))


@query("topic_classes_by_pid", f"{_TOPIC_CUTS}, lab AS (SELECT fact.id, fact.concept, {_LABELS} FROM fact LEFT JOIN cuts USING (concept)) SELECT pid AS identifier, concept, pagerank_class, attrank_class, \"3y-cc_class\", cc_class FROM lab JOIN scores ON openaire_id = id")
def topic_classes_by_pid(spark, d):
    f = _fact(spark, d)
    labelled = T.topic_classes(f, T.topic_thresholds(f)).select("id", "concept", *(f"{m}_class" for m in METRICS))
    return T.by_pid(labelled, T.bridge(X.topic_scores(spark, d)))
