"""Citation graphs and topic tables derived from the driver's tables, in Spark and in SQL.

P: parts; in each order the part with the largest key cites the others. O: orders; of each part, every
order cites the one before it. T: scores and concepts of the orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.graph import CitationGraph, graph_of, parse
from ..operators.rankings import citation_count


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def part_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    year = F.when(k % 97 == 0, F.lit(None)).when(k % 89 == 0, 3000).when(k % 83 == 0, 12).otherwise(1950 + k % 72)
    part = table(spark, sf_dir, "part")
    n = part.agg(F.count("*").alias("n_nodes"))
    return part.select(F.concat(F.lit("p"), k).alias("paper"), year.cast("int").alias("pub_year")).join(F.broadcast(n)).select("paper", "pub_year", (1.0 / F.col("n_nodes")).alias("s0"))  # n is one row


def part_edges(spark: SparkSession, sf_dir: str, ghosts: bool = False) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey").distinct()
    top = lines.groupBy("l_orderkey").agg(F.max("l_partkey").alias("m"))
    pairs = lines.join(top, "l_orderkey").where("l_partkey < m")
    edges = pairs.select(F.concat(F.lit("p"), "m").alias("src"), F.concat(F.lit("p"), "l_partkey").alias("dst"))
    if ghosts:
        own = pairs.where("m % 50 = 0").select("m").distinct()
        edges = edges.union(own.select(F.concat(F.lit("p"), "m"), F.concat(F.lit("ghost"), "m")))
    return edges


def order_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    n = orders.agg(F.count("*").alias("n_nodes"))
    rows = orders.select(F.concat(F.lit("o"), "o_orderkey").alias("paper"), F.year("o_orderdate").alias("pub_year"))
    return rows.join(F.broadcast(n)).select("paper", "pub_year", (1.0 / F.col("n_nodes")).alias("s0"))  # n is one row


def order_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    dated = lines.join(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey")
    before = F.lag("l_orderkey").over(Window.partitionBy("l_partkey").orderBy("o_orderdate", "l_orderkey"))
    pairs = dated.withColumn("before", before).where("before is not null and before <> l_orderkey")
    return pairs.select(F.concat(F.lit("o"), "l_orderkey").alias("src"), F.concat(F.lit("o"), "before").alias("dst"))


def packed(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Lines of a graph file."""
    lists = edges.groupBy("src").agg(F.concat_ws(",", F.array_sort(F.collect_list("dst"))).alias("refs"), F.count("*").alias("n"))
    refs, n = F.coalesce("refs", F.lit("0")), F.coalesce("n", F.lit(0)).cast("string")
    data = F.concat_ws("|", refs, n, F.col("s0").cast("string"))
    joined = nodes.join(lists, F.col("paper") == F.col("src"), "left")
    return joined.select("paper", data.alias("citation_data"), F.lit(0.0).cast("float").alias("prev_score"), "pub_year")


def lines(spark: SparkSession, sf_dir: str, which: str = "P") -> DataFrame:
    if which == "O":
        return packed(order_nodes(spark, sf_dir), order_edges(spark, sf_dir))
    return packed(part_nodes(spark, sf_dir), part_edges(spark, sf_dir, which == "G"))


def graph(spark: SparkSession, sf_dir: str, which: str = "P") -> CitationGraph:
    """P, P with references outside the graph (G), or O."""
    return graph_of(parse(lines(spark, sf_dir, which), "asis"))


def topic_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = graph(spark, sf_dir, "O")
    cc, near = citation_count(g), citation_count(g, 3)
    counts = cc.withColumnRenamed("score", "cc").join(near.withColumnRenamed("score", "near"), "paper")
    k, price = F.col("o_orderkey"), F.col("o_totalprice").cast("double")
    pids = F.array_compact(F.array(F.concat(F.lit("doi:"), k), F.when(k % 10 == 0, F.concat(F.lit("doi2:"), k))))
    rows = table(spark, sf_dir, "orders").withColumn("paper", F.concat(F.lit("o"), k)).join(counts, "paper")
    return rows.select(
        F.col("paper").alias("openaire_id"),
        F.explode(pids).alias("pid"),
        F.when(k % 103 != 0, F.col("o_orderpriority")).alias("type"),
        F.year("o_orderdate").cast("string").alias("year"),
        F.when(k % 101 != 0, price).alias("pagerank"),
        (price * (1 + F.col("o_custkey") % 7)).alias("attrank"),
        F.col("cc").cast("double").alias("cc"),
        F.col("near").cast("double").alias("3y-cc"),
    )


def topic_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", F.col("l_extendedprice").cast("double").alias("price")).join(part, "l_partkey")
    best = items.groupBy("l_orderkey", F.col("p_brand").alias("concept")).agg((F.max("price") / 1e6).alias("confidence"))
    k = F.col("l_orderkey")
    dois = F.array_compact(F.array(F.concat(F.lit("doi:"), k), F.when(k % 10 == 0, F.concat(F.lit("doi2:"), k)), F.when(k % 500 == 0, F.concat(F.lit("doix:"), k))))
    return best.select(F.explode(dois).alias("doi"), "concept", "confidence")


# The same in SQL.
P_SQL = """p_nodes AS (SELECT 'p' || p_partkey AS paper, CAST(CASE WHEN p_partkey % 97 = 0 THEN NULL WHEN p_partkey % 89 = 0 THEN 3000
  WHEN p_partkey % 83 = 0 THEN 12 ELSE 1950 + p_partkey % 72 END AS INTEGER) AS pub_year, 1.0::DOUBLE / (SELECT count(*) FROM part) AS s0 FROM part),
p_d AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem),
p_pairs AS (SELECT m, l_partkey FROM p_d JOIN (SELECT l_orderkey, max(l_partkey) AS m FROM p_d GROUP BY 1) USING (l_orderkey) WHERE l_partkey < m),
p_edges AS (SELECT 'p' || m AS src, 'p' || l_partkey AS dst FROM p_pairs),
g_edges AS (SELECT * FROM p_edges UNION ALL SELECT DISTINCT 'p' || m, 'ghost' || m FROM p_pairs WHERE m % 50 = 0)"""
O_SQL = """o_nodes AS (SELECT 'o' || o_orderkey AS paper, CAST(year(o_orderdate) AS INTEGER) AS pub_year, 1.0::DOUBLE / (SELECT count(*) FROM orders) AS s0 FROM orders),
o_lag AS (SELECT l_orderkey AS k, lag(l_orderkey) OVER (PARTITION BY l_partkey ORDER BY o_orderdate, l_orderkey) AS b FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
o_edges AS (SELECT 'o' || k AS src, 'o' || b AS dst FROM o_lag WHERE b IS NOT NULL AND b <> k),
o_cc AS (SELECT n.paper, count(e.src) AS cc, count(e.src) FILTER (WHERE s.pub_year - n.pub_year <= 3) AS near
  FROM o_nodes n LEFT JOIN o_edges e ON e.dst = n.paper LEFT JOIN o_nodes s ON s.paper = e.src GROUP BY 1)"""
T_SQL = O_SQL + """,
k12 AS (SELECT * FROM (VALUES ('doi:', 1), ('doi2:', 10), ('doix:', 500)) v(prefix, every)),
scores AS (SELECT 'o' || o_orderkey AS openaire_id, prefix || o_orderkey AS pid, CASE WHEN o_orderkey % 103 <> 0 THEN o_orderpriority END AS type,
  CAST(year(o_orderdate) AS VARCHAR) AS year, CASE WHEN o_orderkey % 101 <> 0 THEN o_totalprice::DOUBLE END AS pagerank,
  o_totalprice::DOUBLE * (1 + o_custkey % 7) AS attrank, cc::DOUBLE AS cc, near::DOUBLE AS "3y-cc"
  FROM orders JOIN o_cc ON paper = 'o' || o_orderkey JOIN k12 ON o_orderkey % every = 0 AND prefix <> 'doix:'),
concepts AS (SELECT prefix || l_orderkey AS doi, concept, confidence FROM (SELECT l_orderkey, p_brand AS concept, max(l_extendedprice::DOUBLE) / 1e6::DOUBLE AS confidence
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2) JOIN k12 ON l_orderkey % every = 0),
by_id AS (SELECT openaire_id, max(pagerank) AS pagerank, max(attrank) AS attrank, max("3y-cc") AS "3y-cc", max(cc) AS cc, min(type) AS type, min(year) AS year FROM scores GROUP BY 1),
conf AS (SELECT openaire_id, concept, max(confidence) AS confidence FROM concepts JOIN scores ON doi = pid GROUP BY 1, 2),
top3 AS (SELECT openaire_id, concept, confidence FROM conf QUALIFY row_number() OVER (PARTITION BY openaire_id ORDER BY confidence DESC NULLS LAST, concept) <= 3),
fact AS (SELECT openaire_id AS id, concept, pagerank, attrank, "3y-cc", cc, type, year FROM top3 JOIN by_id USING (openaire_id)),
expect AS (SELECT concept, type, year, avg(cc) AS a, avg("3y-cc") AS b FROM fact GROUP BY 1, 2, 3),
fwci AS (SELECT f.*, CASE WHEN a > 0 THEN cc / a END AS fwci, CASE WHEN b > 0 THEN "3y-cc" / b END AS "3y-fwci"
  FROM fact f LEFT JOIN expect e ON f.concept = e.concept AND f.type = e.type AND f.year = e.year),
offs AS (SELECT concept, n, greatest(1, CAST(floor(n * 0.0001::DOUBLE) AS BIGINT)) AS top001_offset, greatest(1, CAST(floor(n * 0.001::DOUBLE) AS BIGINT)) AS top01_offset,
  greatest(1, CAST(floor(n * 0.01::DOUBLE) AS BIGINT)) AS top1_offset, greatest(1, CAST(floor(n * 0.1::DOUBLE) AS BIGINT)) AS top10_offset
  FROM (SELECT concept, count(*) AS n FROM fact GROUP BY 1)),
hist AS (SELECT concept, metric, value, count(*) AS n FROM (SELECT concept, unnest(['pagerank', 'attrank', '3y-cc', 'cc']) AS metric, unnest([pagerank, attrank, "3y-cc", cc]) AS value FROM fact) GROUP BY 1, 2, 3),
run AS (SELECT *, CAST(sum(n) OVER (PARTITION BY concept, metric ORDER BY value DESC NULLS LAST ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative FROM hist)"""
