"""SpotSigs fingerprints: chains of content words that follow common words.

A text is reduced to its words in lower case. Each common word (ANCHORS) starts a signature: the run of
common words at that place and the next CHAIN content words, other common words between them skipped.
In a stretch of content words without any common word (lists, other languages) each word starts one.
A document's fingerprint is its set of signatures; a text without any has its whole word sequence as the
only one. The written fingerprint is the set's size and a 64-bit digest, equal for equal sets. The
likeness of two sets is their Jaccard similarity.

near_duplicates() is the self-join: equal sets are one entry, sets are partitioned by length so that
only neighbouring partitions can hold partners, candidates come from the rarest signatures of each set
(enough of them that no pair at the threshold is missed), and are verified exactly.

Everything is built-in DataFrame functions.

Rows: a null text is empty; very long texts are read whole; a null id sorts before all others; rows with one id sort by the text's hash;
repeated rows are each other's next document; a single row is its own; an empty table gives no rows.
Only doc_id and text are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import load

#: Common words of English, German, French and Spanish.
ANCHORS = (
    "the of and to in a is that it for on was be as with by are at this from "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine "
    "le de la et les un du une que est pour qui dans par pas au sur "
    "el y los se del las por con una su"
).split()
CHAIN = 2
#: After so many content words without a common one, each word starts a signature.
STRETCH = 6
THRESHOLD = 0.8
BUCKETS_PER_PARTITION = 4


def _anchor_pattern() -> str:
    """The common words grouped by their first letter, so that most words fail at once."""
    by: dict[str, list[str]] = {}
    for w in sorted(set(ANCHORS)):
        by.setdefault(w[0], []).append(w[1:])
    return " ((?:" + "|".join(f"{c}(?:{'|'.join(sorted(rest, key=len, reverse=True))})" for c, rest in by.items()) + "))(?= )"


def add_signatures(df: DataFrame, text: str, into: str) -> DataFrame:
    """df with the sorted distinct signatures of a text column, as an array of longs."""
    words, units = f"__{into}_words", f"__{into}_units"
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    df = df.withColumn(words, plain)
    marked = F.regexp_replace(F.concat(F.lit(" "), F.col(words), F.lit(" ")), _anchor_pattern(), "\t$1")
    df = df.withColumn(units, F.split(F.rtrim(marked), " "))
    u = F.col(units)

    def content(i: Column) -> Column:
        return F.substring_index(F.get(u, i), "\t", 1)

    def signature(i: Column) -> Column:
        anchors = F.substring(F.get(u, i), F.instr(F.get(u, i), "\t"), F.length(F.get(u, i)))
        return F.xxhash64(anchors, *(content(i + k) for k in range(1, CHAIN + 1)))

    def spot(i: Column) -> Column:
        marked_near = F.exists(F.slice(u, F.greatest(i - STRETCH, F.lit(0)) + 1, F.lit(STRETCH + 1)), lambda x: F.contains(x, F.lit("\t")))
        return (i + CHAIN < F.size(u)) & (F.contains(F.get(u, i), F.lit("\t")) | ~marked_near)

    starts = F.filter(F.sequence(F.lit(0), F.greatest(F.size(u) - CHAIN - 1, F.lit(0))), spot)
    found = F.transform(starts, signature)
    df = df.withColumn(into, F.sort_array(F.array_distinct(found)))
    df = df.withColumn(into, F.when(F.size(into) > 0, F.col(into)).otherwise(F.array(F.xxhash64(words))))
    return df.drop(words, units)


def fingerprint(signatures: str) -> Column:
    return F.concat_ws("-", F.size(signatures).cast("string"), F.lower(F.hex(F.xxhash64(signatures))))


def likeness(a: str, b: str) -> Column:
    """Jaccard similarity of two sets of signatures."""
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text), no null text, each with its signatures and the next row's text and signatures.

    Rows are dealt by ranges of the id, bounded by quantiles; the first row of each range is sent to the
    range before as well (the first of all to the last), so that no window crosses ranges.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = parts * BUCKETS_PER_PARTITION
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    rows = docs.withColumn("key", key).withColumn("tie", F.xxhash64("text"))
    bounds = docs.select(F.percentile_approx(key, F.array(*(F.lit(i / n) for i in range(1, n))), F.lit(100 * n)).alias("q")).first()["q"] or []
    bounds = sorted(set(bounds))  # at most n numbers
    limits = F.array(*(F.lit(b).cast("long") for b in bounds)) if bounds else F.array().cast("array<bigint>")
    rows = rows.withColumn("bucket", F.size(F.filter(limits, lambda b: b < F.col("key"))))
    firsts = sorted((r["bucket"], r["f"]["key"], r["f"]["tie"]) for r in rows.groupBy("bucket").agg(F.min(F.struct("key", "tie")).alias("f")).collect())  # at most n rows of numbers
    heads = spark.createDataFrame([(key_, tie, firsts[i - 1][0]) for i, (_, key_, tie) in enumerate(firsts)], "key long, tie long, before int")
    guests = rows.join(F.broadcast(heads), ["key", "tie"]).dropDuplicates(["key", "tie", "before"]).select("doc_id", "text", "key", "tie", F.col("before").alias("bucket"), F.lit(1).alias("guest"))
    dealt = rows.select("doc_id", "text", "key", "tie", "bucket", F.lit(0).alias("guest")).union(guests).repartition(parts, "bucket")
    signed = add_signatures(dealt, "text", "signatures")
    by = Window.partitionBy("bucket").orderBy("guest", "key", "tie")
    ahead = F.lead(F.struct(F.col("text").alias("text"), F.col("signatures").alias("signatures"))).over(by)
    return signed.withColumn("next", ahead).where("guest = 0").select("doc_id", "text", "signatures", F.col("next.text").alias("next_text"), F.col("next.signatures").alias("next_signatures"))


def op9_spot_signatures(spark, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and the likenesses."""
    docs = load(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(docs)
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - quarter), F.substring("next_text", F.lit(1), quarter))
    rows = add_signatures(rows.withColumn("edited", edited), "edited", "edited_signatures")
    return rows.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint("signatures").alias("fingerprint"),
        fingerprint("edited_signatures").alias("edited_fingerprint"),
        likeness("signatures", "edited_signatures").alias("near_edited"),
        likeness("signatures", "next_signatures").alias("near_next"),
    )


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Members (doc_id, class_id) and links (a, b, likeness) between class ids, at the threshold or above.

    A class is the documents with equal sets, named by the smallest id.
    """
    signed = add_signatures(docs.select("doc_id", "text"), "text", "s").select("doc_id", "s")
    members = signed.select("doc_id", F.xxhash64("s").alias("digest"))
    named = members.groupBy("digest").agg(F.min("doc_id").alias("class_id"))
    sets = signed.select("s", F.xxhash64("s").alias("digest")).dropDuplicates(["digest"]).join(named, "digest").select(F.col("class_id").alias("id"), "s", F.size("s").alias("n"))
    each = sets.select("id", "n", F.explode("s").alias("g"))
    rarity = each.groupBy("g").agg(F.count("*").alias("df"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy("df", "g"))
    least = each.join(rarity, "g").withColumn("r", rank).where(F.col("r") <= F.col("n") - F.ceil(F.col("n") * threshold) + 1)
    length = F.floor(F.log(F.col("n").cast("double")) / math.log(1 / threshold) + 1e-9) if threshold < 1 else F.col("n")
    keyed = least.where("df > 1").select("id", "n", "g", length.cast("int").alias("part"))
    right = keyed.select(F.col("id").alias("b"), F.col("n").alias("m"), "g", F.explode(F.array(F.col("part"), F.col("part") - 1, F.col("part") + 1)).alias("part"))
    close = (F.col("a") < F.col("b")) & (F.least("n", "m") >= threshold * F.greatest("n", "m"))
    pairs = keyed.withColumnRenamed("id", "a").join(right, ["part", "g"]).where(close).select("a", "b").distinct()
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("s").alias("x")), "a").join(sets.select(F.col("id").alias("b"), F.col("s").alias("y")), "b")
    links = both.select("a", "b", likeness("x", "y").alias("likeness")).where(F.col("likeness") >= threshold)
    return members.join(named, "digest").select("doc_id", "class_id"), links
