"""Exact deduplication by recipes of content-defined chunks.

A text is cut into words, and a chunk begins where the hash of two neighbouring words hits a pattern: equal
passages are cut alike wherever they stand. A chunk's
identifier is made of 64-bit hashes with different seeds. Identifiers are verified before they count for
anything: all distinct chunks of the table meet once by their content, and if two of them have the same
identifier, the scheme is dropped and one with another hash is tried. So equal recipes, which are what stands
between chunks and the ordered list of identifiers, are equal texts, with certainty. Texts themselves never move: each distinct chunk moves
once per task that holds it, and documents are compared by their recipes, sixteen bytes for each chunk.

Repeated rows meet by recipe and id, so that a group of copies is spread over its ids before it is
counted; what is known of a group then goes back to its rows through a join of two plain tables, whose
large partitions Spark splits.

DataFrame functions only. Both passes compute chunks from the text alone, so a lost executor changes
nothing; recipes and groups are written to the shared folder.

Rows: a null text counts as empty, and empty texts are equal to each other; very long texts have long
recipes, and texts without blanks are cut into words of LONGEST characters; of equal texts the row with the largest
id stays, a null id only where no row has one; where rows repeat that id too, exactly one of them is kept;
an empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, load, materialize

#: A chunk begins at one of so many words, about, has so many words at least and at most, and words so many characters.
EVERY, LEAST, MOST, LONGEST = 128, 32, 1024, 512
#: Hashes in an identifier at first.
HASHES = 2


def text_column() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def chunked(docs: DataFrame, *kept: Column) -> DataFrame:
    """The kept columns, the text's chunks in order, and what stands between them: a blank, or nothing where words are long.

    Words are what lies between blanks; where they have over LONGEST bytes on average, as in texts without blanks, they end
    at line ends and after LONGEST characters too.
    """
    names = docs.select(*kept).columns
    text = docs.select(*kept, text_column().alias("t")).withColumn("w", F.split("t", " "))
    text = text.withColumn("between", F.when(F.octet_length("t") > LONGEST * F.size("w"), "").otherwise(" "))
    words = text.select(*names, "between", F.when(F.col("between") == " ", F.col("w")).otherwise(F.split("t", rf"(?<=[ \n])|(?<=\G\S{{{LONGEST}}})")).alias("w"))
    hits = F.expr(f"filter(sequence(0, size(w) - 1), i -> i > 0 and pmod(xxhash64(get(w, i - 1), get(w, i)), {EVERY}) = 0)")
    hit = words.withColumn("hits", hits)
    spaced = hit.withColumn("starts", F.expr(f"concat(array(0), filter(hits, (x, k) -> x - coalesce(get(hits, k - 1), 0) >= {LEAST}))"))
    capped = spaced.withColumn("starts", F.expr(f"flatten(transform(starts, (x, k) -> sequence(x, coalesce(get(starts, k + 1), size(w)) - 1, {MOST})))"))
    pieces = F.expr("transform(starts, (x, k) -> array_join(slice(w, x + 1, coalesce(get(starts, k + 1), size(w)) - x), between))")
    return capped.select(*names, pieces.alias("chunks"), "between")


def identifier(chunk: Column, hashes: int, bits: int) -> list[Column]:
    """A chunk's identifier: hashes with different seeds, the first of so many bits only."""
    first = F.xxhash64(chunk)
    return [F.pmod(first, F.lit(2**bits)) if bits < 63 else first, *(F.xxhash64(F.lit(k), chunk) for k in range(1, hashes))]


def clashes(docs: DataFrame, hashes: int, bits: int = 64) -> int:
    """How many identifiers stand for more than one chunk of the table."""
    # A text has a chunk at least. An inner explode would add a filter on them, and push it below all that makes chunks.
    distinct = chunked(docs).select(F.explode_outer("chunks").alias("chunk")).distinct()
    named = distinct.select(*(c.alias(f"h{k}") for k, c in enumerate(identifier(F.col("chunk"), hashes, bits))))
    return named.groupBy(*named.columns).count().where("count > 1").count()


def recipes(docs: DataFrame, hashes: int = HASHES, bits: int = 64) -> DataFrame:
    """(doc_id, text_sha256, recipe), written: recipes are equal where the texts are. Fewer bits make clashes, for tests."""
    while clashes(docs, hashes, bits):
        hashes, bits = hashes + 1, 64
    own = (F.col("doc_id").cast("long").alias("doc_id"), F.sha2(text_column().cast("binary"), 256).alias("text_sha256"))
    ids = F.flatten(F.transform("chunks", lambda c: F.array(*identifier(c, hashes, bits))))
    between = F.array(F.length("between").cast("long"))
    return materialize(chunked(docs, *own).select("doc_id", "text_sha256", F.concat(between, ids).alias("recipe")), "recipes")


def exact_groups(docs: DataFrame, hashes: int = HASHES, bits: int = 64) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), a row for each row of docs."""
    written = recipes(docs, hashes, bits)
    rows = materialize(written.groupBy("recipe", "doc_id", "text_sha256").agg(F.count("*").alias("times")), "recipe-rows")
    groups = materialize(rows.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.sum("times").alias("group_size")), "recipe-groups")
    discard(written)
    each = rows.join(groups, "recipe").withColumn("again", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("again") == 1)
    return each.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def op13_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document with the one that stays of its equals."""
    return exact_groups(load(spark, sf_dir, "documents"))


ORACLE = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
