"""Fingerprints and likenesses of the query, against sets made word by word."""

import pytest
import regex
from pyspark.sql import functions as F

from impactory.llm import spot_signatures
from impactory.llm.common import load

SF = "/root/testdata/sf0.001"


def signatures(text):
    """The set of signatures as tuples of words."""
    plain = regex.sub(r"[^\p{L}\p{N}]+", " ", text.lower()).strip(" ")
    units = [("", [])]
    for word in plain.split(" ") if plain else []:
        if word in spot_signatures.ANCHORS:
            units[-1][1].append(word)
        else:
            units.append((word, []))
    found = set()
    for i, (word, anchors) in enumerate(units):
        lo = max(i - spot_signatures.STRETCH, 0)
        bare = not any(a for _, a in units[lo : lo + spot_signatures.STRETCH + 1])
        if i + spot_signatures.CHAIN < len(units) and (anchors or bare):
            found.add((*(anchors or [("content", word)]), "then", *(w for w, _ in units[i + 1 : i + 1 + spot_signatures.CHAIN])))
    return frozenset(found or {("whole", plain)})


def jaccard(a, b):
    return len(a & b) / len(a | b)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The test table with awkward texts behind it, as a table of its own."""
    odd = ["", "The", "the of and", "one two three", "Ärger über die Straße, im Haus!", "x " * 30, "a b c d e f g h i j k l m n o p", "... !!", "the cat\nsat on THE mat the-end of it", None]
    where = str(tmp_path_factory.mktemp("spots"))
    rows = spark.createDataFrame([(10**6 + k, t) for k, t in enumerate(odd)], "doc_id long, text string")
    load(spark, SF, "documents").select("doc_id", "text").union(rows).repartition(4).write.parquet(f"{where}/documents.parquet")
    return where


def test_query_against_sets_of_words(spark, tables):
    texts = {r["doc_id"]: r["text"] or "" for r in load(spark, tables, "documents").collect()}
    rows = {r["doc_id"]: r for r in spot_signatures.op9_spot_signatures(spark, tables).collect()}
    order = sorted(texts)
    assert sorted(rows) == order
    of_set = {}
    for i, k in enumerate(order):
        text, after = texts[k], texts[order[(i + 1) % len(order)]]
        quarter = len(text) // 4
        mine, edited, other = signatures(text), signatures(text[: len(text) - quarter] + after[:quarter]), signatures(after)
        assert rows[k]["near_edited"] == pytest.approx(jaccard(mine, edited)), k
        assert rows[k]["near_next"] == pytest.approx(jaccard(mine, other)), k
        for column, s in (("fingerprint", mine), ("edited_fingerprint", edited)):
            assert rows[k][column].split("-")[0] == str(len(s))
            assert of_set.setdefault(s, rows[k][column]) == rows[k][column]
    assert len(set(of_set.values())) == len(of_set)


def test_join_of_sets_against_all_pairs(spark, tables):
    """Length partitions and pruned candidates at the threshold lose no pair."""
    docs = load(spark, tables, "documents")
    base = docs.where("length(text) > 200")
    near = base.select((F.col("doc_id") + 5 * 10**6).alias("doc_id"), F.expr("concat(substring(text, 1, length(text) - 20), ' of another end here')").alias("text"))
    rows = docs.union(near).collect()
    named = {}
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        named.setdefault(signatures(r["text"] or ""), r["doc_id"])
    members, links = spot_signatures.near_duplicates(docs.union(near))
    sets = sorted((v, k) for k, v in named.items())
    want = {(a, b): jaccard(x, y) for i, (a, x) in enumerate(sets) for b, y in sets[i + 1 :] if jaccard(x, y) >= spot_signatures.THRESHOLD}
    got = {(r["a"], r["b"]): r["likeness"] for r in links.collect()}
    assert want and got == pytest.approx(want)
    assert {r["doc_id"]: r["class_id"] for r in members.collect()} == {r["doc_id"]: named[signatures(r["text"] or "")] for r in rows}
