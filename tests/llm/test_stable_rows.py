"""Results that don't depend on how passes divide a table among tasks, or in which order files are read."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from impactory.llm import chroma, pitman_yor, simhash
from impactory.llm.common import load, materialize

SF = "/root/testdata/sf0.001"
NAME = "spark.sql.leafNodeDefaultParallelism"


@pytest.fixture
def parallelism(spark):
    """A function that sets into how many tasks files are divided, as executors that come or go do."""
    yield lambda n: spark.conf.set(NAME, str(n))
    spark.conf.unset(NAME)
    spark.conf.unset("spark.sql.files.minPartitionNum")


def test_near_duplicates_when_tasks_change_between_passes(spark, tmp_path, monkeypatch, parallelism):
    rng = np.random.default_rng(3)
    texts = [" ".join(map(str, rng.integers(0, 10_000, 60))) for _ in range(200)]
    rows = spark.createDataFrame([(i, texts[i % 200]) for i in range(400)], "doc_id long, text string").repartition(9)
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    parallelism(4)
    plain = simhash.similar

    def then_more(docs):
        out = plain(docs)
        parallelism(16)
        return out

    monkeypatch.setattr(simhash, "similar", then_more)
    kept = simhash.keep_one(spark, load(spark, str(tmp_path), "documents"), "").collect()
    assert sorted(r["text"] for r in kept) == sorted(texts)


def test_language_model_when_tasks_change_between_passes(spark, tmp_path, monkeypatch, parallelism):
    load(spark, SF, "documents").repartition(9).write.parquet(f"{tmp_path}/documents.parquet")
    parallelism(4)
    docs = load(spark, str(tmp_path), "documents")
    assert len({docs.rdd.getNumPartitions(), (parallelism(16), load(spark, str(tmp_path), "documents").rdd.getNumPartitions())[1]}) == 2
    parallelism(4)
    want = sorted(map(tuple, pitman_yor.score(docs).collect()))
    spark.conf.unset("spark.sql.files.minPartitionNum")
    plain = pitman_yor.ask_words

    def then_more(n):
        parallelism(16)
        return plain(n)

    monkeypatch.setattr(pitman_yor, "ask_words", then_more)
    got = sorted(map(tuple, pitman_yor.score(docs).collect()))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want])


def test_classes_of_recordings_in_any_order_of_reading(spark):
    """Copies in one task, the last of them read first: their class still meets the query."""
    rng = np.random.default_rng(4)
    passage = " ".join(map(str, rng.integers(0, 10_000, 400)))
    rows = [(1, passage), (2, passage), (3, passage), (100, "before " * 9 + passage)]
    prints = materialize(chroma.fingerprints(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)), "prints")
    first, query = (prints.where(F.col("doc_id") == i).first()["row"] for i in (1, 100))
    asking = prints.where("doc_id = 100")
    for order in (F.col("row").asc(), F.col("row").desc()):
        read = prints.coalesce(1).sortWithinPartitions(order)
        assert (first, query) in {tuple(r) for r in chroma.candidates(read, asking).collect()}


def test_alignments_of_copies_in_many_files(spark, tmp_path):
    """Files of falling size, so that they are read in another order than that of their rows."""
    rng = np.random.default_rng(5)
    passage = " ".join(map(str, rng.integers(0, 10_000, 300)))
    for k, (doc_id, text) in enumerate([(1, passage), (2, passage), (500, "other " * 7 + passage), (3, passage)]):
        filler = [(1000 + 10 * k + i, "x" * 10) for i in range(1, 5)]
        spark.createDataFrame([(doc_id, text), *filler], "doc_id long, text string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/documents.parquet")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        got = {r["doc_id"]: r for r in chroma.align(load(spark, str(tmp_path), "documents")).where("doc_id < 1000").collect()}
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert [got[i]["query_id"] for i in (1, 2, 3, 500)] == [500, 500, 500, None] and got[1]["votes"] > 0


def test_blocks_of_rows_against_all_pairs():
    """Links between components as a plain loop finds them, where few pairs may be similar and where many may."""
    import pyarrow as pa

    rng = np.random.default_rng(6)
    for own in (30, 2):
        common = rng.integers(0, 2**63, 120, dtype=np.uint64)
        sets = [np.unique(np.concatenate([common, rng.integers(0, 2**63, own if k % 5 else 3, dtype=np.uint64)])) for k in range(80)]
        asks = np.arange(80) % 2 == 0
        table = pa.table({"asks": asks, "row": np.arange(80), "root": np.arange(80) % 70, "common": np.full(80, 120), "value": [x.tobytes() for x in sets]})
        got = {frozenset((r["u"], r["v"])) for r in simhash.compared(table).to_pylist()}
        want = {frozenset((i, j)) for i in range(80) for j in range(80) if asks[i] and not asks[j] and i % 70 != j % 70 and simhash.agree(sets[i], sets[j])}

        def parts(edges):
            root = list(range(80))
            for u, v in (tuple(e) for e in edges):
                a, b = root[u], root[v]
                root = [min(a, b) if x in (a, b) else x for x in root]
            return root

        assert parts(got) == parts(want)


def test_texts_around_a_passage_make_no_pairs_that_grow_with_their_square(spark):
    """Unlike texts that share most of their words: what the filters leave to compare is linear in the texts, at most."""
    from pyspark.sql import functions as F

    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(20000)]
    passage = list(rng.choice(words, 150))
    left = []
    for m in (150, 300, 600):
        rows = [" ".join([*rng.choice(words, 10), *passage, *rng.choice(words, 10)]) for _ in range(m)]
        df = spark.createDataFrame([(i, t, len(set(_shingles(t)))) for i, t in enumerate(rows)], "row long, text string, n long")
        posts = simhash.prefixes(simhash.stage_sets(df), 8)
        shared = posts.join(simhash.shared_tokens(posts), "token")
        a, b = (shared.select("token", *(F.col(c).alias(f"{c}_{x}") for c in ("row", "n", "common"))) for x in "ab")
        close = (F.col("row_a") < F.col("row_b")) & simhash.may_agree(F.col("n_a"), F.col("common_a"), F.col("n_b"), F.col("common_b"))
        left.append(a.withColumnRenamed("token", "same").join(b, (F.col("same") == F.col("token")) & close).count())
    assert all(k <= m for k, m in zip(left, (150, 300, 600), strict=True)), left


def _shingles(text):
    w = text.split()
    return [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))]


def test_prefixes_in_order_of_rarity_against_plain_counts(spark):
    """Every listed hash, its place and what is left after it, as a count over all sets gives them; blocks of few shingles."""
    from collections import Counter

    rng = np.random.default_rng(9)
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(rng.choice(words, k)) for k in rng.integers(0, 60, 120)]
    texts += [t + " more" for t in texts[:60]]
    hashes = simhash.WordHashes()
    sets = [np.unique(simhash.stage_shingles(t, hashes)).view(np.int64).tolist() for t in texts]
    counts = Counter(x for s in sets for x in s)
    want = set()
    for row, s in enumerate(sets):
        order = sorted(s, key=lambda x: (int(4 * np.log2(counts[x]) + 1e-9), x))
        for place, x in enumerate(order[: len(s) - -(-4 * len(s) // 5) + 1]):
            if counts[x] > 1:
                want.add((x, row, len(s), len(s) - place))
    df = spark.createDataFrame([(i, t, len(s)) for i, (t, s) in enumerate(zip(texts, sets, strict=True))], "row long, text string, n long")
    got = [tuple(r) for r in simhash.prefixes(simhash.stage_sets(df), 5).drop("step").collect()]
    assert len(got) == len(want) and set(got) == want


def test_of_equal_texts_the_smallest_row_speaks():
    """Whatever the order in which a block reads them."""
    texts = ["one two three four five six", "other words are here in this text", "one two three four five six"]
    for rows in ([7, 5, 2], [2, 5, 7], [5, 9, 3]):
        sent = simhash.block_messages(0, rows, texts, simhash.WordHashes(), 4).to_pylist()
        whole = next(simhash.expand(r["body"]) for r in sent if r["whole"])
        assert set(whole[0].tolist()) == {min(rows[0], rows[2]), rows[1]}
