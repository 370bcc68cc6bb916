import pytest

EDGE = [
    (1, "The cat sat on the mat and the dog ran to the tree in the park.", "en", "a"),
    (2, None, None, None),
    (3, "", "en", None),
    (None, "no id here", "en", "a"),
    (4, "le chat est sur la table et le chien dans le jardin de la ville", "fr", "b"),
    (4, "le chat est sur la table et le chien dans le jardin de la ville", "fr", "b"),
    (5, "The cat sat on the mat and the dog ran to the tree in the park.", "en", "a"),
    (6, "1234 ... !!", "de", "b"),
    (7, "word " * 20000 + "x" * 50000, "en", "a"),
    (200, "é́ 漢字 \x00 <|endoftext|> don't\n\n \ttabs", None, "c"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
#: Columns whose names operators use for themselves.
CLASH = ("score", "fp", "row", "key", "bucket", "n", "ids", "part", "block", "signatures", "component_id", "level", "found", "digest", "class_id", "u", "v", "root", "token", "w", "chunks", "recipe", "keep_id", "times", "told", "pairs", "__row_in_table", "row_")

TURNS = [
    (1, 0, "system", "You are kind."), (1, 1, "user", "Hello there."), (1, 2, "assistant", "Hi!"), (1, 2, "assistant", "Hi!"), (1, 5, "user", "Why"), (1, 6, "assistant", "So."),
    (2, None, "user", "No turn."), (2, None, "tool", None), (2, 0, None, "A role of a blank."), (2, 1, "", "No role at all?"),
    (None, 0, "user", "No id."), (None, None, None, None), (None, 1, "assistant", " \t\n"),
    (3, 0, "user", "word " * 30000 + "."), (3, 1, "assistant", "x" * 100000), (3, 2, "user", "\u00a0"), (3, 3, "user", "\u00e9!  "),
    (4, 7, "user", "Same."), (4, 7, "assistant", "Same."), (4, 7, "user", "Same."), (4, -3, "system", "Before?"),
    (6, 10, "user", "Gone, perhaps."), (9, 2**60, "user", "Far."), (9, 2**60 + 3, "assistant", "Farther."),
]
TURN_SCHEMA = "conv_id long, turn long, role string, text string"
CLASH_OF_TURNS = ("conv", "gone", "fault", "seen", "kind", "times", "again", "place", "audit", "by")


@pytest.fixture(scope="session")
def edge(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(EDGE, SCHEMA).withColumn("n_chars", F.length("text").cast("long"))
    return df.withColumns({c: F.lit("clash") for c in CLASH}).repartition(3).sortWithinPartitions("doc_id")


@pytest.fixture(scope="session")
def empty(edge):
    return edge.limit(0)


@pytest.fixture(scope="session")
def sf(tmp_path_factory, edge, spark):
    """A folder of tables with awkward rows."""
    from pyspark.sql import functions as F

    d = str(tmp_path_factory.mktemp("sf"))
    edge.write.parquet(f"{d}/documents.parquet")
    labels = [(1, 1, 0), (1, 1, 0), (2, 0, 1), (3, None, None), (None, 1, 1), (4, 0, 1), (99, 1, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    turns = spark.createDataFrame(TURNS, TURN_SCHEMA).withColumns({c: F.lit("clash") for c in CLASH_OF_TURNS})
    turns.repartition(3).write.parquet(f"{d}/conversations.parquet")
    return d


@pytest.fixture(scope="session")
def bare(tmp_path_factory, empty, spark):
    """The same with no rows at all."""
    d = str(tmp_path_factory.mktemp("bare"))
    empty.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([], TURN_SCHEMA).write.parquet(f"{d}/conversations.parquet")
    return d
