"""SimHash near-duplicates through a hierarchical index in Gray order.

Fingerprints: words of the text with A-Z in lower case, shingles of SHINGLE words with repeats, XXH64
of each, and for each of 64 bits the majority. Two fingerprints link at BITS or fewer differing bits.

Distinct fingerprints are range-partitioned and sorted by their rank in the Gray sequence, where
neighbours share long runs of bits. Each run of FAN fingerprints is a leaf, FAN leaves are a node, the
nodes of a partition its root; every one of them keeps a mask of the bits on which all below it agree,
and their pattern. A self-join descends pairs of nodes from the roots: a pair whose patterns already
differ in more than BITS bits that both masks hold is pruned with all below it. Only surviving pairs of
leaves are compared bit by bit, and of the links found in a batch only a spanning forest goes on. Equal
fingerprints are one entry from the start, so a group of copies of any size costs one row.

Components come from alternating large-star and small-star steps, each written to the shared folder.

Rows: null and empty texts have fingerprint zero and link like any other; very long texts are read whole;
a bit that exactly half the shingles have is 0, and of ties for the smallest id there is one value; null ids get the component of
their fingerprint but never name it (null if there is no other id); repeated rows are copies of each
other; an empty table gives no rows. Only doc_id and text are read by the query; the pipeline stage
keeps all columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, expand, load, materialize, small_batches, small_tables, squeeze

SHINGLE, BITS, SEED, FAN = 3, 2, 42, 64
#: Fingerprints in a partition of the index at most, about; a root has as many nodes as FAN * FAN goes into it.
PARTITION_ROWS = 1 << 20
STEPS = 40


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint, unsigned."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    digest, n, counts = xxhash.xxh64_intdigest, len(words) - shingle + 1, np.zeros(64, np.int64)
    for lo in range(0, n, 65536):
        part = words[lo : min(lo + 65536, n) + shingle - 1]
        hashes = np.fromiter((digest(b" ".join(s), SEED) for s in zip(*(part[k:] for k in range(shingle)), strict=False)), np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def fingerprint_column(df: DataFrame, text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint of a text column as a signed long."""
    small_batches(df.sparkSession)

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return run(text)


def gray_rank(fp: Column) -> Column:
    """The place of a fingerprint in the Gray sequence, as a long that sorts like the unsigned number."""
    for k in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, k))
    return fp.bitwiseXOR(F.lit(-(1 << 63)))


def summary(patterns: np.ndarray, masks: np.ndarray) -> tuple[int, int]:
    """Mask and pattern of what is shared by all of them."""
    every, some = np.bitwise_and.reduce(patterns), np.bitwise_or.reduce(patterns)
    mask = np.bitwise_and.reduce(masks) & ~(every ^ some)
    return int(mask), int(every & mask)


NODE = "level int, id long, mask long, pattern long, masks binary, patterns binary"
WIDE = np.uint64(0xFFFFFFFFFFFFFFFF)


def index(fps: DataFrame) -> DataFrame:
    """Nodes of the index over distinct fingerprints (column fp): leaves are level 0, nodes 1, roots 2.

    The id holds the partition and a running number; the children of node i are FAN * i and on, those of
    a root all nodes of its partition. masks and patterns are those of the children.
    """
    spark = fps.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), fps.count() // PARTITION_ROWS + 1)
    ranked = fps.select("fp", gray_rank(F.col("fp")).alias("rank")).repartitionByRange(n, "rank").sortWithinPartitions("rank").select("fp")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        rows: list[tuple] = []
        upper: list[tuple[int, int]] = []
        rest = np.zeros(0, np.uint64)

        def leaves(codes: np.ndarray) -> None:
            for lo in range(0, len(codes), FAN):
                own = codes[lo : lo + FAN]
                whole = np.full(len(own), WIDE)
                mask, pattern = summary(own, whole)
                rows.append((0, part + len(upper), mask, pattern, whole.tobytes(), own.tobytes()))
                upper.append((mask, pattern))

        def out() -> pa.RecordBatch:
            level, ids, mask, pattern, masks, patterns = zip(*rows, strict=True)
            longs = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (mask, pattern)]
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(level, pa.int32()), pa.array(ids, pa.int64()), *longs, pa.array(masks, pa.binary()), pa.array(patterns, pa.binary())], ["level", "id", "mask", "pattern", "masks", "patterns"])

        for b in batches:
            codes = np.concatenate([rest, b.column(0).to_numpy().view(np.uint64)])
            cut = len(codes) // FAN * FAN
            leaves(codes[:cut])
            rest = codes[cut:]
            if len(rows) >= 1024:
                yield out()
        leaves(rest)
        if not upper:
            return
        for level in (1, 2):
            below = np.array(upper, np.uint64)
            upper.clear()
            step = FAN if level == 1 else len(below)
            for lo in range(0, len(below), step):
                own = below[lo : lo + step]
                mask, pattern = summary(own[:, 1], own[:, 0])
                rows.append((level, part + len(upper), mask, pattern, own[:, 0].tobytes(), own[:, 1].tobytes()))
                upper.append((mask, pattern))
        yield out()

    return ranked.mapInArrow(build, NODE)


def near(pa_: np.ndarray, ma: np.ndarray, pb: np.ndarray, mb: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs that differ in at most so many bits that both masks hold."""
    return np.nonzero(np.bitwise_count((pa_[:, None] ^ pb[None, :]) & ma[:, None] & mb[None, :]) <= bits)


def pairs_batch(a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch:
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def root_pairs(nodes: DataFrame, bits: int) -> DataFrame:
    """Pairs of roots, a <= b, that may hold links. There is one root for each partition of the index."""
    roots = nodes.where("level = 2").select("id", "mask", "pattern").toArrow()
    ids = roots.column(0).to_numpy()
    masks, patterns = (roots.column(k).to_numpy().view(np.uint64) for k in (1, 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                mine = batch.column(0).to_numpy()
                m, p = (batch.column(k).to_numpy().view(np.uint64) for k in (1, 2))
                i, j = near(p, m, patterns, masks, bits)
                keep = mine[i] <= ids[j]
                yield pairs_batch([mine[i][keep]], [ids[j][keep]])

    return nodes.where("level = 2").select("id", "mask", "pattern").mapInArrow(run, "a long, b long")


def with_children(pairs: DataFrame, nodes: DataFrame, level: int) -> DataFrame:
    own = nodes.where(F.col("level") == level)
    left = own.select(F.col("id").alias("a"), F.col("masks").alias("ma"), F.col("patterns").alias("pa"))
    right = own.select(F.col("id").alias("b"), F.col("masks").alias("mb"), F.col("patterns").alias("pb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "ma", "pa", "mb", "pb")


def arrays(batch: pa.RecordBatch) -> Iterator[tuple]:
    for a, b, *rest in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
        yield (a, b, *(np.frombuffer(x, np.uint64) for x in rest))


def descend(pairs: DataFrame, nodes: DataFrame, level: int, bits: int) -> DataFrame:
    """Pairs of nodes of a level to those pairs of their children that aren't pruned."""
    low = (1 << 32) - 1
    fan = FAN if level == 1 else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            for a, b, ma, pa_, mb, pb in arrays(batch):
                i, j = near(pa_, ma, pb, mb, bits)
                x, y = (a & ~low) + (a & low) * fan + i, (b & ~low) + (b & low) * fan + j
                keep = x <= y
                left.append(x[keep])
                right.append(y[keep])
            yield pairs_batch(left, right)

    return with_children(pairs, nodes, level).mapInArrow(run, "a long, b long")


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each node to the smallest one it is connected to."""
    names, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    label = np.arange(len(names))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = np.minimum(new, new[new])
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(names))
    return names[moved], names[label[moved]]


def links(pairs: DataFrame, nodes: DataFrame, bits: int) -> DataFrame:
    """Surviving pairs of leaves to edges (u, v) of fingerprints: a spanning forest of each batch's links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us, vs = [], []
            for _, _, ma, pa_, mb, pb in arrays(batch):
                i, j = near(pa_, ma, pb, mb, bits)
                keep = pa_[i] != pb[j]
                if keep.any():
                    us.append(pa_[i][keep].view(np.int64))
                    vs.append(pb[j][keep].view(np.int64))
            if us:
                u, v = forest(np.concatenate(us), np.concatenate(vs))
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return with_children(pairs, nodes, 0).mapInArrow(run, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """(u, root): for every node of edges (u, v) but the roots, the smallest node it is connected to."""

    def both(e: DataFrame) -> DataFrame:
        return e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))

    def settled(e: DataFrame) -> bool:
        """Whether every node points to one root at most and no root to another."""
        ends = e.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(e.select("v", F.lit(0), F.lit(1)))
        nodes = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        return nodes.where((F.col("up") > 1) | (F.col("up") + F.col("down") > 1)).isEmpty()

    now = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    for _ in range(STEPS):
        if settled(now):
            break
        two = both(now)
        low = two.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = two.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialize(large, "edges")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        new = materialize(small.where("u <> v").distinct(), "edges")
        discard(large)
        discard(now)
        now = new
    else:
        raise RuntimeError("components did not settle")
    out = now.select("u", F.col("v").alias("root"))
    out._scratch_path = now._scratch_path
    return out


def fingerprint_components(fps: DataFrame, bits: int = BITS) -> DataFrame:
    """(fp, component_id) for rows (doc_id, fp): the smallest doc_id reachable over links."""
    distinct = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "fingerprints")
    nodes = materialize(index(distinct.select("fp")), "index")
    pairs = root_pairs(nodes, bits)
    for level in (2, 1):
        pairs = descend(pairs, nodes, level, bits)
    found = materialize(links(pairs, nodes, bits), "links")
    discard(nodes)
    root = components(found)
    discard(found)
    named = distinct.join(root, distinct["fp"] == root["u"], "left").select("fp", "doc_id", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    out = materialize(named.join(least, "root").select("fp", "component_id"), "components")
    for t in (distinct, root):
        discard(t)
    return out


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """Documents (doc_id, text) to doc_id, fp (signed long) and component_id."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    fps = materialize(rows.select("doc_id", fingerprint_column(rows, F.col("text"), shingle).alias("fp")), "fingerprints")
    return fps.join(fingerprint_components(fps, bits), "fp", "left").select("doc_id", "fp", "component_id")


def op5_simhash(spark, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and component."""
    found = near_duplicates(load(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


# ---- The pipeline stage: five-word shingles and a similarity of 0.8, with an exact check.

STAGE_SHINGLE, STAGE_LIKENESS = 5, 0.8
#: Words whose hashes a Python worker remembers.
WORDS = 200_000
#: Characters of text in a block of documents, and of the texts whose shingles one range holds, about.
BLOCK_CHARS, RANGE_CHARS = 3_000_000, 16_000_000
#: Shingles of a block of texts with partners, and of the texts whose frequencies one range counts, about.
SET_SHINGLES, RANGE_SHINGLES = 1_000_000, 2_000_000
#: Steps of frequency for each doubling of it.
PER_DOUBLING = 4
#: Rows of a key up to which its pairs are listed; larger groups are compared in blocks of so many rows or shingles, about.
LISTED, BLOCK_ROWS, BLOCK_SHINGLES = 64, 1024, 1_000_000
#: Pairs for each row of two blocks up to which they are compared one by one.
ONE_BY_ONE = 4
#: Shingles of a block compared at once.
COLUMNS = 4096
TIMES = np.uint64(0xD6E8FEB86659FD93)
HALF = np.uint64(32)


def mixed(x: np.ndarray) -> np.ndarray:
    """The hashes mixed anew, one to one."""
    x = (x ^ (x >> HALF)) * TIMES
    return x ^ (x >> HALF)


def dealt(x: np.ndarray, n_ranges: int) -> np.ndarray:
    """The range that a hash belongs to: equal parts of all 64-bit numbers, in order."""
    return ((x >> HALF) * np.uint64(n_ranges) >> HALF).astype(np.int32)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > WORDS:
            self.clear()
        self[word] = out = xxhash.xxh64_intdigest(word, SEED)
        return out


def stage_shingles(text: str | None, hashes: WordHashes) -> np.ndarray:
    """A hash for each shingle, with repeats, from its words' hashes; the whole sequence of fewer words is one."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    own = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(len(words), STAGE_SHINGLE)
    n = len(words) - size + 1 if words else 1
    out = np.full(n, size + 1, np.uint64)
    for k in range(size):
        out = mixed(out * TIMES + own[k : k + n])
    return out


def majority(hashes: np.ndarray) -> int:
    """A SimHash: the bits that over half the hashes have."""
    counts = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 65536):
        counts += np.unpackbits(hashes[lo : lo + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes), bitorder="little").tobytes(), "little")


def agree(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= STAGE_LIKENESS * (len(x) + len(y) - both) - 1e-9


def may_agree(n: Column, common: Column, m: Column, other: Column) -> Column:
    """Whether sets of n and m shingles, of which no more than so many can be common, can be similar."""
    return F.least(common, other) >= (n + m) * STAGE_LIKENESS / (1 + STAGE_LIKENESS) - 1e-9


MESSAGE = [("range", pa.int32()), ("block", pa.int64()), ("whole", pa.bool_()), ("body", pa.binary())]
MESSAGE_SQL = "range int, block long, whole boolean, body binary"


def messages(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(MESSAGE)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, MESSAGE, strict=True)], [n for n, _ in MESSAGE])


def block_messages(block: int, rows: list[int], texts: list[str | None], words: WordHashes, n_ranges: int) -> pa.RecordBatch:
    """What a block of texts sends: to each range of hashes its shingles, and one message about the block as a whole.

    Of equal texts in a block the smallest row speaks, in whatever order they are read. A shingle that several of the block's texts hold goes
    once, without naming them; another goes with its text's digest of 32 bits, so that copies don't count
    as others (texts that differ and have one digest, a chance of 2 ** -32, don't either).
    """
    import xxhash

    first: dict[int, int] = {}
    for i, text in enumerate(texts):
        i = min(first.setdefault(digest := xxhash.xxh3_64_intdigest((text or "").encode("utf-8", "surrogatepass")), i), i, key=rows.__getitem__)
        first[digest] = i
    digests = np.fromiter(first, np.uint64, len(first)).astype(np.uint32)
    own, prints = [], np.zeros(len(first), np.uint64)
    for k, i in enumerate(first.values()):
        hashes = stage_shingles(texts[i], words)
        prints[k] = majority(hashes)
        own.append(np.unique(hashes))
    sizes = np.array([len(x) for x in own], np.int64)
    flat, who = np.concatenate(own), np.repeat(np.arange(len(own), dtype=np.int32), sizes)
    own.clear()
    order = np.argsort(flat, kind="stable")
    flat, who = flat[order], who[order]
    starts = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    times = np.diff(np.append(starts, len(flat)))
    several = np.repeat(times > 1, times)
    inside = np.bincount(who[several], minlength=len(sizes))

    shared, single, who = flat[starts[times > 1]], flat[~several], who[~several]
    order = np.lexsort((who, dealt(single, n_ranges)))
    single, who = single[order], who[order]
    edges = np.arange(n_ranges + 1)
    one, two = (np.searchsorted(dealt(x, n_ranges), edges) for x in (single, shared))
    out = []
    for k in np.flatnonzero((np.diff(one) > 0) | (np.diff(two) > 0)).tolist():
        mine = slice(one[k], one[k + 1])
        at, counts = np.unique(who[mine], return_counts=True)
        body = (np.diff(at, prepend=0).astype(np.uint32), counts.astype(np.uint32), digests[at], single[mine].astype(np.uint32), shared[two[k] : two[k + 1]].astype(np.uint32))
        out.append((k, block, False, squeeze(body)))
    whole = (np.array([rows[i] for i in first.values()], np.int64), prints, sizes, inside)
    out.append((block % n_ranges, block, True, squeeze(whole)))
    return messages(out)


def sent(docs: DataFrame, n_ranges: int) -> DataFrame:
    """The messages of all blocks of (row, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, k, rows, texts, room = WordHashes(), TaskContext.get().partitionId() << 32, 0, [], [], BLOCK_CHARS
        for b in batches:
            for row, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows.append(row)
                texts.append(text)
                room -= len(text or "")
                if room <= 0:
                    yield block_messages(part | k, rows, texts, words, n_ranges)
                    k, rows, texts, room = k + 1, [], [], BLOCK_CHARS
        if rows:
            yield block_messages(part | k, rows, texts, words, n_ranges)

    return docs.select("row", "text").mapInArrow(run, MESSAGE_SQL)


def answered(table: pa.Table) -> pa.Table:
    """A range's messages to each block's counts: how many of a text's shingles here occur in other texts."""
    out, asked = [], []
    for r in table.to_pylist():
        if r["whole"]:
            out.append((r["range"], r["block"], True, r["body"]))
        else:
            asked.append((r["block"], *expand(r["body"])))
    if asked:
        slots = np.concatenate([x for _, _, _, _, one, two in asked for x in (one, two)])
        texts = np.concatenate([x for _, _, n, d, _, two in asked for x in (np.repeat(d, n), np.zeros(len(two), np.uint32))])
        several = np.concatenate([x for *_, one, two in asked for x in (np.zeros(len(one), bool), np.ones(len(two), bool))])
        order = np.argsort(slots, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], slots[order][1:] != slots[order][:-1]]))
        texts = texts[order]
        other = (np.minimum.reduceat(texts, starts) != np.maximum.reduceat(texts, starts)) | np.logical_or.reduceat(several[order], starts)
        found = np.empty(len(slots), np.int64)
        found[order] = np.repeat(other, np.diff(np.append(starts, len(slots))))
        lo = 0
        for block, at, n, _, one, two in asked:
            if len(at):
                out.append((0, block, False, squeeze((at, np.add.reduceat(found[lo : lo + len(one)], np.cumsum(n, dtype=np.int64) - n).astype(np.uint32)))))
            lo += len(one) + len(two)
    return pa.Table.from_batches([messages(out)])


def added_up(table: pa.Table) -> pa.Table:
    """A block's answers to (row, fp, n, common) of its texts."""
    bodies = [(r["whole"], expand(r["body"])) for r in table.to_pylist()]
    rows, prints, n, common = next(b for whole, b in bodies if whole)
    common = common.copy()
    for whole, b in bodies:
        if not whole:
            common[np.cumsum(b[0])] += b[1]
    return pa.Table.from_arrays([pa.array(rows), pa.array(prints.view(np.int64)), pa.array(n), pa.array(common)], ["row", "fp", "n", "common"])


def stage_prints(docs: DataFrame, n_chars: int) -> DataFrame:
    """(row, fp, n, common) of the texts (row, text), of copies one at least: the SimHash, how many shingles, and how many of them other texts hold."""
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_chars // RANGE_CHARS)
    told = sent(docs, n).groupBy("range").applyInArrow(answered, MESSAGE_SQL)
    return told.groupBy("block").applyInArrow(added_up, "row long, fp long, n long, common long")


def stage_sets(texts: DataFrame) -> DataFrame:
    """(row, n, value, block) for (row, text, n): the sorted distinct hashes of the shingles, and a number for the rows that follow each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, block, room = WordHashes(), TaskContext.get().partitionId() << 32, SET_SHINGLES
        for b in batches:
            sets, blocks = [], []
            for t in b.column(2).to_pylist():
                sets.append(np.unique(stage_shingles(t, words)))
                blocks.append(block)
                room -= len(sets[-1])
                if room <= 0:
                    block, room = block + 1, SET_SHINGLES
            columns = [b.column(0), b.column(1), pa.array([x.tobytes() for x in sets], pa.binary()), pa.array(blocks, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["row", "n", "value", "block"])

    return texts.select("row", "n", "text").mapInArrow(run, "row long, n long, value binary, block long")


def asked(sets: DataFrame, n_ranges: int) -> DataFrame:
    """The messages of all blocks of sets: to each range its slots (hashes by their lower halves) and how many of the block's rows hold each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            blocks, values = b.column(1).to_numpy(), [np.frombuffer(x, np.uint64) for x in b.column(0).to_pylist()]
            starts = np.flatnonzero(np.concatenate([[True], blocks[1:] != blocks[:-1]])) if len(blocks) else []
            out = []
            for lo, hi in zip(starts, [*starts[1:], len(blocks)], strict=True):
                flat, times = np.unique(np.concatenate(values[lo:hi]), return_counts=True)
                at = np.searchsorted(dealt(flat, n_ranges), np.arange(n_ranges + 1))
                for k in np.flatnonzero(np.diff(at)).tolist():
                    mine = slice(at[k], at[k + 1])
                    out.append((k, int(blocks[lo]), False, squeeze((flat[mine].astype(np.uint32), times[mine].astype(np.uint32)))))
            yield messages(out)

    return sets.select("value", "block").mapInArrow(run, MESSAGE_SQL)


def counted(table: pa.Table) -> pa.Table:
    """A range's messages to each block's answers: how frequent its slots are in all sets, in steps; those of one set alone are left out."""
    told = [(r["range"], r["block"], *expand(r["body"])) for r in table.to_pylist()]
    _, at = np.unique(np.concatenate([x for *_, x, _ in told]), return_inverse=True)
    total = np.bincount(at, np.concatenate([x for *_, x in told]))
    step = np.floor(PER_DOUBLING * np.log2(total) + 1e-9).astype(np.uint8)[at]
    out, lo = [], 0
    for k, block, slots, _ in told:
        own = step[lo : lo + len(slots)]
        out.append((k, block, False, squeeze((slots[own > 0], own[own > 0]))))
        lo += len(slots)
    return pa.Table.from_batches([messages(out)])


def rarest(sets: pa.Table, told: pa.Table, n_ranges: int) -> pa.Table:
    """A block's sets and the answers to it to (token, step, row, n, common) of each set's prefix, see prefixes()."""
    replies = [(r["range"], *expand(r["body"])) for r in told.to_pylist()]
    names = [np.uint64(k) << HALF | slots.astype(np.uint64) for k, slots, _ in replies]
    names, first = np.unique(np.concatenate([*names, np.zeros(0, np.uint64)]), return_index=True)
    steps = np.concatenate([*(x for *_, x in replies), np.zeros(0, np.uint8)])[first]
    tokens, ranks, left = [np.zeros(0, np.int64)], [np.zeros(0, np.uint8)], [np.zeros(0, np.int64)]
    counts = []
    for x in sets.column("value").to_pylist():
        own = np.frombuffer(x, np.uint64)
        keys = dealt(own, n_ranges).astype(np.uint64) << HALF | own & np.uint64(0xFFFFFFFF)
        step = np.zeros(len(own), np.uint8)
        if len(names):
            at = np.minimum(np.searchsorted(names, keys), len(names) - 1)
            step = np.where(names[at] == keys, steps[at], 0).astype(np.uint8)
        order = np.lexsort((own.view(np.int64), step))[: len(own) - int(np.ceil(STAGE_LIKENESS * len(own) - 1e-9)) + 1]
        places = np.flatnonzero(step[order])
        tokens.append(own.view(np.int64)[order[places]])
        ranks.append(step[order[places]])
        left.append(len(own) - places)
        counts.append(len(places))
    again = pa.array(np.repeat(np.arange(sets.num_rows), counts))
    columns = [pa.array(np.concatenate(tokens)), pa.array(np.concatenate(ranks).astype(np.int32)), sets.column("row").take(again), sets.column("n").take(again), pa.array(np.concatenate(left))]
    return pa.Table.from_arrays(columns, ["token", "step", "row", "n", "common"])


def prefixes(sets: DataFrame, n_ranges: int) -> DataFrame:
    """(token, step, row, n, common): of each set so many of its rarest hashes that two similar sets share one of them.

    One order of all hashes holds for all sets: by the number of sets that have them, in steps, and then by
    value. A hash that no other set has is in the prefix but isn't listed. `common` is how many of the set
    are left from this one on; two sets whose first shared hash this is share no more than the lesser one of theirs.
    """

    def run(key: tuple, rows: pa.Table, told: pa.Table) -> pa.Table:
        return rarest(rows, told, n_ranges)

    told = asked(sets, n_ranges).groupBy("range").applyInArrow(counted, MESSAGE_SQL)
    return sets.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(run, "token long, step int, row long, n long, common long")


def shared_tokens(posts: DataFrame) -> DataFrame:
    """(token, m, head) of the tokens that several rows list, with the row that lists it earliest; of tokens that exactly the same rows list, the rarest."""
    own = F.struct(((F.col("n") - F.col("common")) / F.col("n")).alias("own"), "row", "n", "common")
    who = [F.bit_xor(F.xxhash64("row")).alias("a"), F.bit_xor(F.xxhash64(F.lit(1), "row")).alias("b")]
    groups = posts.groupBy("token").agg(F.count("*").alias("m"), F.min(own).alias("head"), F.min("step").alias("step"), *who).where("m > 1")
    return groups.groupBy("m", "a", "b").agg(F.min_by(F.struct("token", "head"), F.struct("step", "token")).alias("first")).select("first.token", "m", "first.head")


def kept_edges(edges: DataFrame, sets: DataFrame) -> DataFrame:
    """Those edges (u, v) whose sets are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pairs = zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)
            keep = [agree(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in pairs]
            yield b.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    left, right = (sets.select(F.col("row").alias(c), F.col("value").alias(x)) for c, x in (("u", "x"), ("v", "y")))
    return edges.join(left, "u").join(right, "v").select("u", "v", "x", "y").mapInArrow(run, "u long, v long")


def overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """The sizes of the intersections of all pairs of sets."""
    flat = [np.concatenate(s) for s in (a, b)]
    who = [np.repeat(np.arange(len(s)), [len(x) for x in s]) for s in (a, b)]
    names = np.intersect1d(*flat)
    for k in range(2):
        kept = np.flatnonzero(np.isin(flat[k], names))
        column = np.searchsorted(names, flat[k][kept])
        order = np.argsort(column, kind="stable")
        flat[k], who[k] = column[order], who[k][kept][order]
    out = np.zeros((len(a), len(b)), np.float32)
    for lo in range(0, len(names), COLUMNS):
        sides = []
        for x, w, n in zip(flat, who, out.shape, strict=True):
            own, side = slice(*np.searchsorted(x, (lo, lo + COLUMNS))), np.zeros((n, COLUMNS), np.float32)
            side[w[own], x[own] - lo] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    return out


def compared(table: pa.Table) -> pa.Table:
    """Rows that ask and rows of a block to the links between rows of different components, a spanning forest of them.

    Pairs that their sizes and places in the order rule out are never compared; where few are left, those are
    compared one by one, and else all rows that are in any of them at once.
    """
    asking = table.column("asks").to_numpy(zero_copy_only=False)
    row, root, common = (table.column(c).to_numpy() for c in ("row", "root", "common"))
    sets = [np.frombuffer(x, np.uint64) for x in table.column("value").to_pylist()]
    n = np.array([len(x) for x in sets])
    i, j = np.flatnonzero(asking), np.flatnonzero(~asking)
    u = v = np.zeros(0, np.int64)
    if len(i) and len(j):
        need = (n[i][:, None] + n[j][None, :]) * (STAGE_LIKENESS / (1 + STAGE_LIKENESS)) - 1e-6
        may = (np.minimum(common[i][:, None], common[j][None, :]) >= need) & (root[i][:, None] != root[j][None, :])
        x, y = np.nonzero(may)
        if len(x) <= ONE_BY_ONE * (len(i) + len(j)):
            similar_ = np.array([agree(sets[i[a]], sets[j[b]]) for a, b in zip(x.tolist(), y.tolist(), strict=True)], bool)
            x, y = x[similar_], y[similar_]
        else:
            i, j, may = i[may.any(axis=1)], j[may.any(axis=0)], may[may.any(axis=1)][:, may.any(axis=0)]
            both = overlaps([sets[k] for k in i], [sets[k] for k in j])
            x, y = np.nonzero(may & (both >= STAGE_LIKENESS * (n[i][:, None] + n[j][None, :] - both) - 1e-6))
        u, v = row[i[x]], row[j[y]]
        if len(u):
            u, v = forest(u, v)
    return pa.Table.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def rest_of_links(posts: DataFrame, groups: DataFrame, root: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (u, v) between rows that share a token and are in different components (u, root) so far."""
    ours = posts.join(groups.where("m > 2").select("token"), "token", "left_semi").join(root.select(F.col("u").alias("row"), "root"), "row", "left")
    ours = ours.withColumn("root", F.coalesce("root", "row"))
    parts = ours.groupBy("token", "root").agg(F.count("*").alias("m"), F.sum("n").alias("n"), F.min("n").alias("n_least"), F.max("common").alias("common_most"))
    main = F.max(F.struct("m", "root", "n")).alias("main")
    bounds = (F.min("n_least").alias("n_least"), F.max("common_most").alias("common_most"))
    left = parts.groupBy("token").agg(F.sum("m").alias("m"), F.sum("n").alias("total"), F.count("*").alias("k"), main, *bounds).where("k > 1")
    left = materialize(left.select("token", "m", "total", "n_least", "common_most", F.col("main.root").alias("main"), (F.col("m") - F.col("main.m")).alias("m_left"), (F.col("total") - F.col("main.n")).alias("n_left")), "open")
    # Rows that could not be similar even to a row with the group's least size and earliest place are done.
    members = materialize(ours.join(left, "token").where(may_agree(F.col("n"), F.col("common"), F.col("n_least"), F.col("common_most"))), "members")
    a, b = (members.where(F.col("m") <= LISTED).select("token", *(F.col(c).alias(f"{c}_{x}") for c in ("row", "root", "n", "common"))) for x in "ab")
    close = (F.col("row_a") < F.col("row_b")) & (F.col("root_a") != F.col("root_b")) & may_agree(F.col("n_a"), F.col("common_a"), F.col("n_b"), F.col("common_b"))
    pairs = materialize(a.withColumnRenamed("token", "same").join(b, (F.col("same") == F.col("token")) & close).select(F.col("row_a").alias("u"), F.col("row_b").alias("v")).distinct(), "pairs")

    def blocks(rows: str, shingles: str) -> Column:
        return F.greatest(F.ceil(F.col(rows) / BLOCK_ROWS), F.ceil(F.col(shingles) / BLOCK_SHINGLES)).cast("int")

    large = members.where(F.col("m") > LISTED).withColumns({"asking": blocks("m_left", "n_left"), "asked": blocks("m", "total")})

    def spread(rows: DataFrame, asks: bool) -> DataFrame:
        mine, others = ("asking", "asked") if asks else ("asked", "asking")
        own, each = F.pmod(F.xxhash64("row"), F.col(mine)).cast("int"), F.explode(F.sequence(F.lit(0), F.col(others) - 1))
        return rows.select("token", "row", "root", "common", F.lit(asks).alias("asks"), own.alias(mine), each.alias(others)).select("token", "asking", "asked", "row", "root", "common", "asks")

    both = spread(large.where("root <> main"), True).union(spread(large, False))
    found = both.join(sets.select("row", "value"), "row").groupBy("token", "asking", "asked").applyInArrow(compared, "u long, v long")
    out = materialize(kept_edges(pairs, sets).union(found).distinct(), "links")
    for t in (left, members, pairs):
        discard(t)
    return out


def similar(docs: DataFrame) -> DataFrame:
    """(row, root) for rows (row, text): every row but the first of each group, with its group's first row.

    Groups are the components of a Jaccard similarity of STAGE_LIKENESS or more between sets of shingles;
    equal texts are one from the start. Candidates come from the Gray-order index over the texts' SimHashes,
    and, as similar texts may differ in more bits than the index takes, from an exact search:

    1. Two sets are similar only if so many of either's shingles are in the other. Ranges of the hashes
       count for every text how many of its shingles other texts hold; texts with too few have no partner
       and are done.
    2. Of the others, two similar sets share one of a fifth of their hashes, the rarest ones, and have enough
       left from the first one that they share (prefix and position filters; the ranges count how many
       sets hold a hash). Rows that share one are compared with the row among them that lists it
       earliest, so a group of copies of any size costs a comparison per row.
    3. Rows that share a hash and are still in different components are compared with each other: listed
       in pairs where few share it, and else all rows but those of the largest component in blocks
       against all, within tasks, of which only links come out. A pair that sizes and positions rule
       out is never listed, and of hashes that the same rows list only the rarest one counts. A passage
       that unlike texts share comes after their rare hashes, where too little is left for a link.
    """
    text = F.coalesce("text", F.lit(""))
    sums = materialize(docs.select("row", F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"), F.length(text).alias("chars")), "texts")
    same = materialize(sums.groupBy("a", "b").agg(F.min("row").alias("root")), "firsts")
    copies = materialize(sums.join(same, ["a", "b"]).where("row <> root").select("row", "root"), "copies")
    n_chars = sums.agg(F.sum("chars")).first()[0] or 0
    small_batches(docs.sparkSession)
    every = materialize(stage_prints(docs, n_chars), "prints")
    prints = materialize(every.join(same.select(F.col("root").alias("row")), "row", "left_semi"), "prints")
    for t in (sums, same, every):
        discard(t)
    alive = materialize(prints.where(F.col("common") >= STAGE_LIKENESS * F.col("n") - 1e-9).select("row", "n"), "alive")
    sets = materialize(stage_sets(docs.select("row", "text").join(alive, "row")), "sets")
    n_shingles = alive.agg(F.sum("n")).first()[0] or 0
    posts = materialize(prefixes(sets, max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_shingles // RANGE_SHINGLES)), "prefixes")
    groups = materialize(shared_tokens(posts), "groups")
    near = prints.select(F.col("row").alias("doc_id"), "fp")
    indexed = fingerprint_components(near)
    near = near.join(indexed, "fp").where("doc_id <> component_id").select(F.col("doc_id").alias("u"), F.col("component_id").alias("v"))
    fits = may_agree(F.col("n"), F.col("common"), F.col("head.n"), F.col("head.common"))
    tries = posts.join(groups, "token").where((F.col("row") != F.col("head.row")) & fits).select(F.greatest("row", "head.row").alias("u"), F.least("row", "head.row").alias("v"))
    tries = materialize(near.union(tries).distinct(), "tries")
    links_ = materialize(kept_edges(tries, sets), "links")
    for t in (tries, indexed):
        discard(t)
    root = components(links_)
    more = rest_of_links(posts, groups, root, sets)
    if not more.isEmpty():
        discard(root)
        root = components(links_.union(more))
    named = copies.join(root.select(F.col("u").alias("first"), F.col("root").alias("to")), F.col("root") == F.col("first"), "left")
    out = materialize(named.select("row", F.coalesce("to", "root").alias("root")).union(root), "similar")
    for t in (copies, prints, alive, sets, posts, groups, links_, more, root):
        discard(t)
    return out


def keep_one(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A pipeline stage: of each group of similar texts the first row stays, columns as they were.

    Rows are told apart by a number that is written beside them once, so null and repeated ids don't matter, nor
    does how later passes divide the table among tasks.
    """
    small_tables(spark)
    number = "row"
    while number in {c.lower() for c in docs.columns}:
        number += "_"
    placed = materialize(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    gone = similar(placed.select(F.col(number).alias("row"), F.col("text").cast("string").alias("text"))).select(F.col("row").alias(number)).distinct()
    return placed.join(gone, number, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
