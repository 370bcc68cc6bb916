"""Chroma fingerprints of recordings, and their alignment with a set of queries.

A recording is a run of frames of twelve pitch-class energies. frames_of_sound() takes them from
samples by short Fourier transforms; the test tables hold no sound, so the query renders each text as a
score: every character is a note of one pitch class (its code point modulo 12), and a frame lasts from
beat to beat. Beats fall on words, by a hash of their letters, so that a passage has the same beats
wherever it stands.

Over the frames, an integral image gives the sums under FILTERS, rectangles in time and pitch, in two or
three parts of opposite sign, at every frame. Each compares its parts by the logarithm of their ratio,
is cut into four levels, and adds two bits (a Gray code) to the frame's 32-bit integer.

Search: queries are the rows whose id is divisible by QUERY. Recordings with equal integers, those of the last places
included, are one class, named by the smallest id, and so are queries. Marks stand for a class: at every frame, the bits of the
filters of up to SHORT frames of RUN neighbours in a row, so that a mark spans seven frames, survives bits
that differ elsewhere, and each unedited run of that length yields one. A class is compared with every
class of queries that shares a mark with it. Its queries go with it as one list, and the comparisons are made where
a part of the classes meets a block of queries: what is shuffled grows with the classes, not with the pairs. All places of the shared
marks vote, each pair of places for its difference. The alignment of the two is the highest column of this
histogram that has LEAST votes within DRIFT frames, as an edited copy gains or loses beats (ties: most votes
there, then smallest offset), judged by the share of bits that differ over the overlap.
A document reports its alignments with all classes of queries, most votes
first (ties: smallest query), each under the class's smallest query but the row itself; the first one is
given in columns of its own, and all of them as JSON. The other queries of a class are the queries of the same class_id.

Rows: very long texts are read whole; null and empty texts have no frames, no class partner but each other, and no alignment; null ids
are never queries; repeated rows are copies; a recording of fewer frames than a filter needs is padded with silence; an
empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROWS_PER_BATCH, ascending, by_bucket, expand, from_ascending, from_planes, load, materialize, planes, small_batches, squeeze

QUERY, BEAT, SPAN = 100, 4, 12
#: Filters in a mark (the first ones), frames of the longest of them, neighbours in a mark.
MARKED, SHORT, RUN = 7, 4, 4
#: Votes that an alignment needs, within so many frames.
LEAST, DRIFT = 1, 4
#: Pairs of places of a key that are listed one by one; beyond that they are counted by Fourier transforms.
PLAIN = 1 << 16
#: Marks in a block of recordings and in a bucket, about.
BLOCK_MARKS, BUCKET_MARKS = 1_000_000, 1_000_000
#: Pairs of a block that are held before they are made distinct.
HELD_PAIRS = 4_000_000
#: Bytes of a block of queries, and pairs that a part of the recordings has with it, about; more where a copy of the block for each part were more bytes a pair than the last one.
QUERY_BYTES, PART_PAIRS, COPY_BYTES = 8_000_000, 8_000, 200
EDGES = (-0.25, 0.0, 0.25)
#: By rule: four kinds of partition, over four widths in frames, each at a place in pitch of its own.
FILTERS = tuple((kind, width, (5 * kind + 3 * i) % 9, 4 if kind else 6) for i, width in enumerate((2, 4, 8, SPAN)) for kind in range(4))


def frames_of_sound(samples: np.ndarray, rate: int, size: int = 4096, hop: int = 1365, low: float = 28, high: float = 3520) -> np.ndarray:
    """Pitch-class energies (frames, 12), A = 0, of mono samples."""
    if len(samples) < size:
        samples = np.pad(samples, (0, size - len(samples)))
    windows = np.lib.stride_tricks.sliding_window_view(samples, size)[::hop] * np.hanning(size)
    power = np.abs(np.fft.rfft(windows, axis=1)) ** 2
    hertz = np.fft.rfftfreq(size, 1 / rate)
    used = np.flatnonzero((hertz >= low) & (hertz <= high))
    pitch = np.rint(12 * np.log2(hertz[used] / 440)).astype(int) % 12
    out = np.zeros((len(windows), 12))
    for p in range(12):
        out[:, p] = power[:, used[pitch == p]].sum(axis=1)
    return out


def frames_of_text(text: str) -> np.ndarray:
    """Pitch-class energies (frames, 12) of a text read as a score."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    if not len(codes):
        return np.zeros((0, 12))
    blank = (codes == 32) | (codes == 10)
    starts = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    if not len(starts):
        return np.zeros((0, 12))
    sums = np.add.reduceat(np.where(blank, 0, codes * codes), starts)
    onset = np.zeros(len(codes), np.int64)
    onset[starts[sums % BEAT == 0]] = 1
    frame = np.cumsum(onset)
    heard = np.flatnonzero(~blank)
    frame -= frame[heard[0]]
    n = int(frame[-1]) + 1
    return np.bincount(frame[heard] * 12 + codes[heard] % 12, minlength=12 * n).reshape(n, 12).astype(float)


def integers(frames: np.ndarray) -> np.ndarray:
    """A 32-bit integer for each window of SPAN frames."""
    if not len(frames):
        return np.zeros(0, np.uint32)
    if len(frames) < SPAN:
        frames = np.concatenate([frames, np.zeros((SPAN - len(frames), 12))])
    image = np.zeros((len(frames) + 1, 13))
    image[1:, 1:] = np.cumsum(np.cumsum(frames / np.maximum(frames.sum(axis=1, keepdims=True), 1e-12), axis=0), axis=1)
    n = len(frames) - SPAN + 1

    def area(t0: int, t1: int, p0: int, p1: int) -> np.ndarray:
        return image[t1 : t1 + n, p1] - image[t0 : t0 + n, p1] - image[t1 : t1 + n, p0] + image[t0 : t0 + n, p0]

    out = np.zeros(n, np.uint32)
    for kind, width, pitch, height in FILTERS:
        pitch = min(pitch, 12 - height)
        half, middle, whole = width // 2, pitch + height // 2, area(0, width, pitch, pitch + height)
        if kind == 0:  # later against earlier
            part = area(half, width, pitch, pitch + height)
        elif kind == 1:  # upper against lower
            part = area(0, width, middle, pitch + height)
        elif kind == 2:  # one diagonal against the other
            part = area(0, half, pitch, middle) + area(half, width, middle, pitch + height)
        else:  # the inner pitches against the outer ones
            part = area(0, width, pitch + 1, pitch + height - 1)
        level = np.searchsorted(EDGES, np.log((0.05 + np.maximum(part, 0)) / (0.05 + np.maximum(whole - part, 0))), "right").astype(np.uint32)
        out = (out << np.uint32(2)) | (level ^ (level >> np.uint32(1)))
    return out


def packed(frames: np.ndarray) -> tuple[bytes, bytes]:
    """Little-endian integers, and those of the places after them at which a mark's filters still fit."""
    if not len(frames):
        return b"", b""
    more = integers(np.concatenate([frames, np.zeros((SPAN - SHORT, 12))])).astype("<u4").tobytes()
    n = 4 * max(1, len(frames) - SPAN + 1)
    return more[:n], more[n:]


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing of whole numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def landmarks(ints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys, in order, and places of all marks; few integers are one mark."""
    if not len(ints):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    bits = 2 * MARKED
    own = ints.astype(np.uint64) if len(ints) < RUN else ints.astype(np.uint64) >> np.uint64(32 - bits)  # FILTERS' first bits are the highest
    n = max(1, len(ints) - RUN + 1)
    keys = np.full(n, min(len(ints), RUN), np.uint64)
    for k in range(min(len(ints), RUN)):
        keys = mixed(keys * np.uint64(0xD6E8FEB86659FD93) + own[k : k + n])
    at = np.argsort(keys, kind="stable")
    return keys[at], at


def columns(mine: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (places in the other less places here) and votes of all pairs of places with equal keys."""
    (keys, places), (other_keys, other_places) = mine, other
    lo, hi = (np.searchsorted(other_keys, keys, side) for side in ("left", "right"))
    n = hi - lo
    common, first, size = np.unique(keys[n > 0], return_index=True, return_counts=True)
    first = np.flatnonzero(n > 0)[first]
    many = size * n[first] > PLAIN
    n[np.isin(keys, common[many])] = 0
    i = np.repeat(np.arange(len(keys)), n)
    j = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
    offsets, votes = np.unique(other_places[j] - places[i], return_counts=True)
    if many.any():
        x, y = int(places.max()) + 1, int(other_places.max()) + 1
        width, sums = 1 << (x + y).bit_length(), np.zeros(x + y)
        for f, m in zip(first[many], size[many], strict=True):  # all pairs of a frequent key's places at once
            back = np.bincount(x - 1 - places[f : f + m], minlength=x)
            ahead = np.bincount(other_places[lo[f] : hi[f]], minlength=y)
            sums += np.rint(np.fft.irfft(np.fft.rfft(back, width) * np.fft.rfft(ahead, width), width))[: x + y]
        np.add.at(sums, offsets + x - 1, votes)
        at = np.flatnonzero(sums)
        offsets, votes = at - (x - 1), sums[at].astype(np.int64)
    return offsets, votes


def fingerprints(docs: DataFrame) -> DataFrame:
    """(row, doc_id, n_frames, ints, rest): packed integers of each text; row is its place in the table."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 33
        for b in batches:
            frames = [frames_of_text(t or "") for t in b.column(1).to_pylist()]
            ints, rest = zip(*map(packed, frames), strict=True) if frames else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(at, at + b.num_rows)), b.column(0), pa.array([len(f) for f in frames], pa.int64()), pa.array(ints, pa.binary()), pa.array(rest, pa.binary())], ["row", "doc_id", "n_frames", "ints", "rest"])
            at += b.num_rows

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "row long, doc_id long, n_frames long, ints binary, rest binary")


MESSAGE = [("bucket", pa.int32()), ("asks", pa.bool_()), ("block", pa.int64()), ("body", pa.binary())]
MESSAGE_SQL = "bucket int, asks boolean, block long, body binary"


def marks(prints: DataFrame, asks: bool, n_buckets: int) -> DataFrame:
    """To each bucket of keys the marks of blocks of recordings: keys in order, and their rows.

    Of equal recordings in a block the one with the smallest row speaks, in whatever order they are read: a class goes
    by its smallest row, so the block that holds that one always sends the class's marks under it.
    """

    def block(number: int, rows: list[int], found: list[np.ndarray]) -> pa.RecordBatch:
        keys, who = np.concatenate(found), np.repeat(np.arange(len(rows)), [len(k) for k in found])
        order = np.argsort(keys, kind="stable")
        keys, who = keys[order], who[order]
        at = np.searchsorted(((keys >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int64), np.arange(n_buckets + 1))
        out = []
        for k in np.flatnonzero(np.diff(at)).tolist():
            own, mine = np.unique(who[at[k] : at[k + 1]], return_inverse=True)
            out.append((k, asks, number, squeeze((ascending(keys[at[k] : at[k + 1]]), planes(mine.astype("<u4")), np.array(rows, np.int64)[own]))))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out, strict=True) if out else [()] * len(MESSAGE), MESSAGE, strict=True)], [n for n, _ in MESSAGE])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        number, rows, found, room, seen = TaskContext.get().partitionId() << 32, [], [], BLOCK_MARKS, {}
        for b in batches:
            for row, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                at = seen.setdefault(xxhash.xxh3_128_digest(x), len(rows))
                if at < len(rows):
                    rows[at] = min(rows[at], row)
                    continue
                rows.append(row)
                found.append(np.unique(landmarks(np.frombuffer(x, "<u4"))[0]))
                room -= len(found[-1])
                if room <= 0:
                    yield block(number, rows, found)
                    number, rows, found, room, seen = number + 1, [], [], BLOCK_MARKS, {}
        if rows:
            yield block(number, rows, found)

    return prints.select("row", F.concat("ints", "rest").alias("ints")).mapInArrow(run, MESSAGE_SQL)


def distinct(rows: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of rows and queries, each once and in order."""
    order = np.lexsort((queries, rows))
    rows, queries = rows[order], queries[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (queries[1:] != queries[:-1])
    return rows[new], queries[new]


def met(table: pa.Table) -> pa.Table:
    """A bucket's marks to one message for each block of recordings: its pairs (row, query_row) that share one."""
    sides: dict[bool, list] = {False: [], True: []}
    for r in table.to_pylist():
        keys, who, rows = expand(r["body"])
        sides[r["asks"]].append((from_ascending(*keys), rows[from_planes(*who)], r["block"]))
    out = []
    if sides[True]:
        keys, rows = (np.concatenate(x) for x in list(zip(*sides[True], strict=True))[:2])
        order = np.argsort(keys, kind="stable")
        keys, rows = keys[order], rows[order]
        for own, row, block in sides[False]:
            lo, hi = (np.searchsorted(keys, own, side) for side in ("left", "right"))
            n = hi - lo
            i = np.repeat(np.arange(len(own)), n)
            if len(i):
                left, right = distinct(row[i], rows[np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)])
                out.append((block, squeeze((ascending(left.view(np.uint64)), planes(right)))))
    return pa.Table.from_arrays([pa.array([b for b, _ in out], pa.int64()), pa.array([x for _, x in out], pa.binary())], ["block", "body"])


def gathered(table: pa.Table) -> pa.Table:
    """A block's messages from all buckets to (row, queries), each pair once."""
    held, n = [(np.zeros(0, np.int64), np.zeros(0, np.int64))], 0
    for body in table.column("body").to_pylist():
        left, right = expand(body)
        held.append((from_ascending(*left).view(np.int64), from_planes(*right)))
        n += len(held[-1][0])
        if n > HELD_PAIRS:
            held, n = [distinct(*(np.concatenate(x) for x in zip(*held, strict=True)))], 0
    left, right = distinct(*(np.concatenate(x) for x in zip(*held, strict=True)))
    rows, first = np.unique(left, return_index=True)
    return pa.Table.from_arrays([pa.array(rows), pa.ListArray.from_arrays(pa.array(np.append(first, len(left)), pa.int32()), pa.array(right))], ["row", "queries"])


def queries_met(prints: DataFrame, asking: DataFrame) -> DataFrame:
    """(row, queries): for each row that shares a mark with a query, the rows of all those queries."""
    frames = prints.agg(F.sum("n_frames")).first()[0] or 0
    n = max(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")), frames // BUCKET_MARKS)
    told = by_bucket(marks(prints, False, n).union(marks(asking, True, n)), n).groupBy("bucket").applyInArrow(met, "block long, body binary")
    return told.groupBy("block").applyInArrow(gathered, "row long, queries array<bigint>")


def candidates(prints: DataFrame, asking: DataFrame) -> DataFrame:
    """(row, query_row) of all pairs that share a mark, one by one."""
    return queries_met(prints, asking).select("row", F.explode("queries").alias("query_row"))


def alignment(mine: bytes, other: bytes, marks_of=lambda b: landmarks(np.frombuffer(b, "<u4"))) -> tuple[int, int, float] | None:
    """Offset, votes and bit error rate over the overlap of two recordings, of both parts of their packed() integers."""
    left, right = marks_of(mine), marks_of(other)
    offsets, votes = columns(left, right)
    sums = np.concatenate([[0], np.cumsum(votes)])
    close = sums[np.searchsorted(offsets, offsets + DRIFT, "right")] - sums[np.searchsorted(offsets, offsets - DRIFT, "left")]
    good = np.flatnonzero(close >= min(LEAST, len(left[0]), len(right[0])))
    if not len(good):
        return None
    best = good[np.lexsort((offsets[good], -close[good], -votes[good]))[0]]
    offset = int(offsets[best])
    x, y = (np.frombuffer(b, "<u4")[: max(1, len(b) // 4 - SPAN + SHORT)] for b in (mine, other))
    x, y = x[max(0, -offset) :], y[max(0, offset) :]
    n = min(len(x), len(y))
    return offset, int(votes[best]), float(np.bitwise_count(x[:n] ^ y[:n]).sum()) / (32 * n) if n else 1.0


LISTED = ("query_row", "one", "two", "offset", "votes", "bit_error_rate")
LISTED_SQL = "array<struct<query_row: bigint, one: bigint, two: bigint, offset: bigint, votes: bigint, bit_error_rate: double>>"


def aligned(table: pa.Table) -> pa.Table:
    """A part of the recordings and a block of queries to (row, listed): each recording's alignments with those of its queries that are in the block."""
    mine = pa.compute.is_valid(table.column("queries"))
    asking = {r["row"]: r for r in table.filter(pa.compute.invert(mine)).to_pylist()}
    known = {r["ints"]: landmarks(np.frombuffer(r["ints"], "<u4")) for r in asking.values()}
    last = functools.lru_cache(1)(lambda b: landmarks(np.frombuffer(b, "<u4")))
    rows, listed = [], []
    for batch in table.filter(mine).to_batches(max_chunksize=ROWS_PER_BATCH):
        for r in batch.to_pylist():
            found = [(q, alignment(r["ints"], asking[q]["ints"], lambda b: known[b] if b in known else last(b))) for q in r["queries"]]
            if own := [dict(zip(LISTED, (q, asking[q]["one"], asking[q]["two"], *x), strict=True)) for q, x in found if x]:
                rows.append(r["row"])
                listed.append(own)
    kind = pa.list_(pa.struct([(c, pa.float64() if c == "bit_error_rate" else pa.int64()) for c in LISTED]))
    return pa.Table.from_arrays([pa.array(rows, pa.int64()), pa.array(listed, kind)], ["row", "listed"])


def alignments(prints: DataFrame, lists: DataFrame, asking: DataFrame) -> DataFrame:
    """(row, listed): the alignments of the rows of lists (row, queries) with their queries, of asking (one, two and the columns of prints).

    Queries lie in blocks, and parts of the recordings meet each block in a task. A recording goes once to each
    block that holds a query of its list, and a block once to each part.
    """
    size = 4 * (asking.agg(F.sum("n_frames")).first()[0] or 0)
    blocks = max(1, -(-size // QUERY_BYTES))
    pairs = lists.agg(F.sum(F.size("queries"))).first()[0] or 0
    parts = max(1, -(-pairs // (blocks * max(PART_PAIRS, size // blocks // COPY_BYTES))))
    none, ints = F.lit(None).cast("long"), F.concat("ints", "rest").alias("ints")

    def block(row: Column) -> Column:
        return F.pmod(F.xxhash64(row), F.lit(blocks)).cast("int")

    spread = lists if blocks == 1 else lists.select("row", "queries", F.explode(F.array_distinct(F.transform("queries", block))).alias("block"))
    if blocks > 1:
        spread = spread.withColumn("queries", F.filter("queries", lambda q: block(q) == F.col("block")))
    at = F.pmod(F.xxhash64(F.lit(1), "row"), F.lit(parts)).cast("int") + (F.col("block") * parts if blocks > 1 else 0)
    mine = prints.select("row", ints).join(spread.withColumn("bucket", at), "row").select("bucket", "row", "ints", "queries", none.alias("one"), none.alias("two"))
    each = asking.select("row", ints, "one", "two", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    theirs = each.select((block(F.col("row")) * parts + F.col("part")).alias("bucket"), "row", "ints", F.lit(None).cast("array<bigint>").alias("queries"), "one", "two")
    found = by_bucket(mine.union(theirs), blocks * parts).groupBy("bucket").applyInArrow(aligned, f"row long, listed {LISTED_SQL}")
    return found if blocks == 1 else found.groupBy("row").agg(F.flatten(F.collect_list("listed")).alias("listed"))


def align(docs: DataFrame, query: int = QUERY) -> DataFrame:
    """Every document's frames, class and alignments with the queries."""
    prints, same = materialize(fingerprints(docs), "chroma"), ["digest", "ints_crc32"]
    short = prints.select("row", "doc_id", "n_frames", F.xxhash64("ints", "rest").alias("digest"), F.crc32("ints").alias("ints_crc32"))
    classes = short.groupBy(*same).agg(F.min("doc_id").alias("class_id"), F.min("row").alias("class_row"))
    # The smallest query of each class, and the smallest but that one for its own row.
    asked = short.where(F.col("doc_id").isNotNull() & (F.col("doc_id") % query == 0) & (F.col("n_frames") > 0)).select(F.struct("doc_id", "row").alias("q"), *same)
    one = asked.groupBy(*same).agg(F.min("q").alias("one"))
    two = asked.join(one, same).where("q <> one").groupBy(*same).agg(F.min("q").alias("two"))
    queries = materialize(one.join(two, same, "left").select(F.col("one.row").alias("query_row"), "one", "two"), "queries")
    asking = materialize(prints.join(queries.select(F.col("query_row").alias("row"), F.col("one.doc_id").alias("one"), F.col("two.doc_id").alias("two")), "row"), "asking")
    lists = materialize(queries_met(prints, asking).join(classes.select(F.col("class_row").alias("row")), "row", "left_semi"), "asked")
    listed = alignments(prints, lists, asking)
    named = classes.join(materialize(listed.withColumnRenamed("row", "class_row"), "alignments"), "class_row", "left").drop("class_row")

    def mine(x: Column) -> Column:
        who = F.when(x["query_row"] == F.col("row"), x["two"]).otherwise(x["one"])
        return F.struct((-x["votes"]).alias("less"), who.alias("query_id"), x["offset"].alias("offset"), x["bit_error_rate"].alias("bit_error_rate"))

    def told(x: Column) -> Column:
        return F.struct(x["query_id"].alias("query_id"), x["offset"].alias("offset"), (-x["less"]).alias("votes"), x["bit_error_rate"].alias("bit_error_rate"))

    ranked = F.array_sort(F.filter(F.transform("listed", mine), lambda x: x["query_id"].isNotNull()))
    out = short.join(named, same, "left").withColumn("alignments", F.coalesce(F.transform(ranked, told), F.array().cast("array<struct<query_id:bigint,offset:bigint,votes:bigint,bit_error_rate:double>>")))
    best = F.get("alignments", F.lit(0))
    return out.select("doc_id", "n_frames", "ints_crc32", "class_id", *(best[c].alias(c) for c in ("query_id", "offset", "votes", "bit_error_rate")), F.to_json("alignments").alias("alignments"))


def op1_chroma(spark, sf_dir: str) -> DataFrame:
    """Every document's chroma fingerprint and its alignments with the queries."""
    return align(load(spark, sf_dir, "documents"))
