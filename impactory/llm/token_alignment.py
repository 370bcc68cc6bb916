"""Alignment of two tokenizers' tokens over the same bytes, by pointer jumping.

Every text is encoded with a blank before it, by a byte-level vocabulary (A) and a piece vocabulary (B,
which adds the blank itself). Each token points to its farthest-right overlapping token of the other
side, if that one ends later; of two that end together A's points to B's. Doubling, `next = next[next]`,
repeated until nothing changes, brings every token to the last one of its component, which labels its group. It runs on
whole arrays: all tokens of all texts of a batch at once.

Both vocabularies always cut before a single blank that follows something else, so a text is a list of units (a blank
and a word), each aligned once per task; texts where that isn't certain (blanks in a row, the mark of B's blanks,
names of special tokens) are units as they stand.

Corpus counts: documents are written in blocks: the block's distinct id pairs with their counts, and its documents packed.
Pairs are summed over blocks, each with the highest count of its B id beside it, and come back to
each block that holds them; no table is sent to all tasks. A pair occurs once per block there, however
many documents hold it. Answers of a block are as many as its distinct pairs, which its text bounds.

Rows: null and empty texts, and those whose tokens' bytes don't give the text back, have no tokens: zeros and an
empty string. Very long texts are a block of their own; ties for the highest count are all best; repeated rows count
again; null ids stay null; an empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import expand, load, materialize, planes, from_planes, small_batches, squeeze
from .packing import byte_chars

#: Characters of text in a block of documents, about (a text is never divided), units kept at once, and an id's bits.
BLOCK_CHARS, CACHE, ID_BITS = 6_000_000, 250_000, 32
#: Units that are encoded as one line.
LINE = 2000
#: The mark of a blank in B's pieces, and the white space that makes a text one unit where a blank follows it.
MARK = "▁"
BEFORE_BLANK = re.compile(r"\s ")


def successors(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """Where each token points, A's first and then B's: its farthest-right overlapping token, itself if none ends later."""
    n = len(a_ends)
    over_a, over_b = np.searchsorted(b_ends, a_ends), np.searchsorted(a_ends, b_ends)
    of_a = n + over_a  # B's token over the last byte ends there or later
    later = a_ends[over_b] > b_ends
    return np.concatenate([of_a, np.where(later, over_b, n + np.arange(len(b_ends)))])


def terminals(nxt: np.ndarray) -> np.ndarray:
    """Each token's last reachable one, by doubling."""
    while True:
        again = nxt[nxt]
        if np.array_equal(again, nxt):
            return nxt
        nxt = again


class Vocabularies:
    """Both tokenizers: ids of a unit, and the bytes of each id."""

    def __init__(self, path_a: str, path_b: str):
        import json

        import sentencepiece
        import tiktoken
        from public_tokenizers import PATTERN

        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        chars = byte_chars()
        self.special = [t["content"] for t in spec["added_tokens"]]
        ranks = {bytes(chars[c] for c in k): v for k, v in spec["model"]["vocab"].items() if k not in self.special}
        self.a = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_a = dict((v, k) for k, v in ranks.items())
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.len_a = np.zeros(max(ranks.values()) + 1, np.int64)
        self.len_a[list(self.bytes_a)] = [len(x) for x in self.bytes_a.values()]
        self.len_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.cuts = not any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces)  # no piece goes on after a blank

    def units(self, text: str) -> list[str]:
        """The text's units, each without its first blank."""
        odd = not self.cuts or MARK in text or any(s in text for s in self.special)
        if odd or text[0] == " " or text[-1] == " " or BEFORE_BLANK.search(text):
            return [text]
        return text.split(" ")

    def encode(self, units: list[str]) -> tuple[list[int], list[int]]:
        """Ids of a line of units by A and by B."""
        text = " ".join(units)
        return self.a.encode_ordinary(" " + text), self.b.encode(text, num_threads=1)

    def agree(self, ids_a: list[int], ids_b: list[int], units: list[str]) -> bool:
        """Whether both give the units' bytes."""
        whole = (" " + " ".join(units)).encode("utf-8", "surrogatepass")
        return b"".join(map(self.bytes_a.__getitem__, ids_a)) == whole == b"".join(map(self.bytes_b.__getitem__, ids_b))


class Aligned:
    """Aligned units: (number of A's tokens, of B's, the groups as text, the linked pairs), None where bytes differ."""

    def __init__(self, path_a: str, path_b: str):
        self.v, self.known = Vocabularies(path_a, path_b), {}

    def learn(self, units: list[str]) -> None:
        """Align units: those that are cut from texts in lines of many, whole texts and what doesn't give its bytes alone."""
        plain, lines = [u for u in units if self.plain(u)], [[u] for u in units if not self.plain(u)]
        lines = [plain[k : k + LINE] for k in range(0, len(plain), LINE)] + lines
        while lines:
            done: list[tuple[list[str], list[int], list[int]]] = []
            for line in lines:
                ids_a, ids_b = self.v.encode(line)
                if self.v.agree(ids_a, ids_b, line):
                    done.append((line, ids_a, ids_b))
                elif len(line) == 1:
                    self.known[line[0]] = None
            ended = {id(line) for line, *_ in done}
            lines = [[u] for line in lines if len(line) > 1 and id(line) not in ended for u in line]
            if done:
                self.align(done)

    @staticmethod
    def plain(unit: str) -> bool:
        """Whether a unit may stand in a line: no blanks in it, and no white space before the next one's."""
        return bool(unit) and " " not in unit and not unit[-1].isspace()

    def align(self, lines: list[tuple[list[str], list[int], list[int]]]) -> None:
        """Groups of all lines at once. Units end together, so one row of bytes will do."""
        units = [u for line, *_ in lines for u in line]
        ids_a, ids_b = (np.concatenate([np.array(x[k], np.int64) for x in lines]) for k in (1, 2))
        ends_a, ends_b = np.cumsum(self.v.len_a[ids_a]), np.cumsum(self.v.len_b[ids_b])
        label = terminals(successors(ends_a, ends_b)) - len(ids_a)  # a group's name: its last token of B
        last_a = np.flatnonzero(np.diff(label[: len(ids_a)], append=-1))
        last_b = np.flatnonzero(np.diff(label[len(ids_a) :], append=-1))
        pairs = ids_a[last_a] << ID_BITS | ids_b[last_b]
        text_a, text_b = list(map(str, ids_a.tolist())), list(map(str, ids_b.tolist()))
        groups, i, j = [], 0, 0
        for x, y in zip((last_a + 1).tolist(), (last_b + 1).tolist(), strict=True):
            groups.append(f"{text_a[i]}|{text_b[j]}" if x - i == y - j == 1 else f"{','.join(text_a[i:x])}|{','.join(text_b[j:y])}")
            i, j = x, y
        ends = np.cumsum([len(u.encode("utf-8", "surrogatepass")) + 1 for u in units])
        n_a, n_b = (np.diff(np.searchsorted(e, ends) + 1, prepend=0).tolist() for e in (ends_a, ends_b))
        first = 0
        for u, a, b, bound in zip(units, n_a, n_b, (np.searchsorted(ends_b[last_b], ends) + 1).tolist(), strict=True):
            self.known[u] = (a, b, ";".join(groups[first:bound]), pairs[first:bound])
            first = bound


_ALIGNED: dict[tuple[str, str], Aligned] = {}
BLOCK = "block long, pairs array<long>, counts array<long>, body binary"
DIGEST = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
GROUPS = "doc_id long, n_a long, n_b long, n_groups long, groups string"


def _aligned(paths: tuple[str, str]) -> Aligned:
    if paths not in _ALIGNED:
        _ALIGNED[paths] = Aligned(*paths)
    return _ALIGNED[paths]


def _split(aligned: Aligned, texts: list[str | None]) -> list[list[str]]:
    """The units of texts, all of them known afterwards."""
    if len(aligned.known) > CACHE:
        aligned.known.clear()
    split = [aligned.v.units(t) if t else [] for t in texts]
    new = {u for units in split for u in units} - aligned.known.keys()
    if new:
        aligned.learn(sorted(new))
    return split


def _packed(aligned: Aligned, ids: list, texts: list[str | None], block: int) -> pa.RecordBatch:
    """A block of documents: its pairs with their counts, and, packed, each document's units as numbers with what those hold."""
    split = _split(aligned, texts)
    names = list({u: None for units in split for u in units})
    number = {u: i for i, u in enumerate(names)}
    got = [aligned.known[u] for u in names]
    bad = np.array([g is None for g in got], bool)
    none = (0, 0, "", np.zeros(0, np.int64))
    got = [g or none for g in got]
    size = np.array([len(g[3]) for g in got], np.int64)
    pairs, at = np.unique(np.concatenate([g[3] for g in got] or [none[3]]), return_inverse=True)
    rows, sha = [], []
    for units in split:
        row = np.fromiter(map(number.__getitem__, units), np.int32, len(units))
        row = row[:0] if bad[row].any() else row
        rows.append(row)
        sha.append(hashlib.sha256(";".join([got[i][2] for i in row.tolist()]).encode()).hexdigest() if len(row) else "")
    all_rows = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    times = np.bincount(all_rows, minlength=len(names))
    counts = np.bincount(at, np.repeat(times, size), len(pairs)).astype(np.int64)
    held = counts > 0  # units of texts without tokens link nothing
    kept = np.cumsum(held) - 1
    linked = np.repeat(times > 0, size)
    size = np.where(times > 0, size, 0)
    body = squeeze((ids, sha, [len(r) for r in rows], planes(all_rows), [g[0] for g in got], [g[1] for g in got], size, planes(kept[at[linked]].astype(np.int32))), 6)
    return pa.RecordBatch.from_pydict({"block": [block], "pairs": [pairs[held]], "counts": [counts[held]], "body": [body]}, pa.schema([("block", pa.int64()), ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("body", pa.binary())]))


def blocked(paths: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligned, part, k, ids, texts, room = _aligned(paths), TaskContext.get().partitionId(), 0, [], [], BLOCK_CHARS
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids.append(doc_id)
                texts.append(text)
                room -= len(text or "")
                if room <= 0:
                    yield _packed(aligned, ids, texts, part << 32 | k)
                    ids, texts, room, k = [], [], BLOCK_CHARS, k + 1
        if ids:
            yield _packed(aligned, ids, texts, part << 32 | k)

    return run


def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with the corpus counts of their pairs, in the pairs' order, to a row per document."""
    for b in batches:
        for body, told in zip(b.column("body"), b.column("told"), strict=True):
            ids, sha, lengths, rows, n_a, n_b, size, links = expand(body.as_py())
            rows, links = from_planes(*rows).astype(np.int64), from_planes(*links)
            told = told.values.flatten() if told.is_valid else []
            n, best = (told[1].to_numpy(), told[2].to_numpy(zero_copy_only=False)) if len(told) else (np.zeros(0, np.int64), np.zeros(0, bool))
            unit = np.repeat(np.arange(len(size)), size)
            sums = [np.asarray(n_a), np.asarray(n_b), size, np.bincount(unit, best[links], len(size)), _summed(unit, n[links], len(size))]
            doc = np.repeat(np.arange(len(ids)), lengths)
            columns = [_summed(doc, s.astype(np.int64)[rows], len(ids)) for s in sums]
            a, bb, groups, is_best, total = (pa.array(c, pa.int64()) for c in columns)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), a, bb, groups, groups, is_best, total, pa.array(sha, pa.string())], [x.split()[0] for x in DIGEST.split(", ")])


def _summed(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Exact sums of whole numbers by place; places ascend."""
    totals = np.concatenate([np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)])
    ends = np.searchsorted(at, np.arange(n), side="right")
    return totals[ends] - totals[np.concatenate([np.zeros(1, np.int64), ends[:-1]])] if n else totals[:0]


def _texts(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def groups(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, groups): the groups of each document as `a1,a2|b1;a3|b2,b3`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligned = _aligned((path_a, path_b))
        for b in batches:
            out = []
            for units in _split(aligned, b.column(1).to_pylist()):
                got = [aligned.known[u] for u in units]
                got = [] if None in got else got
                out.append((sum(g[0] for g in got), sum(g[1] for g in got), sum(len(g[3]) for g in got), ";".join(g[2] for g in got)))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([x[i] for x in out], pa.int64()) for i in range(3)), pa.array([x[3] for x in out], pa.string())], [x.split()[0] for x in GROUPS.split(", ")])

    return _texts(docs).mapInArrow(run, GROUPS)


def pair_counts(told: DataFrame) -> DataFrame:
    """(pair, n, best): how many links hold an id pair, and whether that is its B id's highest count."""
    counts = told.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("b", F.col("pair").bitwiseAND(2**ID_BITS - 1))
    top = counts.groupBy("b").agg(F.max("n").alias("top"))
    return counts.join(top, "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def alignment(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Documents (doc_id, text) to their numbers of tokens, groups and links, and how common those are."""
    blocks = materialize(_texts(docs).mapInArrow(blocked((path_a, path_b)), BLOCK), "blocks")
    told = blocks.select("block", F.explode(F.arrays_zip(F.col("pairs").alias("pair"), F.col("counts").alias("n"))).alias("x")).select("block", F.col("x.pair").alias("pair"), F.col("x.n").alias("n"))
    known = materialize(pair_counts(told), "pairs")
    answers = told.select("block", "pair").join(known, "pair").groupBy("block").agg(F.array_sort(F.collect_list(F.struct("pair", "n", "best"))).alias("told"))
    return blocks.select("block", "body").join(answers, "block", "left").select("body", "told").mapInArrow(answered, DIGEST)


def op12_token_alignment(spark, sf_dir: str) -> DataFrame:
    """Every document's tokens of two vocabularies, aligned."""
    import public_tokenizers

    return alignment(load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
