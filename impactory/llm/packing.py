"""Concatenate and cut: all documents as one token stream, cut into windows of a fixed length.

Two passes. The first tokenizes each document once and keeps its ids with its place among the tokens
of its task; the totals of the tasks, one number each, are summed up to give each task its global
offset. The second cuts every document where the stream crosses a window; a document that spans
windows leaves a record for each of them. Only the last window can need padding.

The stream's order is that of the tasks and of the rows in them. Both passes read the written ids of
the first, so a lost executor changes nothing.

Ids are those of the tokenizers library for the vocabulary file, found faster: pieces that the
vocabulary's splitting always cuts are encoded once each. The tests hold them against the library.

Rows: a null or empty text is its end token alone; a very long text spans as many windows as it takes; a
null id stays null; repeated rows are packed again (there are no ties to break); an empty table gives no rows. Only doc_id and text are read, so clashing names don't matter.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import load, materialize, small_batches, small_tables

WINDOW, END = 2048, 1
CACHE = 900_000
#: Totals summed in one step of the prefix sums.
FAN = 4096
MARK = "\x00"
#: White space before a blank: such texts are encoded whole. The second pattern is for those beyond ASCII.
BEFORE_BLANK = ("  ", "\n ", "\t ", "\r ", "\x0b ", "\x0c ")
BEFORE_BLANK_WIDE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000] ")
#: Punctuation that may follow a word; a word that ends in a letter below LATIN_END splits from it.
AFTER_WORD, LATIN_END = ".,!?;:*$%&#", "\u0250"


def byte_chars() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary, by its rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteEncoder:
    """Ids of a byte-level vocabulary file as packed unsigned integers, with a cache of short pieces.

    Text is cut before blanks that follow something else, where the vocabulary's own splitting always
    cuts. A piece that isn't known yet is cut further, around a line end between other characters and
    between a word and the punctuation after it, and else encoded as it stands.
    """

    def __init__(self, path: str):
        import tiktoken
        from public_tokenizers import PATTERN

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        chars = byte_chars()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(chars[c] for c in k): v for k, v in spec["model"]["vocab"].items() if k not in special}
        enc = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.whole = lambda text: np.array(enc.encode(text, allowed_special="all"), "<u4").tobytes()
        single = enc._encode_single_piece  # for what the pattern leaves in one piece
        self.special = list(special)
        whole = self.whole

        class Pieces(dict):
            def __missing__(self, piece: str) -> bytes:
                left, line, right = piece.partition("\n")
                stem = piece.rstrip(AFTER_WORD)
                if line and left and right and not left[-1].isspace() and not right[0].isspace():
                    out = self[left] + self[line] + self[right]
                elif len(stem) > 1 and stem != piece and stem[-1].isalpha() and stem[-1] < LATIN_END:
                    out = self[stem] + self[piece[len(stem) :]]
                elif (word := piece[piece[0] == " " :]).isalpha() and max(word) < LATIN_END:
                    out = array("I", single(piece)).tobytes()
                else:
                    out = whole(piece)
                self[piece] = out
                return out

        self.pieces = Pieces()

    def encode(self, text: str) -> bytes:
        if MARK in text or any(x in text for x in self.special) or any(x in text for x in BEFORE_BLANK):
            return self.whole(text)
        if not text.isascii() and BEFORE_BLANK_WIDE.search(text):
            return self.whole(text)
        if len(self.pieces) > CACHE:
            self.pieces.clear()
        parts = text.replace(" ", MARK + " ").split(MARK)
        return b"".join(map(self.pieces.__getitem__, parts if parts[0] else parts[1:]))


def tokenize(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, part, start, n, ids): ids with the end token, little-endian 32 bits; start counts the tokens before it in its task."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, before, end = ByteEncoder(path), TaskContext.get().partitionId(), 0, np.array([END], "<u4").tobytes()
        for b in batches:
            ids = [(encoder.encode(t) if t else b"") + end for t in b.column(1).to_pylist()]
            n = np.array([len(x) // 4 for x in ids], np.int64)
            starts = before + np.cumsum(n) - n
            before += int(n.sum())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.full(len(n), part, np.int32)), pa.array(starts), pa.array(n), pa.array(ids, pa.binary())], ["doc_id", "part", "start", "n", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, part int, start long, n long, ids binary")


def offsets(tokens: DataFrame) -> DataFrame:
    """(part, base): the tokens before each task, by prefix sums within blocks of FAN tasks and over the blocks."""
    totals = tokens.groupBy("part").agg(F.max(F.col("start") + F.col("n")).alias("total")).withColumn("block", F.expr(f"part div {FAN}"))
    inner = totals.withColumn("inner", F.coalesce(F.sum("total").over(Window.partitionBy("block").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    blocks = totals.groupBy("block").agg(F.sum("total").alias("total"))
    outer = blocks.select("block", F.coalesce(F.sum("total").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("outer"))
    return inner.join(outer, "block").select("part", (F.col("inner") + F.col("outer")).alias("base"))


def pack(tokens: DataFrame, window: int = WINDOW) -> DataFrame:
    """Cut written tokens into windows: a row per piece, with its ids."""
    base = F.broadcast(offsets(tokens))  # one row of two numbers for each task of the first pass
    at = tokens.join(base, "part").withColumn("g", F.col("base") + F.col("start"))
    each = at.withColumn("sequence_id", F.explode(F.sequence(F.expr(f"g div {window}"), F.expr(f"(g + n - 1) div {window}"))))
    lo, hi = F.greatest(F.col("g"), F.col("sequence_id") * window), F.least(F.col("g") + F.col("n"), (F.col("sequence_id") + 1) * window)
    cut = each.withColumn("start", lo - F.col("g")).withColumn("length", hi - lo).withColumn("offset", lo - F.col("sequence_id") * window)
    return cut.select("doc_id", "start", "length", F.col("n").alias("doc_tokens"), "sequence_id", "offset", F.expr("substring(ids, int(start * 4 + 1), int(length * 4))").alias("ids"))


def packed(docs: DataFrame, path: str) -> DataFrame:
    """Documents (doc_id, text) to the digest columns of their pieces."""
    pieces = pack(materialize(tokenize(docs, path), "tokens"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op2_packing(spark, sf_dir: str) -> DataFrame:
    """Every document packed into windows of 2048 tokens."""
    return packed(load(spark, sf_dir, "documents"), vocabulary())


def pack_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The last pipeline stage: a row per piece of a document."""
    small_tables(spark)
    return packed(docs, vocabulary())
