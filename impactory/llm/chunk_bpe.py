"""Byte-pair encoding and decoding with reuse of content-defined chunks.

A rolling hash over the last 16 characters cuts each text where it hits a pattern, so that equal
passages in different documents yield equal chunks. Chunks meet by digest, and each distinct one is
encoded once, whatever number of documents hold it. A chunk is encoded between its first and its last
blank; what lies outside of them depends on its neighbours. When a document is put together again the
open ends of adjoining chunks are joined and encoded anew, on to the next chunk while there is no
blank in it, so that the result agrees exactly with an encoding of the whole text: blanks and line
ends bound the vocabulary's words, and nothing merges across them.

Data moves in blocks: each block of documents sends its distinct chunks, grouped by digest bucket, in
one compressed block per bucket; the bucket's task returns one block of ids per batch. A chunk that
very many documents share is thus sent at most once per batch. Nothing is collected.

Rows: null and empty texts have no ids and decode to the empty text; very long texts are a block of
their own, in chunks as any other; null ids stay null; repeated rows are encoded alike (there are no
ties to break); an empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_bucket, expand, load, partitions_for, small_batches, squeeze
from .packing import AFTER_WORD, LATIN_END, byte_chars

#: Chunks end where the low bits of the rolling hash are zero, and have at least and at most so many characters.
CUT_BITS, LEAST, MOST = 11, 256, 16384
CACHE = 600_000
#: Characters of text that a bucket holds, about.
BUCKET_CHARS = 4_000_000
#: Characters of text in a block of documents, about (a text is never divided), and how hard its parts are compressed.
BLOCK_CHARS, LEVEL = 12_000_000, 12
_GEAR = np.random.default_rng(7).integers(0, 2**32, 65536, dtype=np.uint32)


def cuts(text: str) -> list[int]:
    """Ends of the chunks of a text; the last is its length."""
    n = len(text)
    if n <= LEAST:
        return [n]
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    h = _GEAR[codes & 0xFFFF]
    for k in (1, 2, 4, 8):
        h[k:] = h[k:] + (h[:-k] << np.uint32(k))
    hits = np.flatnonzero((h >> np.uint32(32 - CUT_BITS)) == 0) + 1
    out, last = [], 0
    for hit in hits.tolist():
        while hit - last > MOST:
            last += MOST
            out.append(last)
        if hit - last >= LEAST:
            out.append(hit)
            last = hit
    while n - last > MOST:
        last += MOST
        out.append(last)
    if last < n:
        out.append(n)
    return out


def ends(chunk: str) -> tuple[int, int]:
    """Where the first blank of a chunk is and where its last one is; (-1, -1) if it has none."""
    a = [i for i in (chunk.find(" "), chunk.find("\n")) if i >= 0]
    return (min(a), max(chunk.rfind(" "), chunk.rfind("\n"))) if a else (-1, -1)


class WordEncoder:
    """Ids of a word vocabulary as packed unsigned integers, with a cache of units."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        self.special = [t.content for t in tok.get_added_tokens_decoder().values()]
        self.dtype = np.dtype("<u2" if tok.get_vocab_size() <= 65536 else "<u4")
        self.names = [tok.id_to_token(i) or "" for i in range(tok.get_vocab_size())]
        self.tok, kind = tok, self.dtype
        self.whole = lambda text: np.array(tok.encode(text, add_special_tokens=False).ids, kind).tobytes()
        whole, model = self.whole, tok.model
        shown = {b: c for c, b in byte_chars().items()}

        class Units(dict):
            def __missing__(self, unit: str) -> bytes:
                stem = unit.rstrip(AFTER_WORD)
                if stem and stem != unit and stem[-1].isalpha() and stem[-1] < LATIN_END and stem[-1].lower().isalpha():  # a lower case with a mark, as U+0130 has, joins what follows
                    out = self[stem] + self[unit[len(stem) :]]
                elif unit.isalpha() and max(unit) < LATIN_END and (low := unit.lower()).isalpha():
                    # one word, in normal form and with simple lower case: the model alone is enough
                    if not low.isascii():
                        low = "".join(map(shown.__getitem__, low.encode()))
                    out = np.array([t.id for t in model.tokenize(low)], kind).tobytes()
                else:
                    out = whole(unit)
                self[unit] = out
                return out

        self.units = Units()

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if any(s in text for s in self.special):
            return self.whole(text)
        if len(self.units) > CACHE:
            self.units.clear()
        return b"".join(map(self.units.__getitem__, filter(None, text.replace("\n", " ").split(" "))))

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.names.__getitem__, np.frombuffer(ids, self.dtype).tolist()))


BLOCK = "kind int, bucket int, batch long, body binary"


def blocks(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    kind, bucket, batch, body = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(bucket, pa.int32()), pa.array(batch, pa.int64()), pa.array(body, pa.binary())], ["kind", "bucket", "batch", "body"])


def chunked(n_buckets: int):
    """Documents to blocks of distinct chunks (kind 0) and the plan of each block (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        part, ids, texts, room, k = TaskContext.get().partitionId(), [], [], BLOCK_CHARS, 0

        def block() -> pa.RecordBatch:
            key, place, held, plan = (part << 32) | k, {}, {}, []
            for text in texts:
                refs, last = [], 0
                for end in cuts(text) if text else ():
                    chunk, last = text[last:end], end
                    at = place.get(chunk)
                    if at is None:
                        bucket = xxhash.xxh3_64_intdigest(chunk.encode("utf-8", "surrogatepass")) % n_buckets
                        mine = held.setdefault(bucket, [])
                        at = place[chunk] = (bucket, len(mine))
                        mine.append(chunk)
                    refs.append(at)
                plan.append(refs)
            rows = [(0, bucket, key, squeeze(chunks, LEVEL)) for bucket, chunks in held.items()]
            rows.append((1, key % n_buckets, key, squeeze((ids, plan), LEVEL)))
            return blocks(rows)

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids.append(doc_id)
                texts.append(text)
                room -= len(text or "")
                if room <= 0:
                    yield block()
                    ids, texts, room, k = [], [], BLOCK_CHARS, k + 1
        if ids:
            yield block()

    return run


def encoded(path: str):
    """The blocks of one bucket to blocks of encoded chunks, each distinct chunk encoded once."""

    def run(table: pa.Table) -> pa.Table:
        encoder, done, out = _encoder(path), {}, []
        for r in table.to_pylist():
            if r["kind"] == 1:
                out.append((1, r["bucket"], r["batch"], r["body"]))
                continue
            parts = []
            for chunk in expand(r["body"]):
                got = done.get(chunk)
                if got is None:
                    a, z = ends(chunk)
                    got = done[chunk] = (chunk, None, "") if a < 0 else (chunk[:a], encoder.encode(chunk[a:z]), chunk[z:])
                parts.append(got)
            out.append((0, r["bucket"], r["batch"], squeeze(parts, LEVEL)))
        return pa.Table.from_batches([blocks(out)])

    return run


_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    """One encoder, with its cache, for each Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def joined(encoder: WordEncoder, chunks: list[tuple[str, bytes | None, str]]) -> bytes:
    """Ids of a text from its chunks: the open ends are joined and encoded anew."""
    out, open_end = [], ""
    for head, ids, tail in chunks:
        open_end += head
        if ids is not None:
            out += [encoder.encode(open_end), ids]
            open_end = tail
    out.append(encoder.encode(open_end))
    return b"".join(out)


def assembled(path: str, full: bool):
    """A batch's plan and its encoded chunks to a row per document."""

    def run(table: pa.Table) -> pa.Table:
        encoder, rows, parts = _encoder(path), table.to_pylist(), {}
        for r in rows:
            if r["kind"] == 0:
                parts[r["bucket"]] = expand(r["body"])
        doc_ids, n, digest, back, ids_out, texts = [], [], [], [], [], []
        for r in rows:
            if r["kind"] == 1:
                ids, plan = expand(r["body"])
                doc_ids += ids
                for refs in plan:
                    packed = joined(encoder, [parts[b][i] for b, i in refs])
                    values, text = np.frombuffer(packed, encoder.dtype), encoder.decode(packed)
                    n.append(len(values))
                    if full:
                        ids_out.append(values.astype(np.int64))
                        texts.append(text)
                    else:
                        digest.append(hashlib.sha256(values.astype("<u4").tobytes()).hexdigest())
                        back.append(hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest())
        head = [pa.array(doc_ids, pa.int64()), pa.array(n, pa.int64())]
        if full:
            return pa.Table.from_arrays([*head, pa.array(ids_out, pa.list_(pa.int64())), pa.array(texts, pa.string())], ["doc_id", "n_tokens", "ids", "decoded"])
        return pa.Table.from_arrays([*head, pa.array(digest, pa.string()), pa.array(back, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def encode(docs: DataFrame, path: str, full: bool = True) -> DataFrame:
    """Documents (doc_id, text) to doc_id, n_tokens, ids and decoded text; digests of the two if not full."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n = partitions_for(rows, BUCKET_CHARS)
    back = by_bucket(rows.mapInArrow(chunked(n), BLOCK), n).groupBy("bucket").applyInArrow(encoded(path), BLOCK)
    columns = "ids array<long>, decoded string" if full else "ids_sha256 string, decoded_sha256 string"
    return back.repartition(n, "batch").groupBy("batch").applyInArrow(assembled(path, full), f"doc_id long, n_tokens long, {columns}")


def op7_chunk_bpe(spark, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded."""
    import public_tokenizers

    return encode(load(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), full=False)
