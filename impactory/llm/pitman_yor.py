"""Language-model scores from a hierarchical Pitman-Yor process.

Restaurants: one for every pair of words that stands before a word (END before the first), however many
pairs the texts hold; all share the root as their parent, whose own base is uniform over the V training
words and one unknown. A restaurant's customers of a word are its training counts; the tables they sit
at are the root's customers. Restaurants are dealt to buckets by a hash of the pair, whole.

A bucket's seating is sampled by Gibbs: in each sweep the tables of each word are drawn given the others,
from the exact conditional by generalized Stirling numbers for up to EXACT customers and by seating them
one after another (in steps of a fiftieth) beyond that. Words of one restaurant depend on each other
through its totals only and are drawn in PARTS groups, totals being renewed after each. After a sweep
the discount and the strength are drawn from their conditionals over a grid. While it samples, a bucket's
restaurants share a root of their own, seated from their tables in the same sweeps; the chain is never
restarted. Its BURN first sweeps are dropped; over SAMPLES more the predictive probabilities are averaged.

For predictions the buckets' tables meet in one root, dealt by word; its tables are drawn as often. A word's
probability is a + b * p, where a and b come from its context's restaurant, with the totals of the same
seating, and p from the root: over the vocabulary and the unknown they sum to one.

Blocks of documents send their distinct (context, word) entries to the contexts' buckets, and their
distinct words to the words'; both answer, and a block adds its documents up. All is sent as packed
arrays, never a row per token, and grows with the input. Seatings are drawn from seeds of the bucket's
number, so that a task run again gives the same. Contexts are told apart by 40 bits, words within one
by 32; counts and known words go by 64.

The end of a text is a token. Rows: null and empty texts are the end token alone; very long texts are a
block of their own; null ids count as the empty text for the folds; repeated rows are scored (and learnt)
again, all alike; without training rows every token has probability 1 / (V + 1) with V = 0; an empty
table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascending, by_bucket, discard, expand, fixed_tasks, free_shuffles, from_ascending, from_planes, load, materialize, partitions_for, planes, small_batches, squeeze

EXACT, BURN, SAMPLES, PARTS, SEED = 24, 4, 4, 4, 20
#: Grids of discounts and strengths, and the discount and strength to begin with.
DISCOUNTS, STRENGTHS = np.linspace(0.05, 0.95, 19), np.exp(np.linspace(np.log(1e-3), np.log(1e4), 33))
FIRST = (0.7, 1.0)
#: Characters of text in a block (a text is never divided) and in a bucket, about.
BLOCK_CHARS, BUCKET_CHARS = 4_000_000, 16_000_000
END = b"\n"  # no word holds white space
CONTEXT_BITS, WORD_BITS = 40, 32
ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * ODD
    return x ^ (x >> np.uint64(29))


def tokens_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words, the word of each token, and the tokens of each text."""
    import xxhash

    class Places(dict):
        def __missing__(self, word: bytes) -> int:
            i = self[word] = len(self)
            return i

    places = Places()
    ids, lengths = [], []
    for text in texts:
        words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        words.append(END)
        ids.append(np.fromiter(map(places.__getitem__, words), np.int32, len(words)))
        lengths.append(len(words))
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in places), np.uint64, len(places))
    return hashes, np.concatenate(ids) if ids else np.zeros(0, np.int32), np.array(lengths, np.int64)


def entries_of(hashes: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct (context, word) entries in the order of their contexts, and the entry of each token."""
    own = hashes[ids]
    one, two = np.zeros_like(own), np.zeros_like(own)
    one[1:], two[2:] = own[:-1], own[:-2]
    starts = np.cumsum(lengths) - lengths
    one[starts] = two[starts] = 0
    two[starts[lengths > 1] + 1] = 0
    context = mixed(mixed(two) + one) >> np.uint64(64 - CONTEXT_BITS)
    order = np.lexsort((ids, context))
    context, word = context[order], ids[order]
    first = np.concatenate([[True], (context[1:] != context[:-1]) | (word[1:] != word[:-1])]) if len(ids) else np.zeros(0, bool)
    of_token = np.empty(len(ids), np.int64)
    of_token[order] = np.cumsum(first) - 1
    return context[first], word[first], of_token


def dealt(keys: np.ndarray, bits: int, n: int) -> np.ndarray:
    """Where each bucket of sorted keys begins; and their number at the end."""
    bucket = (keys >> np.uint64(bits - 32)) * np.uint64(n) >> np.uint64(32)
    return np.searchsorted(bucket, np.arange(n + 1))


def fold_of(ids: list[int | None]) -> np.ndarray:
    return np.array([zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1 for i in ids], bool)


MESSAGE = [("kind", pa.int32()), ("bucket", pa.int32()), ("block", pa.int64()), ("body", pa.binary())]
MESSAGE_SQL = "kind int, bucket int, block long, body binary"
#: What a message is about: words of a block, tables of a context's bucket; answers for entries and words; a block itself.
WORDS, TABLES, ENTRY_ANSWER, WORD_ANSWER, BLOCK = range(5)


def batch(schema: list[tuple[str, pa.DataType]], rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, schema, strict=True)], [n for n, _ in schema])


def by_block(messages_of: Callable) -> Callable:
    """A function from batches (doc_id, text) to messages, given one from a block; the blocks are the same whenever a task runs again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ids, texts, room, k = TaskContext.get().partitionId() << 32, [], [], BLOCK_CHARS, 0
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids.append(doc_id)
                texts.append(text)
                room -= len(text or "")
                if room <= 0:
                    yield batch(MESSAGE, messages_of(part | k, ids, texts))
                    ids, texts, room, k = [], [], BLOCK_CHARS, k + 1
        if ids:
            yield batch(MESSAGE, messages_of(part | k, ids, texts))

    return run


def small(x: np.ndarray) -> tuple[str, bytes]:
    return planes(x.astype("<u4"))


def ask_contexts(n: int) -> Callable:
    """To each bucket of contexts: entries (context, 32 bits of the word) and their training counts."""

    def messages(block: int, ids: list, texts: list) -> list[tuple]:
        hashes, tokens, lengths = tokens_of(texts)
        context, word, at = entries_of(hashes, tokens, lengths)
        counts = np.bincount(at[np.repeat(~fold_of(ids), lengths)], minlength=len(context))
        edge, short = dealt(context, CONTEXT_BITS, n), (hashes >> np.uint64(32)).astype("<u4")[word]
        return [(WORDS, k, block, squeeze((ascending(context[edge[k] : edge[k + 1]]), short[edge[k] : edge[k + 1]], small(counts[edge[k] : edge[k + 1]])))) for k in np.flatnonzero(np.diff(edge)).tolist()]

    return by_block(messages)


def ask_words(n: int) -> Callable:
    """To each bucket of words: hashes, and their training counts."""

    def messages(block: int, ids: list, texts: list) -> list[tuple]:
        hashes, tokens, lengths = tokens_of(texts)
        counts = np.bincount(tokens[np.repeat(~fold_of(ids), lengths)], minlength=len(hashes))
        order = np.argsort(hashes)
        hashes, counts = hashes[order], counts[order]
        edge = dealt(hashes, 64, n)
        return [(WORDS, k, block, squeeze((ascending(hashes[edge[k] : edge[k + 1]]), small(counts[edge[k] : edge[k + 1]])))) for k in np.flatnonzero(np.diff(edge)).tolist()]

    return by_block(messages)


def describe() -> Callable:
    """What it takes to add up a block's answers."""

    def messages(block: int, ids: list, texts: list) -> list[tuple]:
        hashes, tokens, lengths = tokens_of(texts)
        return [(BLOCK, -1, block, squeeze((list(ids), hashes, planes(tokens), lengths)))]

    return by_block(messages)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Of positive numbers, by Stirling's series."""
    x = np.asarray(x, float)
    small_ = x < 8
    z = np.where(small_, x + 8, x)
    out = (z - 0.5) * np.log(z) - z + 0.9189385332046727 + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5)
    shift = np.ones_like(z)
    for k in range(8):
        shift = np.where(small_, shift * (x + k), shift)
    return out - np.log(shift)


#: Customers and tables up to which logarithms of Stirling numbers are kept; beyond that their asymptotic form is taken.
MOST_CUSTOMERS, MOST_TABLES = 256, 64
_LOGS: list[np.ndarray] = []


def log_stirling_grid() -> np.ndarray:
    """(discount, customers, tables) of logarithms of generalized Stirling numbers, for the grid of discounts."""
    if not _LOGS:
        out = np.full((len(DISCOUNTS), MOST_CUSTOMERS + 1, MOST_TABLES + 1), -np.inf)
        out[:, 1, 1] = 0
        t = np.arange(MOST_TABLES + 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            for n in range(1, MOST_CUSTOMERS):
                grow = np.log(np.maximum(n - DISCOUNTS[:, None] * t, 0)) + out[:, n]
                grow[:, 1:] = np.logaddexp(grow[:, 1:], out[:, n, :-1])
                out[:, n + 1] = np.where(t > n + 1, -np.inf, grow)
        _LOGS.append(out)
    return _LOGS[0]


def log_stirling(c: np.ndarray, t: np.ndarray) -> np.ndarray:
    """(discount, ...) for customers and tables of the grid's discounts."""
    table = log_stirling_grid()
    out = table[:, np.minimum(c, MOST_CUSTOMERS), np.minimum(t, MOST_TABLES)]
    far = np.flatnonzero((c > MOST_CUSTOMERS) | (t > MOST_TABLES))
    d = DISCOUNTS[:, None]
    out[:, far] = log_gamma(c[far]) - d * np.log(c[far]) - log_gamma(1 - d) - (t[far] - 1) * np.log(d) - log_gamma(t[far])
    return out


def draw_strengths(customers: np.ndarray, tables: np.ndarray, c: np.ndarray, t: np.ndarray, strength: float, rng: np.random.Generator) -> tuple[float, float]:
    """A discount and a strength from their conditionals on the grid, given restaurants' totals and the counts of their words.

    One customer at one table has probability one whatever the two are, so such restaurants and words may be left out.
    """

    def counted(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        more = x > 1
        both, times = np.unique((x[more] << 31) | y[more], return_counts=True)
        return both >> 31, both & ((1 << 31) - 1), times

    n, k, many = counted(customers, tables)
    *cells, times = counted(c, t)

    def draw(logs: np.ndarray, grid: np.ndarray) -> float:
        return float(grid[np.argmax(logs + rng.gumbel(size=len(grid)))])

    def seats(d: np.ndarray, s: np.ndarray) -> np.ndarray:
        return ((k * np.log(d) + log_gamma(s / d + k) - log_gamma(s / d) - log_gamma(s + n) + log_gamma(s)) * many).sum(axis=1)

    d = draw(seats(DISCOUNTS[:, None], np.array(strength)) + (log_stirling(*cells) * times).sum(axis=1), DISCOUNTS)
    return d, draw(seats(np.array(d), STRENGTHS[:, None]), STRENGTHS)


_STIRLING: dict[float, np.ndarray] = {}


def stirling(d: float) -> np.ndarray:
    """Logarithms of generalized Stirling numbers up to EXACT customers."""
    if d not in _STIRLING:
        s = np.zeros((EXACT + 1, EXACT + 1))
        s[1, 1] = 1
        for n in range(1, EXACT):
            s[n + 1, 1:] = s[n, :-1] + (n - d * np.arange(1, EXACT + 1)) * s[n, 1:]
        with np.errstate(divide="ignore"):
            _STIRLING[d] = np.log(np.maximum(s, 0))
    return _STIRLING[d]


def draw_tables(c: np.ndarray, others: np.ndarray, above: np.ndarray, d: float, strength: float, rng: np.random.Generator) -> np.ndarray:
    """The tables at which c customers of a word sit, given the restaurant's other tables and the parent's probability."""
    t = np.minimum(c, 1)
    table = stirling(d)
    for n in range(2, EXACT + 1):
        at = np.flatnonzero(c == n)
        if len(at):
            new = np.log(strength + d * (others[at][:, None] + np.arange(n))) + np.log(above[at])[:, None]
            weight = table[n, 1 : n + 1] + np.cumsum(new, axis=1)
            t[at] = 1 + np.argmax(weight + rng.gumbel(size=weight.shape), axis=1)
    at = np.flatnonzero(c > EXACT)
    seated = np.ones(len(at), np.int64)
    while len(at):
        step = np.minimum(np.maximum(seated // 50, 1), c[at] - seated)
        new = (strength + d * (others[at] + t[at])) * above[at]
        t[at] += rng.binomial(step, np.clip(new / (new + np.maximum(seated - d * t[at], 1e-9)), 0, 1))
        seated += step
        more = seated < c[at]
        at, seated = at[more], seated[more]
    return t


class Restaurants:
    """A bucket's contexts and their words, the seating of their customers, and the root that they share while it is sampled."""

    def __init__(self, context: np.ndarray, word: np.ndarray, count: np.ndarray, rng: np.random.Generator):
        order = np.lexsort((word, context))
        context, word = context[order], word[order]
        first = np.concatenate([[True], (context[1:] != context[:-1]) | (word[1:] != word[:-1])])
        self.asked = np.empty(len(order), np.int64)
        self.asked[order] = np.cumsum(first) - 1
        self.c = np.add.reduceat(count[order], np.flatnonzero(first))
        self.room = np.cumsum(np.concatenate([[True], (lambda x: x[1:] != x[:-1])(context[first])])) - 1
        self.words, self.word = np.unique(word[first], return_inverse=True)
        self.customers = np.bincount(self.room, self.c).astype(np.int64)
        self.rng, self.t = rng, np.minimum(self.c, 1)
        self.shared, (self.d, self.strength), (self.d0, self.strength0) = self.up(), FIRST, FIRST
        self.tables0 = np.minimum(self.shared, 1)
        self.several = np.flatnonzero(self.c > 1)

    def up(self) -> np.ndarray:
        return np.bincount(self.word, self.t, len(self.words)).astype(np.int64)

    def tables(self) -> np.ndarray:
        return np.bincount(self.room, self.t, len(self.customers)).astype(np.int64)

    def sweep(self) -> None:
        v = max(1, len(self.words))
        for k in range(PARTS):
            at = self.several[k::PARTS]
            if len(at):
                p = (np.maximum(self.shared - self.d0 * self.tables0, 0) + (self.strength0 + self.d0 * self.tables0.sum()) / v) / (self.strength0 + self.shared.sum())
                others = self.tables()[self.room[at]] - self.t[at]
                self.t[at] = draw_tables(self.c[at], others, p[self.word[at]], self.d, self.strength, self.rng)
                self.shared = self.up()
                self.tables0 = np.minimum(np.maximum(self.tables0, self.shared > 0), self.shared)
        self.tables0 = draw_tables(self.shared, self.tables0.sum() - self.tables0, np.full(len(self.words), 1 / v), self.d0, self.strength0, self.rng)
        self.d, self.strength = draw_strengths(self.customers, self.tables(), self.c, self.t, self.strength, self.rng)
        self.d0, self.strength0 = draw_strengths(self.shared.sum()[None], self.tables0.sum()[None], self.shared, self.tables0, self.strength0, self.rng)

    def log_seating(self) -> float:
        """Of the seating given discount and strength, but for the root's part: what a trace of the chain shows."""
        at = int(np.argmin(np.abs(DISCOUNTS - self.d)))
        seen, known = self.c > 0, self.customers > 0
        n, k = self.customers[known].astype(float), self.tables()[known].astype(float)
        rooms = k * np.log(self.d) + log_gamma(self.strength / self.d + k) - log_gamma(self.strength / self.d) - log_gamma(self.strength + n) + log_gamma(self.strength)
        return float(rooms.sum() + log_stirling(self.c[seen], self.t[seen])[at].sum())

    def predict(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each entry: its own part of the probability, and the weight of the root's."""
        below = (self.strength + self.customers)[self.room]
        return np.maximum(self.c - self.d * self.t, 0) / below, ((self.strength + self.d * self.tables()) / (self.strength + self.customers))[self.room]


def pairs_packed(own: np.ndarray, rest: np.ndarray) -> bytes:
    """Two numbers for each entry as the distinct pairs and the place of each: most entries are alike."""
    pairs, at = np.unique(np.stack([own, rest], axis=1).astype("<f4").view(np.uint64).ravel(), return_inverse=True)
    return squeeze((pairs, planes(at.astype(np.min_scalar_type(max(1, len(pairs)))))))


def pairs_unpacked(body: bytes) -> np.ndarray:
    """(entries, 2)."""
    pairs, at = expand(body)
    return pairs.view("<f4").reshape(-1, 2)[from_planes(*at)]


def seated(table: pa.Table) -> pa.Table:
    """A bucket of contexts: answers to each block's entries, and the tables of each word for the words' buckets (dealt out later)."""
    rows = sorted(table.select(["bucket", "block", "body"]).to_pylist(), key=lambda r: r["block"])
    asked = [expand(r["body"]) for r in rows]
    context = np.concatenate([from_ascending(*a[0]) for a in asked])
    word, count = np.concatenate([a[1] for a in asked]), np.concatenate([from_planes(*a[2]) for a in asked]).astype(np.int64)
    sizes = [len(a[1]) for a in asked]
    del asked
    number = rows[0]["bucket"]
    x = Restaurants(context, word, count, np.random.default_rng([SEED, number]))
    own, rest = np.zeros(len(x.c)), np.zeros(len(x.c))
    for k in range(BURN + SAMPLES):
        x.sweep()
        if k >= BURN:
            a, b = x.predict()
            own += a / SAMPLES
            rest += b / SAMPLES
    out, lo = [], 0
    for r, n in zip(rows, sizes, strict=True):
        at = x.asked[lo : lo + n]
        out.append((ENTRY_ANSWER, number, r["block"], pairs_packed(own[at], rest[at])))
        lo += n
    full = x.shared > 0
    out.append((TABLES, number, -1 - number, squeeze((ascending(x.words[full].astype(np.uint64)), small(x.shared[full])))))
    return pa.Table.from_batches([batch(MESSAGE, out)])


def spread(n: int) -> Callable:
    """The tables of words from the contexts' buckets, dealt out to the words' buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, body in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                words, tables = expand(body)
                words, tables = from_ascending(*words), from_planes(*tables)
                edge = dealt(words, WORD_BITS, n)
                yield batch(MESSAGE, [(TABLES, k, block, squeeze((ascending(words[edge[k] : edge[k + 1]]), small(tables[edge[k] : edge[k + 1]])))) for k in np.flatnonzero(np.diff(edge)).tolist()])

    return run


TOLD = [("bucket", pa.int32()), ("n", pa.int64()), ("v", pa.int64()), ("customers", pa.int64()), ("full", pa.int64()), ("ones", pa.int64()), ("twos", pa.int64()), ("body", pa.binary())]
TOLD_SQL = "bucket int, n long, v long, customers long, full long, ones long, twos long, body binary"


def gathered(table: pa.Table) -> pa.Table:
    """A bucket of words: their counts, their customers in the root, and who asks for them; with sums over them."""
    asks, tables = [], []
    for r in sorted(table.to_pylist(), key=lambda r: (r["kind"], r["block"])):
        body = expand(r["body"])
        if r["kind"] == WORDS:
            asks.append((r["block"], from_ascending(*body[0]), from_planes(*body[1])))
        else:
            tables.append((from_ascending(*body[0]), from_planes(*body[1])))
    names, at = np.unique(np.concatenate([a[1] for a in asks]), return_inverse=True)
    count = np.bincount(at, np.concatenate([a[2] for a in asks]), len(names)).astype(np.int64)
    short, root = np.unique((names >> np.uint64(32)).astype("<u4"), return_inverse=True)
    customers = np.zeros(len(short), np.int64)
    for words, n in tables:
        np.add.at(customers, np.searchsorted(short, words), n)
    lo, who = 0, []
    for block, words, _ in asks:
        who.append((block, planes(at[lo : lo + len(words)].astype("<u4"))))
        lo += len(words)
    body = squeeze((small(count), planes(root.astype("<u4")), small(customers), who))
    sums = (int(count.sum()), int((count > 0).sum()), int(customers.sum()), int((customers > 0).sum()), int((customers == 1).sum()), int((customers == 2).sum()))
    return pa.Table.from_batches([batch(TOLD, [(table.column("bucket")[0].as_py(), *sums, body)])])


@dataclass
class Root:
    """Over all words: training tokens and words, the root's customers, words that have any, the discount; and the tables of each seating."""

    n: int
    v: int
    customers: int
    full: int
    discount: float
    strength: float = 1.0
    tables: tuple[int, ...] = ()

    def seatings(self, number: int, customers: np.ndarray) -> Iterator[np.ndarray]:
        """A bucket's tables in each of SAMPLES seatings; the same whenever they are drawn."""
        rng, t = np.random.default_rng([SEED, 1, number]), np.minimum(customers, 1)
        for k in range(2 + SAMPLES):
            rest = np.maximum(self.full + t.sum() - (customers > 0).sum() - t, 0)  # the other buckets as they begin
            t = draw_tables(customers, rest, np.full(len(t), 1 / (self.v + 1)), self.discount, self.strength, rng)
            if k >= 2:
                yield t

    def predict(self, number: int, customers: np.ndarray) -> np.ndarray:
        out = np.zeros(len(customers))
        for t, total in zip(self.seatings(number, customers), self.tables, strict=True):
            out += (np.maximum(customers - self.discount * t, 0) + (self.strength + self.discount * total) / (self.v + 1)) / (self.strength + self.customers)
        return out / SAMPLES


def root_tables(x: Root) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for number, body in zip(b.column(0).to_pylist(), b.column(7).to_pylist(), strict=True):
                sums = [int(t.sum()) for t in x.seatings(number, from_planes(*expand(body)[2]).astype(np.int64))]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(SAMPLES, dtype=np.int32)), pa.array(sums, pa.int64())], ["k", "tables"])

    return run


def answer_words(x: Root) -> Callable:
    """To each block: counts and root probabilities of its words. Words that one hash of 32 bits stands for share its probability."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for number, body in zip(b.column(0).to_pylist(), b.column(7).to_pylist(), strict=True):
                count, root, customers, who = expand(body)
                count, root = from_planes(*count), from_planes(*root).astype(np.int64)
                alike = np.maximum(np.bincount(root, count > 0), 1)
                p = (x.predict(number, from_planes(*customers).astype(np.int64)) / alike)[root]
                out = []
                for block, at in who:
                    at = from_planes(*at)
                    out.append((WORD_ANSWER, number, block, squeeze((small(count[at]), planes(p[at].astype("<f4"))))))
                yield batch(MESSAGE, out)

    return run


SCORES = [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
SCORES_SQL = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def added(x: Root) -> Callable:
    """A block and the answers of all buckets to a row per document."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.select(["kind", "bucket", "body"]).to_pylist(), key=lambda r: (r["kind"], r["bucket"]))
        ids, hashes, tokens, lengths = expand(rows[-1]["body"])
        tokens = from_planes(*tokens)
        _, word, at = entries_of(hashes, tokens, lengths)
        own, rest = np.concatenate([pairs_unpacked(r["body"]) for r in rows if r["kind"] == ENTRY_ANSWER]).astype(float).T
        told = [expand(r["body"]) for r in rows if r["kind"] == WORD_ANSWER]
        count, p = np.zeros(len(hashes)), np.zeros(len(hashes))
        order = np.argsort(hashes)
        count[order], p[order] = (np.concatenate([from_planes(*x[i]) for x in told]) for i in range(2))
        logs = np.log10(own + rest * p[word])[at]
        known = count[tokens]
        starts = np.cumsum(lengths) - lengths
        base = np.log10((known + 0.5) / (x.n + 0.5 * (x.v + 1)))
        sums = [np.add.reduceat(a, starts) for a in ((known > 0).astype(np.int64), base, logs)]
        return pa.Table.from_arrays([pa.array(c, t) for c, (_, t) in zip((ids, fold_of(ids), lengths, sums[0], np.full(len(ids), x.n), sums[1], sums[2]), SCORES, strict=True)], [n for n, _ in SCORES])

    return run


def score(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, text) to held_out, n_tokens, n_known, train_tokens, base_score and score."""
    small_batches(docs.sparkSession)
    fixed_tasks(docs.sparkSession)  # three passes number the blocks alike
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n = partitions_for(rows, BUCKET_CHARS)
    contexts = by_bucket(rows.mapInArrow(ask_contexts(n), MESSAGE_SQL), n).groupBy("bucket").applyInArrow(seated, MESSAGE_SQL)
    contexts = materialize(contexts, "contexts")
    free_shuffles(docs.sparkSession)
    words = rows.mapInArrow(ask_words(n), MESSAGE_SQL).union(contexts.where(F.col("kind") == TABLES).mapInArrow(spread(n), MESSAGE_SQL))
    words = materialize(by_bucket(words, n).groupBy("bucket").applyInArrow(gathered, TOLD_SQL), "words")
    free_shuffles(docs.sparkSession)
    t = words.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "v", "customers", "full", "ones", "twos"))).first()
    d = t["ones"] / (t["ones"] + 2 * t["twos"]) if t["ones"] + t["twos"] else 0.5
    root = Root(t["n"], t["v"], t["customers"], t["full"], float(DISCOUNTS[np.argmin(np.abs(DISCOUNTS - d))]))
    sums = words.mapInArrow(root_tables(root), "k int, tables long").groupBy("k").agg(F.sum("tables").alias("tables")).collect()  # SAMPLES rows
    root.tables = tuple(r["tables"] for r in sorted(sums)) or (0,) * SAMPLES
    # The documents come first in a union, so that tasks, and so blocks, have the same numbers in every pass.
    told = rows.mapInArrow(describe(), MESSAGE_SQL).union(contexts.where(F.col("kind") == ENTRY_ANSWER)).union(words.mapInArrow(answer_words(root), MESSAGE_SQL))
    out = materialize(told.repartition(n, "block").groupBy("block").applyInArrow(added(root), SCORES_SQL), "scores")
    for table in (contexts, words):
        discard(table)
    return out


def op3_pitman_yor(spark, sf_dir: str) -> DataFrame:
    """Every document's log10 probability; learns from rows whose fold of 5 is not 1."""
    return score(load(spark, sf_dir, "documents"))
