"""Operators against brute force, the libraries themselves, and held-out labels."""

import hashlib
import json
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from impactory.llm import chroma, chunk_bpe, language_id, line_quality, packing, pitman_yor, secret_scan, simhash, spot_signatures, toxicity

SF = "/root/testdata/sf0.001"
ODD = ["", " ", "  ", "a  b", "foo\n bar", "\n \nfoo", "x <|endoftext|> y<|startoftext|>", "it's  ok\t x", "İstanbul ΑΣ", "é́ 漢字。 word。.", "a" * 3000, "a.b. c,,d ..", "x \n y", "don't!! 'REally' 123 4,5", "　x \x85 y", " lead", "trail ", "\x00 a"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}


def test_packing_is_a_partition_of_the_ids(spark, texts):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {k: [*tok.encode(t, add_special_tokens=False).ids, 1] for k, t in texts.items()}
    rows = packing.op2_packing(spark, SF).collect()
    at: dict[int, int] = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        assert r["start"] == at.get(r["doc_id"], 0) and r["doc_tokens"] == len(ids[r["doc_id"]])
        own = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(own, "<u4").tobytes())
        at[r["doc_id"]] = r["start"] + r["length"]
    assert at == {k: len(v) for k, v in ids.items()}
    used: dict[int, int] = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == used.get(r["sequence_id"], 0)
        used[r["sequence_id"]] = r["offset"] + r["length"]
    assert sorted(used) == list(range(len(used))) and all(n == 2048 for k, n in used.items() if k < len(used) - 1)


def test_encoders_agree_with_the_library(texts):
    some = [*ODD, *list(texts.values())[:60]]
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok, enc = Tokenizer.from_file(path), packing.ByteEncoder(path)
    for t in some:
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids
    path = public_tokenizers.path("word_bpe_49k.json")
    tok, enc = Tokenizer.from_file(path), chunk_bpe.WordEncoder(path)
    for t in some:
        parts, last = [], 0
        for end in chunk_bpe.cuts(t) if t else ():
            chunk, last = t[last:end], end
            a, z = chunk_bpe.ends(chunk)
            parts.append((chunk, None, "") if a < 0 else (chunk[:a], enc.encode(chunk[a:z]), chunk[z:]))
        ids = chunk_bpe.joined(enc, parts)
        want = tok.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(ids, enc.dtype).tolist() == want and enc.decode(ids) == tok.decode(want, skip_special_tokens=False)


def test_word_encoder_on_every_code_point():
    path = public_tokenizers.path("word_bpe_49k.json")
    tok, enc = Tokenizer.from_file(path), chunk_bpe.WordEncoder(path)
    shapes = ["{}", "{}.", "a{},", "{}b.", "a{}b!!", "{}{}?", "{}'s", "1{};", "é{}."]
    for lo in range(0x21, 0x3000, 1024):
        some = [s.replace("{}", chr(c)) for c in range(lo, min(lo + 1024, 0x3000)) for s in shapes]
        for t, e in zip(some, tok.encode_batch(some, add_special_tokens=False), strict=True):
            assert np.frombuffer(enc.encode(t), enc.dtype).tolist() == e.ids, t


def test_chunks_are_shared_and_whole(texts):
    passage = " ".join(list(texts.values())[:6])
    a, b = "one beginning " + passage, "another, and longer, beginning " + passage

    def split(t):
        ends = chunk_bpe.cuts(t)
        return [t[i:j] for i, j in zip([0, *ends], ends, strict=False)]

    assert "".join(split(a)) == a and len(set(split(a)) & set(split(b))) >= len(split(a)) // 2


def test_full_encoding_round_trip(spark):
    df = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    for r in chunk_bpe.encode(df, path).collect():
        want = tok.encode(ODD[r["doc_id"]], add_special_tokens=False).ids
        assert r["ids"] == want and r["decoded"] == tok.decode(want, skip_special_tokens=False)


def test_scores_of_the_language_model(spark, texts):
    words = {k: [w.decode() for w in t.encode().lower().split()] + ["\n"] for k, t in texts.items()}
    held = {k: zlib.crc32(str(k).encode()) % 5 == 1 for k in words}
    c = Counter(w for k, ws in words.items() if not held[k] for w in ws)
    n, v = sum(c.values()), len(c)
    rows = pitman_yor.op3_pitman_yor(spark, SF).collect()
    better = []
    for r in rows:
        ws = words[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[r["doc_id"]], len(ws), sum(w in c for w in ws), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), rel=1e-9)
        if r["held_out"]:
            better.append(r["score"] - r["base_score"])
    assert sum(better) > 0


def test_predictive_probabilities_sum_to_one():
    """Over all words and the unknown one, after every context and at the root, by the functions that the query runs in its buckets."""
    texts = ["a b a c", "a b b a", "c a b", "b b", "a b a c a b a"]
    hashes, tokens, lengths = pitman_yor.tokens_of(texts)
    context, word, at = pitman_yor.entries_of(hashes, tokens, lengths)
    held = np.array([False] * 4 + [True])
    counts = np.bincount(at[np.repeat(~held, lengths)], minlength=len(context))
    short = (hashes >> np.uint64(32)).astype("<u4")
    every = np.unique(context)  # each context asks for every word
    full = np.zeros((len(every), len(hashes)), np.int64)
    full[np.searchsorted(every, context), word] = counts

    def message(kind, bucket, block, body):
        return (kind, bucket, block, pitman_yor.squeeze(body))

    asked = (pitman_yor.ascending(np.repeat(every, len(hashes))), np.tile(short, len(every)), pitman_yor.small(full.ravel()))
    told = pitman_yor.seated(pa.Table.from_batches([pitman_yor.batch(pitman_yor.MESSAGE, [message(pitman_yor.WORDS, 0, 7, asked)])])).to_pylist()
    own, rest = (x.reshape(full.shape) for x in pitman_yor.pairs_unpacked(told[0]["body"]).T)
    order = np.argsort(hashes)
    train = np.bincount(tokens[np.repeat(~held, lengths)], minlength=len(hashes))
    ask = message(pitman_yor.WORDS, 0, 7, (pitman_yor.ascending(hashes[order]), pitman_yor.small(train[order])))
    tables = (pitman_yor.TABLES, 0, -1, told[1]["body"])
    r = pitman_yor.gathered(pa.Table.from_batches([pitman_yor.batch(pitman_yor.MESSAGE, [ask, tables])])).to_pylist()[0]
    root = pitman_yor.Root(r["n"], r["v"], r["customers"], r["full"], 0.5)
    customers = pitman_yor.from_planes(*pitman_yor.expand(r["body"])[2]).astype(np.int64)
    root.tables = tuple(int(t.sum()) for t in root.seatings(0, customers))
    row = [pa.record_batch({c: [r[c]] for c, _ in pitman_yor.TOLD})]
    p = pitman_yor.from_planes(*pitman_yor.expand(next(pitman_yor.answer_words(root)(iter(row))).column(3)[0].as_py())[1]).astype(float)
    known = train[order] > 0
    unknown = np.mean([(root.strength + root.discount * t) / (root.v + 1) / (root.strength + root.customers) for t in root.tables])
    assert r["n"] == train.sum() and r["v"] == known.sum() and p[known].sum() + unknown == pytest.approx(1, abs=1e-6)
    for k in range(len(every)):
        sums = (own[k][order] + rest[k][order] * p)[known].sum() + rest[k][0] * unknown
        assert sums == pytest.approx(1, abs=1e-6)


def test_generalized_stirling_numbers():
    """Against the recursion in plain numbers, and the asymptotic form against the table near its end."""
    d, s = pitman_yor.DISCOUNTS[9], {(1, 1): 1.0}
    for n in range(1, 40):
        for t in range(1, n + 2):
            s[n + 1, t] = s.get((n, t - 1), 0) + (n - d * t) * s.get((n, t), 0)
    c, t = np.array([c for c, _ in s]), np.array([t for _, t in s])
    assert pitman_yor.log_stirling(c, t)[9] == pytest.approx(np.log(list(s.values())), rel=1e-9)
    near, far = pitman_yor.log_stirling(np.array([256, 257]), np.array([2, 2]))[9]
    assert far - near == pytest.approx(np.log(256 - d), abs=0.05)


def test_language_model_knows_a_text_that_it_has_learnt(spark):
    """A held-out copy of a training text is likelier than other held-out texts, and so is a training text that occurs twice."""
    rng = np.random.default_rng(12)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choice(words, 60)) for _ in range(200)]
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 1]
    train = [i for i in range(200) if i not in held]
    for k in range(10):
        texts[held[k]] = texts[train[k]]
        texts[train[20 + k]] = texts[train[40 + k]]
    got = {r["doc_id"]: r["score"] / r["n_tokens"] for r in pitman_yor.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert min(got[i] for i in held[:10]) > max(got[i] for i in held[10:])
    twice = [got[i] for i in train[20:30]]
    assert np.median(twice) > np.percentile([got[i] for i in train[60:]], 95)


def _print(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in ([" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)])]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def _components(codes, ids, bits=2):
    parent = list(range(len(codes)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(codes)):
        for j in np.flatnonzero(np.bitwise_count(codes[i] ^ codes[i + 1 :]) <= bits):
            parent[find(i + 1 + j)] = find(i)
    least: dict[int, int] = {}
    for i in range(len(codes)):
        least[find(i)] = min(least.get(find(i), 1 << 62), ids[i])
    return [least[find(i)] for i in range(len(codes))]


def test_simhash_fingerprints(spark, texts):
    for r in simhash.op5_simhash(spark, SF).collect():
        assert int(r["fingerprint"], 16) == _print(texts[r["doc_id"]]) and len(r["fingerprint"]) == 16


def test_components_of_dense_and_chained_fingerprints(spark):
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    ball = codes[0] ^ np.array([1 << int(a) | 1 << int(b) for a, b in rng.integers(0, 64, (600, 2))], np.uint64)
    chain = [codes[1]]
    for _ in range(300):
        chain.append(chain[-1] ^ np.uint64(3 << int(rng.integers(0, 63))))
    codes = np.concatenate([codes, ball, np.array(chain, np.uint64), codes[:50], [np.uint64(0)]])
    ids = rng.permutation(len(codes))
    df = spark.createDataFrame([(int(i), int(c)) for i, c in zip(ids, codes.view(np.int64), strict=True)], "doc_id long, fp long")
    got = {r["doc_id"]: r["component_id"] for r in df.join(simhash.fingerprint_components(df), "fp").collect()}
    assert [got[int(i)] for i in ids] == _components(codes, ids.tolist())


def test_near_duplicate_stage(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(3000)]
    base = [" ".join(rng.choice(words, 200)) for _ in range(30)]
    rows = list(base)
    for t in base[:10]:
        w = t.split()
        rows += [t, " ".join([*w[:-3], "x", "y", "z"]), " ".join(["new", *w])]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").coalesce(1)
    kept = {r["doc_id"] for r in simhash.keep_one(spark, df, "").collect()}
    assert kept == set(range(30))


def _groups(rows):
    """The first row of each row's group, all pairs of texts compared by their five-word shingles."""
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in rows]
    first = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j]) if first[i] != first[j] else 0
            if both and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((first[i], first[j]))
                first = [a if x == b else x for x in first]
    return first


def test_near_duplicates_of_large_groups(spark, monkeypatch):
    """Against all pairs: copies near one base but not near each other, unlike texts around one passage, a chain; small blocks, few pairs listed."""
    rng = np.random.default_rng(13)
    words = np.array([f"w{i}" for i in range(5000)])
    base, passage = rng.choice(words, 100), rng.choice(words, 60)
    rows = [base.copy() for _ in range(150)]
    for r in rows[1:]:  # two words changed: 10 of 96 shingles, so 0.81 to the base and less to most others
        r[rng.choice(np.arange(5, 95), 2, replace=False)] = rng.choice(words, 2)
    rows += [np.concatenate([rng.choice(words, 8), passage, rng.choice(words, 8)]) for _ in range(150)]
    chain = rng.choice(words, 80)
    for _ in range(30):
        chain = np.concatenate([chain[3:], rng.choice(words, 3)])
        rows.append(chain)
    rows = [list(map(str, rows[i])) for i in rng.permutation(len(rows))]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)], "doc_id long, text string").coalesce(1)
    for listed, block in ((64, 1024), (8, 40)):
        monkeypatch.setattr(simhash, "LISTED", listed)
        monkeypatch.setattr(simhash, "BLOCK_ROWS", block)
        assert {r["doc_id"] for r in simhash.keep_one(spark, df, "").collect()} == set(_groups(rows))


def test_near_duplicates_leave_no_table_behind(spark):
    from impactory.functions.fixpoint import Scratch

    with Scratch(spark) as scope:
        df = spark.createDataFrame([(i, f"one two three four five six {i // 2}") for i in range(10)], "doc_id long, text string").coalesce(1)
        assert simhash.keep_one(spark, df, "").count() == 5
        assert {n.split("-")[0] for n in scope.files.names()} == {"numbered", "similar"}  # the rows, and the ids of those that go
    assert not scope.files.exists()


def test_near_duplicates_of_short_texts_and_common_passages(spark):
    """Against all pairs: a word appended or changed, and unlike texts around one passage."""
    rng = np.random.default_rng(11)
    words = [f"w{i}" for i in range(2000)]
    base = [list(rng.choice(words, n)) for n in rng.integers(8, 60, 80)]
    passage = list(rng.choice(words, 40))
    base += [[*rng.choice(words, 12), *passage] for _ in range(60)]
    rows = [*base, *([*w, "more"] for w in base[:110]), *(["other", *w[1:]] for w in base[:110])]

    def likeness(x, y):
        return len(x & y) / len(x | y)

    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in rows]
    first = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if first[i] != first[j] and likeness(sets[i], sets[j]) >= 0.8:
                a, b = sorted((first[i], first[j]))
                first = [a if x == b else x for x in first]
    df = spark.createDataFrame([(i, " ".join(map(str, w))) for i, w in enumerate(rows)], "doc_id long, text string").coalesce(1)
    assert {r["doc_id"] for r in simhash.keep_one(spark, df, "").collect()} == set(first)


ASSIGN = re.compile(r"""(?ia)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def test_secret_spans(spark, tmp_path):
    odd = ["token: secret: abcdefghijklmnop", "API_KEY='abcdefghijkl' apikey=short", "xAKIAABCDEFGHIJKLMN AKIA12", "é password = 漢 PASSWORD=abcdefABCDEF1", "deadbeefdeadbeef0 deadbeef", "a" * 40, "token=" + "A" * 5000]
    texts = {i: t for i, t in enumerate(odd)} | {i + 100: r["text"] for i, r in enumerate(spark.read.parquet(f"{SF}/documents.parquet").collect())}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    for r in secret_scan.op10_secret_scan(spark, str(tmp_path)).collect():
        t = texts[r["doc_id"]]
        assign = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 12]
        access = [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        hexes = [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
        base = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in sorted(assign + access + hexes))
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == (len(assign), len(access), len(hexes))
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert [s for s in r["spans"].split(",") if s and not s.startswith("random")] == [s for s in base.split(",") if s]


def test_randomness_battery_tells_secrets_from_words(spark):
    """Ordinary tokens are joined words of sentences (a pangram, all letters once, would pass for random)."""
    rng = np.random.default_rng(8)
    alphabet = list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
    secrets = ["".join(rng.choice(alphabet, 40)) for _ in range(60)]
    words = "there is no reason to believe that the people of this town were any less happy in those days than they are now and most of them would not have wanted to live in another place or at another time".split()
    plain = ["".join(words[k % 30 : k % 30 + 8])[:40] for k in range(60)]
    df = spark.createDataFrame([(i, f"see {s} here") for i, s in enumerate(secrets + plain)], "doc_id long, text string")
    rows = secret_scan.scan(df, secret_scan.cutoffs(df), F.col("text"), "found").select("doc_id", F.size("found.random").alias("n")).collect()
    hits = {r["doc_id"] for r in rows if r["n"]}
    assert len(hits & set(range(60))) >= 54 and not hits & set(range(60, 120))


def test_spot_signatures(spark, texts):
    order = sorted(texts)
    rows = {r["doc_id"]: r for r in spot_signatures.op9_spot_signatures(spark, SF).collect()}
    for i, k in enumerate(order):
        a, b = texts[k], texts[order[(i + 1) % len(order)]]
        q = len(a) // 4
        assert rows[k]["n_chars"] == len(a) and rows[k]["edited_sha256"] == hashlib.sha256((a[: len(a) - q] + b[:q]).encode()).hexdigest()
        assert 0 <= rows[k]["near_edited"] <= 1 and 0 <= rows[k]["near_next"] <= 1
    same: dict[str, set] = {}
    for k in order:
        same.setdefault(texts[k], set()).add(rows[k]["fingerprint"])
    assert all(len(v) == 1 for v in same.values())
    assert np.mean([r["near_edited"] > r["near_next"] for r in rows.values()]) > 0.9


def test_spot_signature_join_loses_no_pair(spark, docs):
    members, links = spot_signatures.near_duplicates(docs, 0.5)
    sets = {r["doc_id"]: frozenset(r["s"]) for r in spot_signatures.add_signatures(docs.select("doc_id", "text"), "text", "s").select("doc_id", "s").collect()}
    named: dict[frozenset, int] = {}
    for k in sorted(sets):
        named.setdefault(sets[k], k)
    assert {(r["doc_id"], r["class_id"]) for r in members.collect()} == {(k, named[s]) for k, s in sets.items()}
    ids = sorted(named.values())
    want = {(a, b) for a in ids for b in ids if a < b and len(sets[a] & sets[b]) >= 0.5 * len(sets[a] | sets[b])}
    assert {(r["a"], r["b"]) for r in links.collect()} == want


def test_languages_on_held_out_rows(spark, docs):
    got = language_id.op8_language_id(spark, SF).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)


def test_texts_without_a_letter_have_no_language(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr"), (3, "½ ² ① Ⅷ 12 --", "en"), (4, "", "en"), (5, None, "en"), (6, "m²", "en"), (7, "_ \u0301", "fr")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["p"]["lang_pred"] for r in df.select("doc_id", language_id.identify(df, F.col("text"), language_id.fit(df)).alias("p")).collect()}
    assert {k for k, v in got.items() if v == "und"} == {3, 4, 5, 7} and got[1] == "en" and got[2] == "fr"


def test_quality_on_held_out_rows(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = line_quality.op6_quality(spark, SF).where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r["quality"] == r["predicted"] for r in got]) > 0.85


def test_marginals_of_the_field_against_all_labellings():
    rng = np.random.default_rng(4)
    field = line_quality.Field(rng.normal(size=(line_quality.WIDTH + 1, 2)), rng.normal(size=(2, 2)))
    field.weights[line_quality.WIDTH] = 0
    bins, _, n = line_quality.line_bins(["One line.\nTWO!!\nthree | three\n", "single"])
    ids = line_quality.feature_ids(bins, n)
    good, _, _ = field.marginals(ids, n)
    at = 0
    for size in n:
        s = field.weights[ids[at : at + size]].sum(axis=1)
        total, each = 0.0, np.zeros(size)
        for code in range(2**size):
            y = [code >> k & 1 for k in range(size)]
            w = math.exp(sum(s[k, y[k]] for k in range(size)) + sum(field.moves[y[k - 1], y[k]] for k in range(1, size)))
            total += w
            each += w * np.array(y)
        assert good[at : at + size] == pytest.approx(each / total)
        at += size


def test_toxicity_chain(spark):
    """At the next scale: the smallest has eleven toxic labels, too few to learn from."""
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").withColumnRenamed("toxic", "label")
    got = toxicity.op4_toxicity(spark, sf).join(labels, "doc_id").collect()
    assert np.mean([r["label"] == r["toxic"] for r in got]) > 0.93
    assert all(r["toxic"] == 0 for r in got if not r["label"])


def test_chroma_aligns_a_shifted_passage(spark):
    rng = np.random.default_rng(6)
    make = lambda n: " ".join("".join(rng.choice(list("abcdefghijklmnop"), 5)) for _ in range(n))
    a, b = make(600), make(600)
    df = spark.createDataFrame([(100, a), (1, make(80) + " " + a), (2, b), (3, a)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in chroma.align(df).collect()}
    assert rows[1]["query_id"] == 100 and rows[1]["offset"] < 0 and rows[1]["bit_error_rate"] < 0.1
    assert rows[3]["query_id"] == 100 and rows[3]["bit_error_rate"] == 0 and rows[3]["class_id"] == 3 and rows[100]["class_id"] == 3
    assert rows[2]["query_id"] is None


def _chroma_pairs(texts, query=100):
    """Alignments of every row with the other rows that are queries, all pairs compared: {id: {query: (offset, votes)}}."""
    packed = {k: b"".join(chroma.packed(chroma.frames_of_text(t))) for k, t in texts.items()}
    out = {}
    for k, x in packed.items():
        found = {q: a for q, y in packed.items() if q % query == 0 and q != k and (a := chroma.alignment(x, y))}
        out[k] = {q: a[:2] for q, a in found.items()}
    return packed, out


def test_chroma_keeps_every_query_of_a_passage(spark):
    rng = np.random.default_rng(7)
    make = lambda n: " ".join("".join(rng.choice(list("abcdefghijklmnop"), 5)) for _ in range(n))
    passage, other, whole = make(300), make(300), make(400)
    texts = {100: f"{make(60)} {passage}", 200: f"{passage} {make(90)}", 300: f"{make(20)} {passage} {make(50)}", 400: other, 500: whole, 600: whole}
    texts |= {1: passage, 2: f"{passage} {make(70)} {other}", 3: f"{make(30)} {passage} {make(40)} {passage}", 4: whole, 5: make(300), 6: "word " * 5000, 700: "word " * 4000}
    rows = {r["doc_id"]: r for r in chroma.align(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    packed, expected = _chroma_pairs(texts)
    for k, want in expected.items():
        least = {}  # queries with equal integers go by the smallest
        for q in sorted(want):
            least.setdefault(packed[q], q)
        assert {a["query_id"]: (a["offset"], a["votes"]) for a in json.loads(rows[k]["alignments"])} == {q: want[q] for q in least.values()}
    assert {100, 200, 300} <= set(expected[1]) and {100, 200, 300, 400} <= set(expected[2]) and set(expected[100]) == {200, 300}
    assert rows[500]["query_id"] == 600 and rows[600]["query_id"] == 500 and rows[4]["query_id"] == 500
    assert len(chroma.columns(*(chroma.landmarks(np.frombuffer(packed[k], "<u4")) for k in (3, 1)))[0]) >= 2


@pytest.mark.parametrize("bytes_", [chroma.QUERY_BYTES, 4000])
def test_chroma_of_near_copies_writes_no_pairs(spark, monkeypatch, bytes_):
    """Near copies, half of them queries: every alignment of all pairs, from tables that grow with the rows, in one block of queries and in several."""
    rng = np.random.default_rng(12)
    passage = rng.integers(0, 10_000, 150)
    texts = {50 * k: " ".join(map(str, [*passage[:60], *rng.integers(0, 10_000, 4), *passage[60:]])) for k in range(1, 61)}
    written = {}

    def counting(df, name):
        out = materialize(df, name)
        written[name] = out.count()
        return out

    materialize = chroma.materialize
    monkeypatch.setattr(chroma, "materialize", counting)
    monkeypatch.setattr(chroma, "QUERY_BYTES", bytes_)
    monkeypatch.setattr(chroma, "PART_PAIRS", 100)
    rows = {r["doc_id"]: r for r in chroma.align(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    packed, expected = _chroma_pairs(texts)
    assert len(set(packed.values())) > 50 and sum(map(len, expected.values())) > 1500 and max(written.values()) <= len(texts)
    for k, want in expected.items():
        least = {}
        for q in sorted(want):
            least.setdefault(packed[q], q)
        assert {a["query_id"]: (a["offset"], a["votes"]) for a in json.loads(rows[k]["alignments"])} == {q: want[q] for q in least.values()}


def test_chroma_of_recordings_that_differ_at_their_end(spark):
    """Equal integers but for the last places: classes of their own, with alignments of their own."""
    rng = np.random.default_rng(13)
    start = rng.integers(0, 10_000, 60)
    texts = {50 * k: " ".join(map(str, [*start, *rng.integers(0, 10_000, 3)])) for k in range(1, 61)}
    parts = [chroma.packed(chroma.frames_of_text(t)) for t in texts.values()]
    assert len({x for x, _ in parts}) < len(set(parts))
    packed, expected = _chroma_pairs(texts)
    for order in (1, -1):  # whichever of them is read first
        df = spark.createDataFrame(list(texts.items())[::order], "doc_id long, text string")
        rows = {r["doc_id"]: r for r in chroma.align(df).collect()}
        for k, want in expected.items():
            least = {}
            for q in sorted(want):
                least.setdefault(packed[q], q)
            assert {a["query_id"]: (a["offset"], a["votes"]) for a in json.loads(rows[k]["alignments"])} == {q: want[q] for q in least.values()}


def test_chroma_finds_short_passages_and_edited_copies(spark, texts):
    """Of real texts: passages set into another text, and copies with a word changed every 20 words."""
    rng = np.random.default_rng(9)
    long = sorted({t for t in texts.values() if 150 <= len(t.split()) <= 1000})
    words = [t.split() for t in long]
    some, plain = [w for ws in words for w in ws], {}
    rows, planted, k = [], {}, 0
    for i in range(40):
        own, host = words[i], words[-1 - i]
        rows.append((100 * (i + 1), " ".join(own)))
        for kind, n in (("passage", 60), ("passage", 100), ("edited", 150)):
            k += 1
            new = own[10 : 10 + n]
            if kind == "edited":
                new = [str(rng.choice(some)) if j % 20 == 10 else w for j, w in enumerate(new)]
            else:
                at = int(rng.integers(len(host)))
                new = host[:at] + new + host[at:]
            rows.append((100000 + k + k // 99, " ".join(new)))
            planted[rows[-1][0]] = (100 * (i + 1), kind, n)
    plain = dict(rows)
    got = {r["doc_id"]: {a["query_id"] for a in json.loads(r["alignments"])} for r in chroma.align(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    packed, every = _chroma_pairs(plain)
    least = {}
    for q in sorted(q for q in packed if q % 100 == 0):
        least.setdefault(packed[q], q)
    hit = Counter((kind, n) for d, (q, kind, n) in planted.items() if least[packed[q]] in got[d])
    for d in planted:  # nothing that all pairs show is lost
        assert got[d] == {least[packed[q]] for q in every[d]}
    assert hit["passage", 60] >= 22 and hit["passage", 100] >= 36 and hit["edited", 150] >= 18


def test_chroma_votes_against_all_pairs_of_places(monkeypatch):
    rng = np.random.default_rng(8)
    x, y = ((np.sort(rng.integers(0, 4, n).astype(np.uint64)), rng.integers(0, 200, n)) for n in (90, 70))
    for plain in (0, 300, 1 << 20):
        monkeypatch.setattr(chroma, "PLAIN", plain)
        votes: dict[int, int] = {}
        for k, p in zip(*x, strict=True):
            for m, q in zip(*y, strict=True):
                if k == m:
                    votes[int(q - p)] = votes.get(int(q - p), 0) + 1
        assert dict(zip(*(a.tolist() for a in chroma.columns(x, y)), strict=True)) == votes


def test_chroma_of_tones():
    rate = 11025
    t = np.arange(rate * 3) / rate
    frames = chroma.frames_of_sound(np.sin(2 * np.pi * 440 * t) + np.sin(2 * np.pi * 523.25 * t), rate)
    assert set(np.argsort(frames.sum(axis=0))[-2:]) == {0, 3}
    assert len(chroma.integers(frames)) == max(1, len(frames) - chroma.SPAN + 1)


def test_toxicity_on_rows_that_it_has_not_seen(spark, tmp_path):
    """Learnt from the labels of one half, held against those of the other."""
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{sf}/labels.parquet")
    half = F.xxhash64(F.lit(5), "doc_id") % 2 == 0
    model = toxicity.fit(docs, labels.where(half))
    rest = docs.join(labels.where(~half & F.col("toxic").isNotNull()), "doc_id")
    got = rest.select("toxic", (toxicity.probabilities(spark, F.col("text"), model)["toxic"] >= toxicity.REJECT).alias("rejected")).collect()
    caught = [r["rejected"] for r in got if r["toxic"]]
    spared = [not r["rejected"] for r in got if not r["toxic"]]
    assert np.mean(caught) > 0.8 and np.mean(spared) > 0.98


def test_a_repeated_labelled_row_does_not_reach_the_driver_twice(spark):
    df = spark.createDataFrame([(1, "a b c")] * 500 + [(2, "d"), (3, "e f")], "doc_id long, text string")
    from impactory.llm.common import one_row_each, within

    assert sorted(r["doc_id"] for r in within(one_row_each(df), "text", 1000)) == [1, 2, 3]
    assert len(within(one_row_each(df), "text", 5)) < 3
