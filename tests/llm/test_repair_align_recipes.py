"""Repair of conversations, alignment of tokenizers and chunk recipes against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from impactory.llm import chunk_recipes, token_alignment, turn_repair
from impactory.llm.common import load

SF = "/root/testdata/sf0.001"
ODD = ["", " ", "  ", "a  b", "foo\n bar", "\n \nfoo", "x <|endoftext|> y<s> </s>", "it's  ok\t x", "İstanbul ΑΣ", "é́ 漢字。 word。.", "a" * 3000, "x▁y ▁z", "don't!! 'REally' 123 4,5", "　x \x85 y", " lead", "trail ", "\x00 a", "naïve ﬁ café", "😀😀 😀é", "1234567 89\r\n z"]
SAFE = re.compile("[^\x20\x09-\x0d]")
PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# Conversations


def rows_after_damage(rows):
    """By the contract, a row at a time; conversations to lists of (turn, role, text)."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return {c: sorted(x, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, x in out.items()}


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        solid = SAFE.findall(text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def all_repairs(rows, faults, most):
    """Every sequence of edits with so many insertions in a row at most: (cost, audit, lines)."""
    inserts = [[]] + [list(p) for n in range(1, most + 1) for p in product(("user", "assistant"), repeat=n)]

    def go(i):
        if i == len(rows):
            for block in inserts:
                yield 5 * len(block), "I" * len(block), [(r, "") for r in block]
            return
        _, role, text = rows[i]
        edits = [(2, "D", [])]
        if faults[i] not in ("blank", "duplicate"):
            late = 5 if faults[i] == "truncated" else 0
            edits += [(late, "K", [(role, text)]), *((late + 1, "R", [(r, text)]) for r in ("user", "assistant"))]
        rest = list(go(i + 1))
        for block in inserts:
            for cost, letter, line in edits:
                for c, a, lines in rest:
                    yield 5 * len(block) + cost + c, "I" * len(block) + letter + a, [(r, "") for r in block] + line + lines

    for cost, audit, lines in go(0):
        initials = "".join(r[:1] or "?" for r, _ in lines)
        if re.fullmatch("(s?(ua)+)?", initials):
            yield cost, audit, "\n".join(f"{r}:{t}" for r, t in lines)


def expected(rows, most=1):
    faults = faults_of(rows)
    cost, audit, text = min(all_repairs(rows, faults, most), key=lambda x: x[:2])
    turns = {t for t, *_ in rows if t is not None}
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(p not in ("su", "ua", "au") for p in pairs),
        "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256(text.encode()).hexdigest(),
    }


def test_program_against_all_edits():
    rng = random.Random(1)
    for n in range(140):
        rows = [(k, rng.choice(["user", "assistant", "system", "tool", ""]), rng.choice(["a.", "b!", "cut", "", "a."])) for k in range(rng.randint(0, 4))]
        codes = {"": 0, "blank": 1, "duplicate": 2, "truncated": 3}
        program = turn_repair.Repair(True)
        for (_, role, text), fault in zip(rows, faults_of(rows)):
            program.feed(role, text, codes[fault])
        cost, audit, digest, edits = program.end()
        want = expected(rows, 2 if len(rows) < 3 else 1)
        assert (cost, audit, digest) == (want["cost"], want["audit"], want["repaired_sha256"]), rows
        lines = list(program.repaired(edits, len(audit) - sum(len(turn_repair.EDITS[e]) for e in edits)))
        assert hashlib.sha256("\n".join(f"{r}:{t}" for r, t, _ in lines).encode()).hexdigest() == digest
        assert "".join(e for *_, e in lines) == audit.replace("D", "")


def test_repair_query_against_brute_force(spark, sf):
    """Every conversation of the awkward rows, and those of the test table with few rows."""
    for folder in (sf, SF):
        rows = [tuple(r) for r in load(spark, folder, "conversations").select("conv_id", "turn", "role", "text").collect()]
        got = {r["conv_id"]: r.asDict() for r in turn_repair.op11_turn_repair(spark, folder).collect()}
        after = rows_after_damage(rows)
        assert set(got) == set(after) == {r[0] for r in rows}
        for conv, x in after.items():
            if len(x) <= 5:
                want = expected(x)
                assert {k: got[conv][k] for k in want} == want, conv
            else:  # the counts that need no search
                assert [got[conv][f] for f in ("blank", "duplicate", "truncated")] == [faults_of(x).count(f) for f in ("blank", "duplicate", "truncated")]


def test_a_conversation_over_many_batches(spark, monkeypatch):
    """Ten thousand rows of one conversation, backpointers and rows on disk, equal to the program in one piece."""
    monkeypatch.setattr(turn_repair, "SPOOL", 1000)
    rng = random.Random(2)
    rows = [(1, k, rng.choice(["user", "assistant", "system"]), rng.choice(["x", "y."]) + str(k) + rng.choice([".", ""])) for k in range(10_000)]
    df = spark.createDataFrame(rows + [(2, 0, "user", "One."), (2, 1, "assistant", "Two.")], "conv_id long, turn long, role string, text string").withColumn("gone", F.lit(False)).repartition(7)
    got = {r["conv_id"]: r for r in turn_repair.reports(df).collect()}
    program = turn_repair.Repair(False)
    for _, _, role, text in rows:
        program.feed(role, text, 0 if text[-1] == "." else 3)
    cost, audit, digest, _ = program.end()
    assert (got[1]["cost"], got[1]["audit"], got[1]["repaired_sha256"]) == (cost, audit, digest) and got[2]["audit"] == "KK"
    lines = turn_repair.repair(df).where("conv_id = 1").orderBy("place").collect()
    assert [r["place"] for r in lines] == list(range(len(lines)))
    assert hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in lines).encode()).hexdigest() == digest
    # the cost of a cheapest repair, by a program over costs alone
    best = {0: 0}
    for _, _, role, text in rows:
        late, new = 0 if text[-1] == "." else 5, {}
        opened = best | {}
        for q, c in best.items():
            to = turn_repair.AFTER[q]
            opened[to] = min(opened.get(to, 10**9), c + 5)
        for q, c in opened.items():
            for to, extra in ((q, 2), (turn_repair.MOVES.get((q, role[0])), late), (turn_repair.AFTER[q], late + 1)):
                if to is not None:
                    new[to] = min(new.get(to, 10**9), c + extra)
        best = new
    assert cost == min(best.get(0, 10**9), best.get(3, 10**9), best.get(2, 10**9) + 5, best.get(1, 10**9) + 10)


def test_repair_of_an_empty_table(spark, bare):
    assert turn_repair.op11_turn_repair(spark, bare).collect() == []


# Tokenizers


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def groups_of(libraries, text):
    """Groups of one text by the ends its tokens have in common; none where bytes differ."""
    a, b = libraries
    if not text:
        return []
    from impactory.llm.packing import byte_chars

    chars, whole = byte_chars(), (" " + text).encode()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(chars[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in map(b.id_to_piece, ids_b)]
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return []
    ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
    out, first = [], 0
    for end in sorted(set(ends_a) & set(ends_b)):
        out.append(([i for i, e in zip(ids_a, ends_a) if first < e <= end], [i for i, e in zip(ids_b, ends_b) if first < e <= end]))
        first = end
    return out


def shown(found):
    return ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in found)


def test_alignment_against_the_libraries(spark, libraries):
    docs = load(spark, SF, "documents").select("doc_id", "text")
    odd = spark.createDataFrame([(10**6 + k, t) for k, t in enumerate([*ODD, None])] + [(None, "no id here"), (5, "twice"), (5, "twice")], "doc_id long, text string")
    rows = docs.where("length(text) < 6000").union(odd).repartition(5)
    found = [(r["doc_id"], groups_of(libraries, r["text"])) for r in rows.collect()]
    links = Counter((x[-1], y[-1]) for _, g in found for x, y in g)
    top = defaultdict(int)
    for (_, b), n in links.items():
        top[b] = max(top[b], n)
    want = Counter()
    for doc_id, g in found:
        pairs = [(x[-1], y[-1]) for x, y in g]
        sha = hashlib.sha256(shown(g).encode()).hexdigest() if g else ""
        want[doc_id, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), len(g), sum(links[p] == top[p[1]] for p in pairs), sum(links[p] for p in pairs), sha] += 1
    got = token_alignment.alignment(rows, *PATHS)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == want
    texts = {r["doc_id"]: r["groups"] for r in token_alignment.groups(odd, *PATHS).collect()}
    assert all(texts[10**6 + k] == shown(groups_of(libraries, t)) for k, t in enumerate(ODD))


def test_units_agree_with_whole_texts(libraries):
    """Random strings of awkward pieces, many in one batch."""
    rng = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "a", "the", "Über", "'s", "'", "123", "é", "é", "漢", "😀", "▁", "<s>", "<|endoftext|>", ".", "...", " ", "　", "\x00", "-", "ﬁ", "\r"]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 14))) for _ in range(3000)]
    aligned = token_alignment.Aligned(*PATHS)
    for text, units in zip(texts, token_alignment._split(aligned, texts)):
        got = [aligned.known[u] for u in units]
        assert (shown([]) if None in got else ";".join(g[2] for g in got)) == shown(groups_of(libraries, text)), repr(text)


def test_pointers_double_to_the_ends_of_components():
    rng = np.random.default_rng(5)
    for n in (1, 2, 50, 5000):
        a, b = (np.unique(np.append(rng.integers(1, 3 * n + 1, n), 3 * n + 1)) for _ in range(2))
        label = token_alignment.terminals(token_alignment.successors(a, b))
        ends = np.intersect1d(a, b)
        want = np.searchsorted(ends, np.concatenate([a, b]))
        assert np.array_equal(b[label - len(a)], ends[want])


# Chunk recipes


def test_recipes_against_equal_texts(spark):
    rng = random.Random(4)
    words = ["alpha", "beta", "gamma\n", "delta", "x" * 700, "ε"]
    base = [" ".join(rng.choices(words, k=rng.randint(0, 900))) for _ in range(30)]
    rows = [(k, t) for k, t in enumerate(rng.choices(base, k=150))] + [(1000 + k, base[0] + " " * k) for k in range(4)]
    rows += [(None, base[1]), (None, None), (None, "only nulls"), (None, "only nulls"), (7, base[2]), (7, base[2]), (2000, "word " * 40000), (2001, "word " * 40000), (2002, "y" * 100_000), (2003, "y" * 100_001), (2004, "y" * 600 + " " + "z" * 600), (2005, "y" * 600 + "z" * 600), (2006, "y" * 600 + "\n" + "z" * 600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("w", "chunks", "recipe", "hits", "keep_id", "times", "starts")}).repartition(6)
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    want = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for k, doc_id in enumerate(ids):
            want[doc_id, keep, len(ids), doc_id == keep and k == ids.index(keep), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in chunk_recipes.exact_groups(df).collect()) == want
    # a scheme of one hash of three bits gives many chunks the same identifier, is noticed and left
    assert chunk_recipes.clashes(df, 1, 3) > 0 and chunk_recipes.clashes(df, 2) == 0
    assert Counter(tuple(r) for r in chunk_recipes.exact_groups(df, 1, 3).collect()) == want


def test_chunks_are_the_text_and_shared(spark):
    rng = random.Random(6)
    passage = " ".join(f"w{rng.randint(0, 9999)}" for _ in range(1500))
    texts = ["", " ", "one", "a b  c\n\nd ", "x" * 5000, passage, "front " * 50 + passage, passage + " tail", "word " * 20000]
    rows = chunk_recipes.chunked(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    got = [r["chunks"] for r in rows]
    assert [r["between"].join(r["chunks"]) for r in rows] == texts and rows[4]["between"] == "" and rows[5]["between"] == " "
    assert len(set(got[5]) & set(got[6])) >= len(got[5]) - 2 and got[7][:-1] == got[5][:-1]
    assert len(got[4]) == 1 and max(len(c) for c in got[8]) <= 5 * chunk_recipes.MOST + 5


def test_recipes_use_no_python(spark):
    plan = chunk_recipes.op13_exact_dedup(spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
