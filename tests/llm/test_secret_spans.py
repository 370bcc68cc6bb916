"""Random spans of the secret scan against the battery worked out token by token."""

import math
import random
import re
from collections import Counter

from impactory.llm import secret_scan

TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
KINDS = [("[0-9]+", DIGITS), ("[0-9a-f]+|[0-9A-F]+", DIGITS + "abcdef"), ("[a-z]+", LOWER), ("[A-Z]+", UPPER), ("[A-Z2-7]+=*", UPPER + "234567"), ("[A-Za-z0-9]+", UPPER + LOWER + DIGITS), (".*", UPPER + LOWER + DIGITS + "+/")]


def kind_of(bare):
    return next(i for i, (p, _) in enumerate(KINDS) if re.fullmatch(p, bare))


def scores(bare):
    """(uniform, runs, serial), None where there is none."""
    n, k = len(bare), len(KINDS[kind_of(bare)][1])
    if n < 2:
        return None, None, None
    uniform = (sum(c * c for c in Counter(bare).values()) * k / n - n - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n)
    x = [ord(c) for c in bare]
    mean = sum(x) / n
    spread = sum((a - mean) ** 2 for a in x)
    serial = (sum((a - mean) * (b - mean) for a, b in zip(x, x[1:])) / spread * n + 1) / math.sqrt(n) if spread > 1e-9 else None
    high = [a > mean for a in x]
    expect = 2 * sum(high) * (n - sum(high)) / n + 1
    var = (expect - 1) * (expect - 2) / (n - 1)
    runs = (1 + sum(a != b for a, b in zip(high, high[1:])) - expect) / math.sqrt(var) if var > 0 else None
    return uniform, runs, serial


def tail(z):
    return 1 / (1 + math.exp(-1.5976 * z - 0.07056 * z**3))


def brute(texts):
    """The places of random tokens in each text."""
    texts = [t or "" for t in texts]
    seen = Counter("".join(TOKEN.sub(" ", t) for t in texts))
    whole = sum(secret_scan.LETTERS.values())
    for c, share in secret_scan.LETTERS.items():
        seen[c] += 10_000 * 0.9 * share / whole
        seen[c.upper()] += 10_000 * 0.05 * share / whole
    for c in DIGITS:
        seen[c] += 10_000 * 0.05 / 10
    tokens = [t.rstrip("=") for text in texts for t in TOKEN.findall(text)]
    usual = {}
    for i, (_, alphabet) in enumerate(KINDS):
        total = sum(seen[c] for c in alphabet)
        two = sum((seen[c] / total) ** 2 for c in alphabet)
        three = max(0.0, sum((seen[c] / total) ** 3 for c in alphabet) - two**2)
        sizes = []
        for j in (1, 2):
            all_ = [abs(s) for s in (scores(b)[j] for b in tokens if kind_of(b) == i) if s is not None]
            mean = sum(all_) / len(all_) if all_ else 0.7979
            sizes.append((mean, max(0.1, math.sqrt(sum((a - mean) ** 2 for a in all_) / len(all_)) if all_ else 0.6028)))
        usual[i] = two, three, *sizes

    def place(bare):
        n, (uniform, runs, serial), (two, three, of_runs, of_serial) = len(bare), scores(bare), usual[kind_of(bare)]
        size, k = int(math.log2(max(n, 1))), len(KINDS[kind_of(bare)][1])
        if runs is None or serial is None:
            return size, -1
        wide = math.sqrt(2 * (k - 1) * (n - 1) / n)
        mean = (n - 1) * (k * two - 1) / wide
        spread = math.sqrt(1 + 4 * k * k * n * three / wide**2)
        tests = [((uniform - mean) / spread, mean / spread)]
        tests += [((abs(x) - m) / s, max(0.0, (m - 0.7979) / s)) for x, (m, s) in ((runs, of_runs), (serial, of_serial))]
        z = sum(x * w for x, w in tests) / math.sqrt(sum(w * w for _, w in tests)) if mean > 0 else 0
        both = max(4 * tail(-abs(runs)) * tail(-abs(serial)), 1e-300)
        if mean <= 0 or both - both * math.log(both) < 0.001:
            return size, -1
        return size, math.floor(-10 * math.log10(max(tail(z), 1e-30)))

    places = [place(b) for b in tokens]
    found = set()
    for size in {s for s, _ in places}:
        bins = [b for s, b in places if s == size]
        held = [b for b in set(bins) if b >= 0 and 10 ** (-b / 10) <= 0.01 * sum(x >= b for x in bins) / len(bins)]
        found |= {(size, b) for b in set(bins) if held and b >= min(held)}
    return [[(m.start(), m.end()) for m in TOKEN.finditer(t) if place(m.group().rstrip("=")) in found] for t in texts]


def test_random_spans_against_brute_force(spark, tmp_path):
    rng = random.Random(7)
    words = "the and of model light water stone river house garden letter window morning engine table paper".split()

    def token(alphabet, n):
        return "".join(rng.choice(alphabet) for _ in range(n))

    keys = [token(UPPER + LOWER + DIGITS + "+/", n) for n in (20, 24, 40, 64, 300) for _ in range(12)] + [token(DIGITS + "abcdef", n) for n in (32, 64) for _ in range(8)]
    keys += [token(UPPER + "234567", 32) + "==", token(UPPER + LOWER + DIGITS, 40), token(LOWER, 40), token(UPPER, 40), token(DIGITS, 30)]
    plain = ["_".join(rng.choices(words, k=rng.randint(4, 9))) for _ in range(150)] + ["".join(rng.choices(words, k=6)) for _ in range(60)]
    plain += ["=" * 30, "a" * 40, "ab" * 30, "-" * 5000, "a=" * 15, "01" * 12, LOWER]
    texts = [None, "", "   ", "no candidates here"]
    for x in keys + plain:
        texts.append(" ".join(rng.choices(words, k=rng.randint(0, 30)) + ["é漢" + rng.choice(["(", ": ", "😀"]) + x] + rng.choices(words, k=5)))
    texts += texts[4:40] + [texts[10] + "\n" + texts[50] + "," + texts[11], " ".join(keys + words * 500 + plain)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    df.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: [tuple(map(int, s.split(":")[1:])) for s in r["spans"].split(",") if s.startswith("random:")] for r in secret_scan.op10_secret_scan(spark, str(tmp_path)).collect()}
    want = brute(texts)
    assert [got[i] for i in range(len(texts))] == want
    hit = {texts[i][a:b] for i, spans in enumerate(want) for a, b in spans}
    assert len(hit & set(keys)) > len(keys) / 2 and len(hit & set(plain)) < 10
