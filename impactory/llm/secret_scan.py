"""Secrets: fixed patterns, and a battery of randomness tests over long tokens.

Candidates of the battery are runs of LEAST or more characters of the base64 alphabets. For each the
encoding is inferred (decimal, hex, letters of one case, base32, alphanumeric, base64), and over the
symbols of that alphabet

    uniformity   chi-squared of the symbol counts, as a normal score of a random token's mean and variance
    runs         of symbols above and below the token's middle, against Wald and Wolfowitz's moments
    serial       correlation of neighbouring symbols

Each score is compared with what ordinary tokens of the encoding have. For uniformity that follows from how
often each symbol occurs in all texts outside of candidates: the mean and the variance of the chi-squared of so many symbols
drawn from there, which grow with length, so short tokens can't be told apart. For the other two it is the
mean and the deviation of the scores' sizes over all candidates of the encoding. The three distances are
combined by Stouffer's rule, each weighing as much as ordinary and random tokens differ in it, to
one p-value: the chance that an ordinary token is as much like a random one. A token whose runs and serial
correlation together (Fisher's rule) would be rejected for a random one at REJECT is none.

False discoveries are held at RATE within each length class (powers of two) by Benjamini and Hochberg's
rule over all candidates of the table, on p-values in tenths of a decade. The texts are read once for that:
their distinct runs of symbols are counted before they are shuffled and written with their numbers; symbols are
counted in the short ones, each long one is scored once, and the cut-offs, a few numbers, are applied in a last pass.
Everything is built-in DataFrame functions.

Rows: a null text is empty and has no span; very long texts are scanned whole, in time linear in their
matches but for a small factor; repeated rows and equal candidates get equal verdicts (ties have one
bin); an empty table gives no rows. Only doc_id and text are read; the pipeline stage keeps all columns,
whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, load, materialize, small_tables

# Fixed patterns and least lengths.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "random")

LEAST, RATE, REJECT = 20, 0.01, 0.001
TOKEN = rf"[A-Za-z0-9+/_=-]{{{LEAST},}}"
GAP = r"[^A-Za-z0-9+/_=-]+"
#: Encodings in the order in which they are tried: name, pattern, symbols.
DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
ENCODINGS = (
    ("decimal", "^[0-9]+$", (DIGITS,)),
    ("hex", "^([0-9a-f]+|[0-9A-F]+)$", (DIGITS + "abcdef",)),
    ("lower", "^[a-z]+$", (LOWER,)),
    ("upper", "^[A-Z]+$", (LOWER.upper(),)),
    ("base32", "^[A-Z2-7]+=*$", (LOWER.upper() + "234567",)),
    ("alphanumeric", "^[A-Za-z0-9]+$", (LOWER.upper() + LOWER + DIGITS,)),
    ("base64", "", (LOWER.upper() + LOWER + DIGITS + "+/",)),
)
SYMBOLS = LOWER.upper() + LOWER + DIGITS + "+/"
#: Shares of the letters in English, in per cent. PRIOR characters of it count with the texts, so that little text tells something too.
LETTERS = {
    "a": 8.2, "b": 1.5, "c": 2.8, "d": 4.3, "e": 12.7, "f": 2.2, "g": 2.0, "h": 6.1, "i": 7.0, "j": 0.15, "k": 0.8, "l": 4.0, "m": 2.4,
    "n": 6.7, "o": 7.5, "p": 1.9, "q": 0.1, "r": 6.0, "s": 6.3, "t": 9.1, "u": 2.8, "v": 1.0, "w": 2.4, "x": 0.15, "y": 2.0, "z": 0.07,
}
PRIOR, UPPER_SHARE, DIGIT_SHARE = 10_000, 0.05, 0.05
BINS = 300
#: Mean and deviation of the size of a standard normal number, and the least deviation of a score.
HALF_MEAN, HALF_SPREAD, LEAST_SPREAD = 0.7979, 0.6028, 0.1
#: Matches summed in one step.
STEP = 256


def running(x: Column, start: int, add) -> Column:
    """For each number of an array what add makes of start and those before it, in steps of STEP."""
    zero = F.lit(start).cast("long")

    def chunked(t: Column) -> Column:
        last = F.floor((F.size(t["x"]) - 1) / STEP).cast("int")
        return let(summed, chunks=F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(t["x"], i * STEP + 1, F.lit(STEP))))

    def summed(t: Column) -> Column:
        return let(joined, chunks=t["chunks"], totals=F.transform(t["chunks"], lambda c: F.aggregate(c, zero, add)))

    def joined(t: Column) -> Column:
        bases = F.transform(t["totals"], lambda _, i: F.aggregate(F.slice(t["totals"], F.lit(1), i), zero, add))
        return F.flatten(F.zip_with(t["chunks"], bases, lambda c, b: F.transform(c, lambda _, j: add(b, F.aggregate(F.slice(c, F.lit(1), j), zero, add)))))

    return F.when(F.size(x) > 0, let(chunked, x=x)).otherwise(F.array().cast("array<bigint>"))


def found(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches with their places in code points: array of (start, end, token)."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(t: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(t["hits"]))
        pairs = F.zip_with(gaps, t["hits"], lambda g, h: F.struct(F.length(g).cast("long").alias("gap"), F.length(h).cast("long").alias("long"), h.alias("token")))
        return let(summed, pairs=pairs)

    def summed(t: Column) -> Column:
        before = running(F.transform(t["pairs"], lambda p: p["gap"] + p["long"]), 0, lambda a, b: a + b)
        return F.zip_with(t["pairs"], before, lambda p, b: F.struct((b + p["gap"]).alias("start"), (b + p["gap"] + p["long"]).alias("end"), p["token"].alias("token")))

    return F.when(F.regexp_like(text, F.lit(pattern)), let(placed, hits=hits)).otherwise(F.array().cast("array<struct<start:bigint,end:bigint,token:string>>"))


def normal_tail(z: Column) -> Column:
    """About the normal distribution function; monotone."""
    return 1 / (1 + F.exp(-1.5976 * z - 0.07056 * z * z * z))


def let(body, **values: Column) -> Column:
    """body of the values, each computed once however often body names it."""
    return F.get(F.transform(F.array(F.struct(*(v.alias(k) for k, v in values.items()))), body), F.lit(0))


def battery(token: Column) -> Column:
    """(n, kind, uniform, runs, serial) of a candidate; the scores are null where they don't exist."""
    bare = F.regexp_replace(token, "=+$", "")
    zero = F.struct(*(F.lit(v).alias(a) for a, v in (("s", 0.0), ("q", 0.0))))

    def symbols(t: Column) -> Column:
        return let(moments, bare=t["bare"], chars=F.filter(F.split(t["bare"], ""), lambda c: c != ""), n=F.length(t["bare"]).cast("double"))

    def moments(t: Column) -> Column:
        codes = F.transform(t["chars"], lambda c: F.ascii(c).cast("double"))
        return let(centred, bare=t["bare"], chars=t["chars"], n=t["n"], codes=codes, sums=F.aggregate(codes, zero, lambda a, x: F.struct((a["s"] + x).alias("s"), (a["q"] + x * x).alias("q"))))

    def centred(t: Column) -> Column:
        mean = F.when(t["n"] > 0, t["sums"]["s"] / t["n"]).otherwise(0.0)
        return let(tested, bare=t["bare"], chars=t["chars"], n=t["n"], codes=t["codes"], mean=mean, spread=t["sums"]["q"] - t["sums"]["s"] * mean)

    def tested(t: Column) -> Column:
        n, chars, codes, mean = t["n"], t["chars"], t["codes"], t["mean"]
        kind = F.lit(len(ENCODINGS) - 1)
        for i in reversed(range(len(ENCODINGS) - 1)):
            kind = F.when(t["bare"].rlike(ENCODINGS[i][1]), F.lit(i)).otherwise(kind)
        squares = F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda acc, c: acc + F.pow(F.size(F.filter(chars, lambda x: x == c)).cast("double"), F.lit(2.0)))
        next_to = F.zip_with(F.slice(codes, 1, F.greatest(F.size(codes) - 1, F.lit(0))), F.slice(codes, 2, F.greatest(F.size(codes) - 1, F.lit(0))), lambda x, y: F.struct(x.alias("x"), y.alias("y")))
        pairs = F.aggregate(next_to, zero, lambda a, p: F.struct((a["s"] + (p["x"] - mean) * (p["y"] - mean)).alias("s"), (a["q"] + F.when((p["x"] > mean) != (p["y"] > mean), 1.0).otherwise(0.0)).alias("q")))
        above = F.size(F.filter(codes, lambda x: x > mean)).cast("double")
        return let(scored, n=n, kind=kind, squares=squares, lag=pairs["s"], turns=pairs["q"] + 1.0, above=above, spread=t["spread"])

    def scored(t: Column) -> Column:
        n, k = t["n"], pick(t["kind"], [float(len(e[2][0])) for e in ENCODINGS])
        uniform = (t["squares"] * k / n - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
        serial = F.when(t["spread"] > 0, (t["lag"] / t["spread"] * n + 1) / F.sqrt(n))
        expect = 2 * t["above"] * (n - t["above"]) / n + 1
        var = (expect - 1) * (expect - 2) / (n - 1)
        runs = F.when(var > 0, (t["turns"] - expect) / F.sqrt(var))
        return F.struct(n.alias("n"), t["kind"].alias("kind"), *(F.when(n >= 2, c).alias(name) for name, c in (("uniform", uniform), ("runs", runs), ("serial", serial))))

    return let(symbols, bare=bare)


def pick(kind: Column, values: list[float]) -> Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), kind + 1)


def verdict(b: Column, usual: list[dict[str, float]]) -> Column:
    """(length class, bin of the p-value) of a candidate's scores; bin -1 where it can't be random."""

    def of(name: str) -> Column:
        return pick(b["kind"], [float(u[name]) for u in usual])

    n, k = b["n"], pick(b["kind"], [float(len(e[2][0])) for e in ENCODINGS])
    wide = F.sqrt(2 * (k - 1) * (n - 1) / n)
    mean = (n - 1) * (k * of("two") - 1) / wide
    spread = F.sqrt(1 + 4 * k * k * n * of("three") / (wide * wide))
    tests = [((b["uniform"] - mean) / spread, mean / spread)]
    for name in ("runs", "serial"):
        tests.append(((F.abs(b[name]) - of(f"{name}_mean")) / of(f"{name}_spread"), F.greatest(F.lit(0.0), (of(f"{name}_mean") - HALF_MEAN) / of(f"{name}_spread"))))
    z = sum(x * w for x, w in tests) / F.sqrt(sum(w * w for _, w in tests))
    p = F.greatest(normal_tail(z), F.lit(10.0 ** (-BINS / 10)))
    # Fisher's rule for two: the chance that the product of two uniform numbers is below x is x - x * log(x).
    both = F.greatest(4 * normal_tail(-F.abs(b["runs"])) * normal_tail(-F.abs(b["serial"])), F.lit(1e-300))
    random = both - both * F.log(both) >= REJECT
    bin_ = F.when(b["runs"].isNotNull() & b["serial"].isNotNull() & random & (mean > 0), F.floor(-10 * F.log10(p)).cast("int")).otherwise(-1)
    return F.struct(F.floor(F.log2(F.greatest(n, F.lit(1.0)))).cast("int").alias("size"), F.coalesce(bin_, F.lit(-1)).alias("bin"))


def runs_of_symbols(docs: DataFrame) -> DataFrame:
    """The distinct runs of the candidates' characters in all texts, and how often each occurs."""
    run = F.explode(F.split(F.coalesce("text", F.lit("")), GAP)).alias("run")
    return docs.select(run).where("run != ''").groupBy("run").agg(F.count("*").alias("times"))


def usual_scores(runs: DataFrame, scores: DataFrame) -> list[dict[str, float]]:
    """For each encoding what is usual: sums of its symbols' squared shares in all texts and so on, and the sizes of the candidates' scores."""
    plain = runs.where(F.length("run") < LEAST).select(F.explode(F.split("run", "")).alias("c"), "times")
    seen = {r["c"]: r["n"] for r in plain.where("c != ''").groupBy("c").agg(F.sum("times").alias("n")).collect()}  # a row for each character of the alphabets
    counts = {c: float(seen.get(c, 0)) for c in SYMBOLS}
    whole = sum(LETTERS.values())
    for c, share in LETTERS.items():
        counts[c] += PRIOR * (1 - UPPER_SHARE - DIGIT_SHARE) * share / whole
        counts[c.upper()] += PRIOR * UPPER_SHARE * share / whole
    for c in DIGITS:
        counts[c] += PRIOR * DIGIT_SHARE / 10

    def sizes(name: str) -> list[Column]:
        x = F.when(F.col(name).isNotNull(), F.struct(F.col("times").cast("double").alias("w"), F.abs(name).alias("x")))
        mean = F.sum(x["w"] * x["x"]) / F.sum(x["w"])
        return [mean.alias(f"{name}_mean"), F.sqrt(F.greatest(F.lit(0.0), F.sum(x["w"] * x["x"] * x["x"]) / F.sum(x["w"]) - mean * mean)).alias(f"{name}_spread")]

    by = {r["kind"]: r for r in scores.groupBy("kind").agg(*sizes("runs"), *sizes("serial")).collect()}  # a row for each encoding
    out = []
    for i, (_, _, (alphabet,)) in enumerate(ENCODINGS):
        total = sum(counts[c] for c in alphabet)
        shares = [counts[c] / total for c in alphabet] if total else [1 / len(alphabet)] * len(alphabet)
        two = sum(p**2 for p in shares)
        mine = {"two": two, "three": max(0.0, sum(p**3 for p in shares) - two**2)}
        for name in ("runs", "serial"):
            mean, spread = (by[i][f"{name}_{x}"] for x in ("mean", "spread")) if i in by else (None, None)
            mine |= {f"{name}_mean": HALF_MEAN if mean is None else mean, f"{name}_spread": max(LEAST_SPREAD, HALF_SPREAD if spread is None else spread)}
        out.append(mine)
    return out


@dataclass
class Cutoffs:
    """What is usual for each encoding, and for each length class the least bin that is still a discovery (none: no discovery)."""

    usual: list[dict[str, float]]
    bins: dict[int, int]


def cutoffs(docs: DataFrame) -> Cutoffs:
    runs = materialize(runs_of_symbols(docs), "runs")
    scores = materialize(runs.where(F.length("run") >= LEAST).select("times", battery(F.col("run")).alias("b")).select("times", "b.*"), "scores")
    usual = usual_scores(runs, scores)
    counts = scores.select("times", verdict(F.struct("n", "kind", "uniform", "runs", "serial"), usual).alias("v")).groupBy(F.col("v.size").alias("size"), F.col("v.bin").alias("bin")).agg(F.sum("times").alias("n"))
    by = Window.partitionBy("size")
    ranked = counts.select("size", "bin", F.sum("n").over(by).alias("m"), F.sum("n").over(by.orderBy(F.desc("bin"))).alias("k"))
    held = ranked.where((F.col("bin") >= 0) & (F.pow(F.lit(10.0), -F.col("bin") / 10) <= RATE * F.col("k") / F.col("m")))
    out = Cutoffs(usual, {r["size"]: r["bin"] for r in held.groupBy("size").agg(F.min("bin").alias("bin")).collect()})  # a row for each power of two
    for table in (runs, scores):
        discard(table)
    return out


def with_kind(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["end"].alias("end")))


def written(spans: Column) -> Column:
    """kind:start:end of spans by start, then kind, joined by commas."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, cuts: Cutoffs, text: Column, into: str) -> DataFrame:
    """docs with a struct column: assign, access, hex and random spans."""
    t = F.coalesce(text, F.lit(""))
    least = F.create_map(*(F.lit(x) for pair in cuts.bins.items() for x in pair)) if cuts.bins else None

    def random(s: Column) -> Column:
        return let(lambda v: (v["v"]["bin"] >= 0) & (v["v"]["bin"] >= F.coalesce(least[v["v"]["size"]], F.lit(BINS + 1))), v=let(lambda b: verdict(b["b"], cuts.usual), b=battery(s["token"])))

    assign = F.filter(found(t, ASSIGN), lambda s: F.length(F.regexp_extract(s["token"], ASSIGN, 2)) >= ASSIGN_LEAST)
    tested = F.filter(found(t, TOKEN), random) if cuts.bins else F.array().cast("array<struct<start:bigint,end:bigint,token:string>>")
    parts = [("assign", assign), ("access", found(t, ACCESS)), ("hex", found(t, HEX)), ("random", tested)]
    return docs.withColumn(into, F.struct(*(with_kind(k, c).alias(k) for k, c in parts)))


def op10_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Every document's spans: those of the fixed patterns, counted and digested, and all with the battery's."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    s = scan(docs, cutoffs(docs), F.col("text"), "found")
    base = F.concat("found.assign", "found.access", "found.hex")
    counts = [F.size(f"found.{k}").cast("long").alias(f"n_{k}") for k in KINDS]
    return s.select("doc_id", *counts, F.sha2(written(base).cast("binary"), 256).alias("base_sha256"), written(F.concat(base, F.col("found.random"))).alias("spans"))


def redact(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A pipeline stage: every span in text becomes [SECRET]; n_chars, where there is one, follows; no row goes.

    Spans that overlap become one. A null text stays null.
    """
    small_tables(spark)
    into = "__secrets"
    while into in docs.columns:
        into += "_"
    s = scan(docs, cutoffs(docs), F.col("text"), into)
    text = F.col("text")

    def cut(t: Column) -> Column:
        reached = running(F.transform(t["spans"], lambda x: x["end"]), 0, lambda a, b: F.greatest(a, b))

        def piece(x: Column, before: Column) -> Column:
            fresh = F.concat(F.substring(text, before.cast("int") + 1, (x["start"] - before).cast("int")), F.lit("[SECRET]"))
            return F.when((x["start"] >= before) & ((x["start"] > before) | (before == 0)), fresh).otherwise(F.when(x["start"] == before, F.lit("[SECRET]")).otherwise(F.lit("")))

        last = F.array_max(F.transform(t["spans"], lambda x: x["end"]))
        return F.concat(F.array_join(F.zip_with(t["spans"], reached, piece), ""), F.substring(text, last.cast("int") + 1, F.length(text)))

    spans = F.array_sort(F.concat(*(F.col(f"`{into}`.{k}") for k in KINDS)))
    clean = f"{into}_text"
    s = s.withColumn(clean, F.when(F.size(spans) > 0, let(cut, spans=spans)).otherwise(text))
    # The old text goes before the new one takes its name, or the length would be that of the new text cut again.
    s = s.select(*(F.col(f"`{c}`") for c in docs.columns if c != "text"), F.col(f"`{clean}`"), (F.size(spans) > 0).alias(into))
    length = F.when(F.col(f"`{into}`"), F.length(f"`{clean}`").cast("long")).otherwise(F.col("n_chars")).alias("n_chars") if "n_chars" in docs.columns else None
    return s.select(*(F.col(f"`{clean}`").alias("text") if c == "text" else length if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns))
