"""Finding secrets: fixed patterns, and a battery of randomness tests on long tokens.

The battery asks of every token that could be a key whether it looks drawn at random from its alphabet. A key often hangs on a name or a path, so
the parts of a token between = signs, then also between slashes, then also between - and _, are tokens of their own. The alphabet is that of the
narrowest encoding that fits; letters alone have theirs. Three tests: chi-squared for equal use of the alphabet, the number of runs in its upper and lower half, and
the serial correlation of neighbours. The least p-value, times three, is the token's. Tokens are then dismissed as not random by the
Benjamini-Hochberg rule, on its own in each class of length, as a short token gives the tests less power: among the dismissed the
expected share of truly random ones is bounded in every class. What isn't dismissed is reported, but for tokens that hold a reported part.

Only DataFrame and SQL functions are used. Texts are read once; p-values are counted on a grid (rounded up) of fixed size for each class, so the
rule needs neither a sort nor a rank over all tokens, and only one number for each class comes to the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lynxrisk.llm.common import settle, text_or_empty

# The base patterns, and the least length of what counts.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_VALUE = 6

#: Candidates for the tests: runs of these characters. Each set has those of the next, so runs lie in one another or apart.
SIGNS = ["A-Za-z0-9+/=_-", "A-Za-z0-9+/_-", "A-Za-z0-9+_-", "A-Za-z0-9+"]
CANDIDATES = [f"(?<![{signs}])[{signs}]{{20,}}" for signs in SIGNS]
_UPPER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
_LOWER = _UPPER.lower()
#: Encodings from the narrowest: name, pattern of the whole token, alphabet.
ENCODINGS = [
    ("decimal", "^[0-9]+$", _DIGITS),
    ("hex", "^[0-9a-f]+$", _DIGITS + "abcdef"),
    ("hex_upper", "^[0-9A-F]+$", _DIGITS + "ABCDEF"),
    ("upper", "^[A-Z]+$", _UPPER),
    ("lower", "^[a-z]+$", _LOWER),
    ("base32", "^[A-Z2-7]+=*$", _UPPER + "234567"),
    ("base36", "^[0-9a-z]+$", _DIGITS + _LOWER),
    ("base36_upper", "^[0-9A-Z]+$", _DIGITS + _UPPER),
    ("letters", "^[A-Za-z]+$", _UPPER + _LOWER),
    ("base62", "^[0-9A-Za-z]+$", _DIGITS + _UPPER + _LOWER),
    ("base64", "^[0-9A-Za-z+/]+=*$", _UPPER + _LOWER + _DIGITS + "+/"),
    ("base64url", "^[0-9A-Za-z_-]+=*$", _UPPER + _LOWER + _DIGITS + "-_"),
    ("mixed", "", _UPPER + _LOWER + _DIGITS + "+/-_"),
]
#: Bits that a reported token must be able to hold.
LEAST_BITS = 64
SHARE = 0.05
GRID = 10_000
CLASSES = 48
_KINDS = ["assign", "access", "hex", "random"]


def matches(text: str, pattern: str) -> Column:
    """Leftmost non-overlapping matches of a pattern in a column: (start, text), by code points.

    What lies between the matches is as long as the pieces that the text is split into.
    """
    found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(F.col(text), pattern, -1), lambda g: F.length(g))
    none = F.array().cast("array<struct<start:int,m:string>>")

    def placed(both: Column) -> Column:
        def step(a: Column, m: Column) -> Column:
            start = a["at"] + F.get(both["gaps"], F.size(a["out"]))
            return F.struct((start + F.length(m)).alias("at"), F.array_append(a["out"], F.struct(start.alias("start"), m.alias("m"))).alias("out"))

        return F.aggregate(both["found"], F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda a: a["out"])

    worked_out = F.get(F.transform(F.array(F.struct(found.alias("found"), gaps.alias("gaps"))), placed), 0)
    return F.when(F.col(text).rlike(pattern), worked_out).otherwise(none)


def normal_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal, for z >= 0, to 1e-7 (the five-term rational approximation)."""
    t = F.lit(1.0) / (z * 0.2316419 + 1.0)
    poly = t * (t * (t * (t * (t * 1.330274429 - 1.821255978) + 1.781477937) - 0.356563782) + 0.319381530)
    return F.exp(-z * z / 2) * (1 / math.sqrt(2 * math.pi)) * poly


def _two_sided(z: Column) -> Column:
    return F.least(F.lit(1.0), normal_tail(F.abs(z)) * 2)


def battery(token: Column, alphabet: Column) -> Column:
    """p-value of a token against uniform draws from its alphabet: three times the least of the three tests'."""

    def tested(s: Column) -> Column:
        n, k = s["n"], s["k"]
        squares = F.aggregate(s["counts"], F.lit(0.0), lambda a, c: a + c * c)
        excess = (squares * k / n - n - (k - 1)) / F.sqrt(F.lit(2.0) * (k - 1) * (F.lit(1.0) - F.lit(1.0) / n))
        uniform = F.when(excess <= 0, F.lit(1.0)).otherwise(normal_tail(F.greatest(excess, F.lit(0.0))))
        high = F.aggregate(s["values"], F.lit(0.0), lambda a, v: a + F.when(v * 2 >= k, 1.0).otherwise(0.0))
        pairs = F.zip_with(F.slice(s["values"], 1, F.size(s["values"]) - 1), F.slice(s["values"], 2, F.size(s["values"]) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        runs = F.aggregate(pairs, F.lit(1.0), lambda a, p: a + F.when((p["a"] * 2 >= k) != (p["b"] * 2 >= k), 1.0).otherwise(0.0))
        both = high * (n - high) * 2
        spread = both * (both - n) / (n * n * (n - 1))
        run_p = F.when(spread > 0, _two_sided((runs - both / n - 1) / F.sqrt(spread))).otherwise(F.lit(0.0))
        mean = s["mean"]
        power = F.aggregate(s["values"], F.lit(0.0), lambda a, v: a + (v - mean) * (v - mean))
        together = F.aggregate(pairs, F.lit(0.0), lambda a, p: a + (p["a"] - mean) * (p["b"] - mean))
        serial = F.when(power > 0, _two_sided((together / power + F.lit(1.0) / n) * F.sqrt(n))).otherwise(F.lit(0.0))
        return F.least(F.lit(1.0), F.least(uniform, run_p, serial) * 3)

    bare = F.rtrim(token, F.lit("="))
    signs = F.filter(F.split(alphabet, ""), lambda c: c != "")
    counts = F.transform(signs, lambda c: (F.length(bare) - F.length(F.replace(bare, c, F.lit("")))).cast("double"))
    values = F.transform(F.filter(F.split(bare, ""), lambda c: c != ""), lambda c: (F.call_function("instr", alphabet, c) - 1).cast("double"))
    stats = F.struct(F.length(bare).cast("double").alias("n"), F.length(alphabet).cast("double").alias("k"), counts.alias("counts"), values.alias("values"))

    def with_mean(s: Column) -> Column:
        # worked out here, as a lambda would work it out again for each character
        mean = F.aggregate(s["values"], F.lit(0.0), lambda a, v: a + v) / s["n"]
        return F.struct(*[s[c].alias(c) for c in ("n", "k", "counts", "values")], mean.alias("mean"))

    return F.get(F.transform(F.transform(F.array(stats), with_mean), tested), 0)


def _alphabet(token: Column) -> Column:
    choice = F.lit(ENCODINGS[-1][2])
    for _, pattern, alphabet in reversed(ENCODINGS[:-1]):
        choice = F.when(token.rlike(pattern), F.lit(alphabet)).otherwise(choice)
    return choice


def runs(text: str) -> Column:
    """Tokens and their parts in a column, each once: (start, text)."""

    def once(all_: Column) -> Column:
        return F.filter(all_, lambda m, i: (i == 0) | (F.get(all_, i - 1) != m))

    found = F.sort_array(F.concat(*[matches(text, pattern) for pattern in CANDIDATES]))
    return F.get(F.transform(F.array(found), once), 0)


def narrowest(spans: Column) -> Column:
    """Spans that hold no other, of spans that lie in one another or apart."""
    ordered = F.sort_array(F.transform(spans, lambda c: F.struct(c["start"].alias("start"), (-c["end"]).alias("back"))))

    def kept(all_: Column) -> Column:
        # the first span after this one that starts at it or later lies in it or behind it
        return F.filter(all_, lambda c, i: F.coalesce(F.get(all_, i + 1)["back"] < c["back"], F.lit(True)))

    return F.transform(F.get(F.transform(F.array(ordered), kept), 0), lambda c: F.struct(c["start"].alias("start"), (-c["back"]).alias("end")))


def candidates(found: Column) -> Column:
    """(start, end, class, cell) of tokens to be tested: class of length, and p-value on the grid, rounded up."""
    with_alphabet = F.transform(found, lambda m: F.struct(m["start"].alias("start"), m["m"].alias("m"), _alphabet(m["m"]).alias("alphabet")))
    rich = F.filter(with_alphabet, lambda c: F.length(F.rtrim(c["m"], F.lit("="))) * F.log2(F.length(c["alphabet"])) >= LEAST_BITS)
    return F.transform(
        rich,
        lambda c: F.struct(
            c["start"].alias("start"),
            (c["start"] + F.length(c["m"])).alias("end"),
            F.least(F.floor(F.log2(F.length(c["m"])) * 2), F.lit(CLASSES - 1)).cast("int").alias("class"),
            F.greatest(F.ceil(battery(c["m"], c["alphabet"]) * GRID), F.lit(1)).cast("int").alias("cell"),
        ),
    )


def dismissal(scanned: DataFrame, share: float = SHARE) -> dict[int, int]:
    """For each class of length the largest grid cell that the Benjamini-Hochberg rule dismisses; classes without one are missing."""
    counts = scanned.select(F.explode("tested").alias("c")).groupBy("c.class", "c.cell").agg(F.count("*").alias("n"))
    by_class = Window.partitionBy("class")
    upto = counts.withColumn("upto", F.sum("n").over(by_class.orderBy("cell"))).withColumn("all", F.sum("n").over(by_class))
    passed = upto.filter(F.col("cell") / GRID <= F.col("upto") * share / F.col("all"))
    return {r[0]: r[1] for r in passed.groupBy("class").agg(F.max("cell")).collect()}  # at most CLASSES rows


def _spans(found: Column, kind: int) -> Column:
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), (m["start"] + F.length(m["m"])).alias("end")))


def joined_spans(spans: Column) -> Column:
    """kind:start:end of each span, in the order given, with commas between."""
    names = F.array(*[F.lit(k) for k in _KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def find_secrets(docs: DataFrame, share: float = SHARE) -> DataFrame:
    """Per row: doc_id, base and spans, arrays of (start, kind, end) by start, then kind.

    ``base`` has the matches of the fixed patterns: assignments to a name like password with a value of 6 characters or more, access keys, long runs
    of hex digits. ``spans`` has these and the tokens of 20 characters or more, or parts of such a length, that pass for random (kind ``random``),
    hold no part that does, and don't lie in a base span. Positions are code points from 0, end exclusive. A null text is empty; texts of any length are scanned
    whole. Kinds are numbers: 0 assign, 1 access, 2 hex, 3 random. Columns not read here don't matter.
    """
    text = docs.select("doc_id", text_or_empty(F.col("text")).alias("t"))
    assign = F.filter(matches("t", ASSIGN), lambda m: F.length(F.regexp_extract(m["m"], ASSIGN, 1)) >= LEAST_VALUE)
    base = F.array_sort(F.concat(_spans(assign, 0), _spans(matches("t", ACCESS), 1), _spans(matches("t", HEX), 2)))
    scanned = settle(text.select("doc_id", base.alias("base"), candidates(runs("t")).alias("tested")))
    limits = dismissal(scanned, share)
    limit = F.array(*[F.lit(limits.get(i, 0)) for i in range(CLASSES)])
    passed = narrowest(F.filter("tested", lambda c: c["cell"] > F.get(limit, c["class"])))
    random = F.filter(passed, lambda c: ~F.exists("base", lambda s: (s["start"] <= c["start"]) & (s["end"] >= c["end"])))
    more = F.transform(random, lambda c: F.struct(c["start"].alias("start"), F.lit(3).alias("kind"), c["end"].alias("end")))
    return scanned.select("doc_id", "base", F.array_sort(F.concat("base", more)).alias("spans"))
