"""Secrets in texts: fixed patterns, and long runs of characters that look random.

A run of encoded characters is judged by a battery of randomness tests in the encoding it fits: a chi-squared test of
uniform use of the alphabet, a runs test (low and high symbols in turn) and the serial correlation of neighbours. Words
use few symbols, and often; how much larger that makes the chi-squared sum is known for each length, so the sum gives
the probability that a text-like run of this length looks as even as the run at hand. A run is reported where that probability
passes the Benjamini-Hochberg bound among all runs of about its length, and the other tests find no pattern. Short runs
can't reach small probabilities and are held to their own bound.

Everything is built-in expressions; the driver sees one histogram of fixed size.
"""

from pyspark.sql import Column, DataFrame, functions as F

from risklake.operators.stage import stage

#: kinds in the order in which they are listed, and their patterns
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
RANDOM = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "random": RANDOM}
ASSIGN_VALUE = 12
#: encodings in the order in which they are tried: pattern, alphabet, and for text-like strings in it the chances that
#: two, and that three, symbols are the same
ENCODINGS = (
    ("decimal", r"^[0-9]+$", "0123456789", 0.20, 0.050),
    ("hex", r"^([0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef", 0.20, 0.050),
    ("base32", r"^[A-Z2-7]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 0.067, 0.0056),
    ("base64", r"^.+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 0.067, 0.0056),
)
#: false discoveries allowed, upper ends of the length classes, the level of the pattern tests, steps of the histogram
FALSE_RATE, LENGTH_CLASSES, PATTERN_LEVEL, STEPS, MOST_STEPS = 0.05, (24, 32, 48, 96), 0.001, 20, 400
_BLOCK = 128


def _fold(values: Column, first: Column) -> Column:
    """``first`` and the running sums after each value."""
    return F.aggregate(values, F.array(first), lambda sums, x: F.array_append(sums, F.element_at(sums, -1) + x))


def running(values: Column) -> Column:
    """Sum of all values before each one. Appending to an array copies it, so values go by blocks."""
    last = F.floor((F.size(values) - 1) / F.lit(_BLOCK)).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(values, b * _BLOCK + 1, F.lit(_BLOCK)))
    zero = F.lit(0).cast("int")
    offsets = _fold(F.transform(blocks, lambda block: F.aggregate(block, zero, lambda s, x: s + x)), zero)
    sums = F.transform(blocks, lambda block, i: F.slice(_fold(block, F.element_at(offsets, i + 1)), F.lit(1), F.size(block)))
    return F.flatten(sums)


def with_spans(df: DataFrame, text: str, kind: str) -> DataFrame:
    """Add ``_<kind>``: start and end in characters, and the string, of the matches of a kind, left to right."""
    pattern, found, gaps, sums = KINDS[kind], f"_{kind}_found", f"_{kind}_gaps", f"_{kind}_sums"
    df = df.withColumn(found, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    some = F.size(found) > 0
    # the text between the matches
    df = df.withColumn(gaps, F.when(some, F.transform(F.split(text, pattern, -1), F.length)))
    lengths = F.zip_with(gaps, found, lambda gap, match: gap + F.coalesce(F.length(match), F.lit(0)))
    df = df.withColumn(sums, F.when(some, running(lengths)))

    def span(match: Column, i: Column) -> Column:
        start = F.element_at(sums, i + 1) + F.element_at(gaps, i + 1)
        return F.struct(start.alias("start"), (start + F.length(match)).alias("end"), match.alias("value"))

    spans = F.transform(found, span)
    if kind == "assign":
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(2))
        df = df.withColumn("_values", F.when(some, values))
        spans = F.filter(spans, lambda s, i: F.length(F.element_at("_values", i + 1)) >= ASSIGN_VALUE)
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return df.withColumn(f"_{kind}", F.when(some, spans).otherwise(none)).drop(found, gaps, sums, "_values")


def _normal(z: Column) -> Column:
    """Chance of a smaller standard normal value (logistic form, right to two per cent of a per cent)."""
    return 1.0 / (1.0 + F.exp(-(1.5976 * z + 0.07056 * z * z * z)))


def _two_sided(z: Column) -> Column:
    return 2.0 * _normal(-F.abs(z))


def probability(value: Column) -> Column:
    """Chance that a text-like run looks as random as ``value``; 1 if it has a pattern that random runs lack."""
    out = F.lit(1.0)
    for _, fits, alphabet, two, three in reversed(ENCODINGS):
        out = F.when(value.rlike(fits), _probability(value, alphabet, two, three)).otherwise(out)
    return out


def _probability(value: Column, alphabet: str, two: float, three: float) -> Column:
    size = len(alphabet)
    plain = F.rtrim(F.translate(value, "-_", "+/"), F.lit("="))
    plain = F.lower(plain) if size == 16 else plain
    codes = F.transform(F.split(plain, ""), lambda c: F.instr(F.lit(alphabet), c) - 1)
    return F.aggregate(F.array(codes), F.lit(1.0), lambda _, c: _tests(c, size, two, three))


def _tests(codes: Column, size: int, two: float, three: float) -> Column:
    codes = F.filter(codes, lambda c: c >= 0)
    n = F.size(codes).cast("double")
    # alphabet: sum of squared deviations from equal use
    symbols = F.sequence(F.lit(0), F.lit(size - 1))
    squares = F.aggregate(
        symbols, F.lit(0.0), lambda s, k: s + F.pow(F.size(F.filter(codes, lambda c: c == k)).cast("double"), F.lit(2.0))
    )
    chi = F.lit(float(size)) * squares / n - n
    text_mean = size + size * (n - 1.0) * two - n
    text_sd = size / n * F.sqrt(4.0 * F.pow(n, F.lit(3.0)) * (three - two * two) + 2.0 * n * n * two)
    uneven = _normal((chi - text_mean) / text_sd)
    # neighbours
    half, pairs = F.lit(size // 2), F.slice(codes, F.lit(2), F.size(codes))
    both = F.arrays_zip(F.slice(codes, F.lit(1), F.size(codes) - 1).alias("a"), pairs.alias("b"))
    changes = F.size(F.filter(both, lambda p: (p["a"] < half) != (p["b"] < half))).cast("double")
    high = F.size(F.filter(codes, lambda c: c >= half)).cast("double")
    low = n - high
    mean = 2.0 * high * low / n
    spread = mean * (2.0 * high * low - n) / (n * (n - 1.0))
    runs = F.when((high == 0) | (low == 0) | (spread <= 0), 0.0).otherwise(_two_sided((changes - mean) / F.sqrt(spread)))
    middle = (size - 1) / 2.0
    product = F.aggregate(both, F.lit(0.0), lambda s, p: s + (p["a"] - middle) * (p["b"] - middle))
    serial = _two_sided(product / (F.sqrt(n) * F.lit((size * size - 1) / 12.0)))
    return F.when(n < 12, 1.0).when((runs < PATTERN_LEVEL) | (serial < PATTERN_LEVEL), 1.0).otherwise(uneven)


def _class_of(length: Column) -> Column:
    out = F.lit(0)
    for i, end in enumerate(LENGTH_CLASSES):
        out = F.when(length >= end, i + 1).otherwise(out)
    return out


def _step(p: Column) -> Column:
    """Whole step of the histogram at or above ``p``, counted from 1 downwards by twentieths of a power of ten."""
    return F.least(F.floor(-F.log10(F.greatest(p, F.lit(1e-30))) * STEPS), F.lit(MOST_STEPS)).cast("int")


def bounds(tested: DataFrame) -> dict[int, int]:
    """Smallest step that counts as a discovery, by length class, from (length_class, step, n).

    Benjamini-Hochberg on the upper ends of the steps: the largest probability that is at most the allowed rate times
    the share of runs that reach it. The histogram has at most (classes) x (steps) rows.
    """
    counts: dict[int, dict[int, int]] = {}
    for row in tested.collect():
        counts.setdefault(row["length_class"], {})[row["step"]] = row["n"]
    out = {}
    for kind, steps in counts.items():
        total, reached = sum(steps.values()), 0
        for step in sorted(steps, reverse=True):
            reached += steps[step]
            if 10.0 ** (-step / STEPS) <= FALSE_RATE * reached / total:
                out[kind] = step
    return out


def with_secrets(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of every row, and ``secrets``: an array of (start, order, end, kind) by start and kind.

    NULL texts count as empty. Random runs inside a span of a fixed pattern are left out of the result, though they are
    tested like all others. Which runs pass depends on all texts of the table, as false discoveries are controlled over all
    of them. Row by row apart from one small aggregate; equal rows get equal results.
    """
    # under numbered names, so that none clashes
    own = [f"_keep{i}" for i in range(len(keep))]
    rows = df.select(*[F.col(f"`{c}`").alias(o) for c, o in zip(keep, own)], F.coalesce(F.col(text), F.lit("")).alias("_text"))
    for kind in KINDS:
        rows = with_spans(rows, "_text", kind)
    tested = F.transform(
        "_random",
        lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), _class_of(s["end"] - s["start"]).alias("length_class"),
            _step(probability(s["value"])).alias("step"),
        ),
    )
    base = F.concat(*[_listed(kind, order) for order, kind in enumerate(KINDS) if kind != "random"])
    found = stage(rows.select(*own, base.alias("_base"), tested.alias("_tested")), "secrets")
    limits = bounds(
        found.select(F.explode("_tested").alias("t"))
        .groupBy(F.col("t.length_class").alias("length_class"), F.col("t.step").alias("step"))
        .agg(F.count(F.lit(1)).alias("n"))
    )

    def passes(t: Column) -> Column:
        good = F.lit(False)
        for kind, step in limits.items():
            good = good | ((t["length_class"] == kind) & (t["step"] >= step))
        inside = F.exists("_base", lambda b: (b["start"] <= t["start"]) & (t["end"] <= b["end"]))
        return good & ~inside

    order = list(KINDS).index("random")
    random = F.transform(
        F.filter("_tested", passes),
        lambda t: F.struct(
            t["start"].alias("start"), F.lit(order).alias("order"), t["end"].alias("end"), F.lit("random").alias("kind")
        ),
    )
    listed = found.select(*own, F.array_sort(F.concat("_base", random)).alias("_secrets"))
    return listed.select(*[F.col(o).alias(c) for c, o in zip(keep, own)], F.col("_secrets").alias("secrets"))


def _listed(kind: str, order: int) -> Column:
    return F.transform(
        f"_{kind}",
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(order).alias("order"), s["end"].alias("end"), F.lit(kind).alias("kind")
        ),
    )


def joined(secrets: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(secrets, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
