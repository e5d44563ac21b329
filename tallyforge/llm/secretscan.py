"""Secrets in texts: known shapes, and tokens that a battery of randomness tests takes for random.

Known shapes are assignments of a value to a name like ``password``, access keys and long runs of
hexadecimal digits.  Any other run of key-like characters is a candidate.  Its encoding is the
smallest alphabet that holds it, and three tests ask whether it could be random in that alphabet:
the chi-squared test of uniform symbols, the runs test of symbols in the lower and upper half, and
the serial correlation of neighbours.  Fisher's method combines them.  A candidate that passes gets
the probability that ordinary text of its length, whose symbols repeat more often, looks as uniform.

False discoveries are controlled over the whole table by the weighted step-up procedure: a
candidate's weight is its length over the mean length, as longer ones carry more evidence, and the
cut is the largest weighted probability that keeps the expected share of false ones below ``level``.
Probabilities are counted by length and in steps of 1/20 of a power of ten, rounded up, so what is
gathered for the cut is bounded, and every candidate counts.

Built-in expressions only.  Places are code points.  A run of more than 1,000 characters is tested
in parts of 1,000, the last up to 19 longer.  Defined cases: null texts are empty and have no span;
rows are scanned one by one, so repeated ids and null ids are no special case; with no candidate in
the table none is added.  Columns named as results are replaced.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.llm.common import free_name, without, written

# The shapes.  Hexadecimal runs and access keys that are too short fail as a whole, so
# their least length can stand in the pattern; a short assignment still takes up its characters.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 8
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ["assign", "access", "hex", "random"]

KEY_LIKE = "[A-Za-z0-9+/_-]"
CANDIDATE = f"{KEY_LIKE}{{20,1000}}(?:{KEY_LIKE}{{1,19}}(?!{KEY_LIKE}))?={{0,2}}"

DIGITS, SMALL = "0123456789", "abcdefghijklmnopqrstuvwxyz"
# Smallest first.
ALPHABETS = [
    DIGITS + "abcdef",
    DIGITS + "ABCDEF",
    SMALL.upper() + "234567",
    DIGITS + SMALL,
    SMALL.upper() + SMALL + DIGITS,
    SMALL.upper() + SMALL + DIGITS + "+/",
    SMALL.upper() + SMALL + DIGITS + "-_",
]
STEPS = 20  # of a power of ten
CHUNK = 256

RESULTS = ["n_assign", "n_access", "n_hex", "n_random", "base_spans", "spans"]


@dataclass(frozen=True)
class Battery:
    random: float = 0.01  # least combined probability of the three tests
    level: float = 0.01  # expected share of false ones among the tokens added
    repeat: float = 0.062  # chance that two characters of ordinary text are equal


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0.0), lambda a, x: a + x)


def running(sizes: Column) -> Column:
    """For each of the numbers the sum of those before it, in chunks, so that no list is copied often."""

    def sums(numbers: Column, start: Column) -> Column:
        return F.aggregate(numbers, F.array(start), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))

    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / CHUNK).cast("int")), lambda c: F.slice(sizes, c * CHUNK + 1, F.lit(CHUNK)))
    return _let(
        chunks,
        lambda parts: _let(
            sums(F.transform(parts, lambda p: F.aggregate(p, F.lit(0).cast("bigint"), lambda a, x: a + x)), F.lit(0).cast("bigint")),
            lambda begins: F.flatten(F.transform(parts, lambda p, c: F.slice(sums(p, begins[c]), F.lit(1), F.size(p)))),
        ),
    )


def occurrences(text: Column, pattern: str) -> Column:
    """The leftmost non-overlapping matches: an array of (start, said)."""
    none = F.array().cast("array<struct<start:bigint,said:string>>")

    def placed(found: Column) -> Column:
        gaps = F.transform(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), lambda g: F.char_length(g).cast("bigint"))
        return _let(
            gaps,
            lambda before: _let(
                running(F.zip_with(before, found, lambda g, f: g + F.char_length(f))),
                lambda upto: F.transform(found, lambda f, i: F.struct((upto[i] + before[i]).alias("start"), f.alias("said"))),
            ),
        )

    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return _let(matches, lambda found: F.when(F.size(found) == 0, none).otherwise(placed(found)))


def _spans(found: Column, kind: str) -> Column:
    return F.transform(
        found, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), (s["start"] + F.char_length(s["said"])).alias("end"))
    )


def _listed(spans: Column) -> Column:
    """kind:start:end of each, by start, then kind."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


# -- the battery ----------------------------------------------------------------------------------


def _tail(z: Column) -> Column:
    """Probability that a normal variable exceeds z, good to some per cent also far out."""

    def upper(x: Column) -> Column:
        return (1 - F.exp(-1.4 * x)) * F.exp(-x * x / 2) / (1.135 * 2.5066282746310002 * x)

    far = F.greatest(F.abs(z), F.lit(1e-6))
    return F.when(z >= 0, upper(far)).otherwise(1 - upper(far))


def _log(p: Column) -> Column:
    return F.log(F.greatest(F.coalesce(p, F.lit(0.0)), F.lit(1e-300)))


def _tested(said: Column, battery: Battery) -> Column:
    """(length, step): step counts twentieths of powers of ten of the probability, null without an encoding."""
    body = F.rtrim(said, F.lit("="))
    which = F.coalesce(*(F.when(body.rlike(f"^[{a}]+$".replace("-", r"\-")), k) for k, a in enumerate(ALPHABETS)))
    of = lambda strings: F.array(*map(F.lit, strings))
    halves = ["0" * (len(a) // 2) + "1" * (len(a) - len(a) // 2) for a in ALPHABETS]

    def measured(s: Column) -> Column:
        m, k = s["mean"], F.char_length(s["alphabet"])
        count = lambda i: s["n"] - F.char_length(F.replace(s["body"], F.substr(s["alphabet"], i, F.lit(1)), F.lit("")))
        squares = _total(F.transform(F.sequence(F.lit(1), k), lambda i: count(i).cast("double") * count(i)))
        changes = lambda two: (s["n"] - F.char_length(F.replace(s["halves"], F.lit(two), F.lit("")))) / F.lit(2.0)
        own = _total(F.transform(s["values"], lambda v: (v - m) * (v - m)))
        ahead, behind = F.slice(s["values"], F.lit(1), s["n"] - 1), F.slice(s["values"], F.lit(2), s["n"] - 1)
        pairs = _total(F.zip_with(ahead, behind, lambda a, b: (a - m) * (b - m)))
        statistics = F.struct(
            s["n"].cast("double").alias("n"),
            k.cast("double").alias("k"),
            (k / s["n"] * squares - s["n"]).alias("chi"),
            (1 + changes("01") + changes("10")).alias("runs"),
            F.char_length(F.replace(s["halves"], F.lit("0"), F.lit(""))).cast("double").alias("high"),
            own.alias("own"),
            pairs.alias("pairs"),
        )
        return _let(statistics, judged)

    def judged(s: Column) -> Column:
        n, k = s["n"], s["k"]
        uniform = _tail((s["chi"] - (k - 1)) / F.sqrt(2 * (k - 1) * (1 - 1 / n)))
        want = 1 + 2 * s["high"] * (n - s["high"]) / n
        spread = F.greatest((want - 1) * (want - 2) / (n - 1), F.lit(1e-9))
        runs = 2 * _tail(F.abs(s["runs"] - want) / F.sqrt(spread))
        serial = F.when(s["own"] > 0, 2 * _tail(F.abs(s["pairs"] / s["own"] + 1 / (n - 1)) * F.sqrt(n)))
        away = n * F.greatest(k * battery.repeat - 1, F.lit(0.5))
        plain = _tail((k - 1 + away - s["chi"]) / F.sqrt(2 * (k - 1) + 6 * away))
        evidence = -(_log(uniform) + _log(runs) + _log(serial))
        step = F.floor(-STEPS * _log(plain) / 2.302585092994046).cast("int")

        def decided(y: Column) -> Column:
            passes = F.exp(-y) * (1 + y + y * y / 2) >= battery.random  # chi-squared with six degrees of freedom
            return F.struct(n.cast("int").alias("length"), F.when(passes, step).otherwise(0).alias("step"))

        return _let(evidence, decided)

    def read(b: Column) -> Column:
        alphabet = of(ALPHABETS)[b["which"]]
        values = F.transform(F.sequence(F.lit(1), F.char_length(b["body"])), lambda i: F.call_function("instr", alphabet, F.substr(b["body"], i, F.lit(1))).cast("double"))
        return _let(
            values,
            lambda v: _let(
                F.struct(
                    b["body"].alias("body"), F.char_length(b["body"]).alias("n"), alphabet.alias("alphabet"), v.alias("values"),
                    (_total(v) / F.size(v)).alias("mean"), F.call_function("translate", b["body"], alphabet, of(halves)[b["which"]]).alias("halves"),
                ),
                measured,
            ),
        )

    return _let(F.struct(body.alias("body"), which.alias("which")), lambda b: F.when(b["which"].isNotNull(), read(b)))


def _weighted(length: Column, step: Column, mean: float) -> Column:
    return F.pow(F.lit(10.0), -step / F.lit(float(STEPS))) * mean / length


def _cut(candidates: DataFrame, battery: Battery) -> tuple[float, float | None]:
    """Mean length, and the largest weighted probability to accept, from all candidates.

    Lengths and steps are bounded, so the table of their counts is.
    """
    counts = candidates.groupBy("length", "step").agg(F.count(F.lit(1)).alias("n"))
    whole = counts.agg(F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("length")) / F.sum("n")).alias("mean")).first()
    if not whole.n:
        return 0.0, None
    chance = counts.withColumn("chance", _weighted(F.col("length"), F.col("step"), whole.mean))
    upto = chance.withColumn("upto", F.sum("n").over(Window.orderBy("chance").rangeBetween(Window.unboundedPreceding, 0)))
    return whole.mean, upto.where(F.col("chance") * whole.n <= battery.level * F.col("upto")).agg(F.max("chance")).first()[0]


# -- the operator ---------------------------------------------------------------------------------


def secret_scan(docs: DataFrame, text: str = "text", battery: Battery = Battery()) -> DataFrame:
    """All rows without their text, with n_assign, n_access, n_hex, n_random, base_spans and spans.

    ``base_spans`` and ``spans`` list kind:start:end by start, then by kind as in KINDS, joined by
    commas; end is exclusive.  Tokens that an access key or hexadecimal run covers are not added.
    """
    base = without(docs, RESULTS)
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    assign = F.filter(occurrences(body, ASSIGN), lambda s: F.char_length(F.regexp_extract(s["said"], ASSIGN, 2)) >= ASSIGN_LEAST)
    shapes = F.flatten(F.array(_spans(assign, "assign"), _spans(occurrences(body, ACCESS), "access"), _spans(occurrences(body, HEX), "hex")))
    fresh = F.filter(occurrences(body, CANDIDATE), lambda s: ~s["said"].rlike(f"^(?:{HEX}|{ACCESS})$"))
    tested = F.transform(
        fresh,
        lambda s: F.struct(s["start"].alias("start"), (s["start"] + F.char_length(s["said"])).alias("end"), _tested(s["said"], battery).alias("test")),
    )
    spans, tokens = free_name(base, "_spans"), free_name(base, "_tokens")
    kept = [c for c in base.columns if c != text]
    scanned = written(
        base.select(*(F.col(f"`{c}`") for c in kept), shapes.alias(spans), F.filter(tested, lambda t: t["test"].isNotNull()).alias(tokens)), "scanned"
    )
    candidates = scanned.select(F.explode(f"{tokens}.test").alias("test")).select("test.length", "test.step")
    mean, cut = _cut(candidates, battery)
    taken = F.filter(F.col(tokens), lambda t: _weighted(t["test"]["length"], t["test"]["step"], mean) <= F.lit(-1.0 if cut is None else cut))
    added = F.transform(taken, lambda t: F.struct(t["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"), t["end"].alias("end")))
    with_random = scanned.withColumn(tokens, added)
    number = lambda kind: F.size(F.filter(F.col(spans), lambda s: s["kind"] == KINDS.index(kind))).cast("bigint").alias(f"n_{kind}")
    return with_random.select(
        *(F.col(f"`{c}`") for c in kept),
        *map(number, KINDS[:3]),
        F.size(tokens).cast("bigint").alias("n_random"),
        _listed(F.col(spans)).alias("base_spans"),
        _listed(F.concat(spans, tokens)).alias("spans"),
    )
