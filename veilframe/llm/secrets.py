"""Secrets in texts: known shapes, and runs of symbols that pass for random.

Everything is Spark expressions. Known shapes are found by pattern. Other runs
of 20 symbols or more are tested: the alphabet that a run's symbols come from
suggests its encoding, and three tests ask whether it could be random symbols
of that encoding: chi-squared for even use of the alphabet, runs above and
below its middle, and correlation of neighbours. Ordinary words fail. Which
results count as failures is decided over the whole corpus by the procedure of
Benjamini and Hochberg, separately for each encoding and length, so that of the
runs that are dismissed as ordinary at most a share ``rate`` is expected to
have been random. A run that is too short for its encoding to tell text from
chance is not reported.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilframe.functions import free_name, named

# The known shapes, in the order in which they are listed.
ASSIGN = (
    r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
KINDS = ("assign", "access", "hex", "random")

# Encodings by the symbols of a run, the first that fits.
DIGITS, SMALL, LARGE = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = (
    ("decimal", r"^[0-9]+$", DIGITS),
    ("hex", r"^[0-9a-f]+$", DIGITS + "abcdef"),
    ("hex", r"^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("small", r"^[a-z]+$", SMALL),
    ("large", r"^[A-Z]+$", LARGE),
    ("base32", r"^[A-Z2-7]+$", LARGE + "234567"),
    ("base36", r"^[a-z0-9]+$", DIGITS + SMALL),
    ("base36", r"^[A-Z0-9]+$", DIGITS + LARGE),
    ("letters", r"^[A-Za-z]+$", LARGE + SMALL),
    ("base62", r"^[A-Za-z0-9]+$", LARGE + SMALL + DIGITS),
    ("base64", r"", LARGE + SMALL + DIGITS + "+/-_"),
)
# How often two letters of ordinary text are the same.
COINCIDENCE = 0.065
BINS = 400
RATE = 0.05


SPAN = "array<struct<start:int,end:int,value:string>>"


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(values: Column, join) -> Column:
    """For each element what ``join`` makes of it and all before it, in few passes over the array.

    A pass joins each element with the one so many places before it that the
    others are in between: one place first, then two, then four.
    """
    passes = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(values), F.lit(2)))).cast("int") - 1)

    def once(x: Column, k: Column) -> Column:
        step = F.pow(F.lit(2), k).cast("int")
        return F.transform(x, lambda v, i: F.when(i >= step, join(v, F.get(x, i - step))).otherwise(v))

    return F.aggregate(passes, values, once)


def matches(text: Column, pattern: str, keep=None) -> Column:
    """``(start, end, value)`` of all matches that ``keep`` accepts, from left to right.

    What lies between the matches is split off by the same pattern, and the
    lengths add up to positions in code points.
    """
    gaps = F.transform(F.split(text, pattern, -1), F.char_length)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # There is one gap more than hits.
    lengths = F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), hits, lambda g, h: g + F.char_length(h))

    def spans(ends: Column) -> Column:
        found = F.zip_with(
            ends,
            hits,
            lambda e, h: F.struct((e - F.char_length(h)).alias("start"), e.alias("end"), h.alias("value")),
        )
        return found if keep is None else F.filter(found, lambda s: keep(s["value"]))

    found = let(running(lengths, lambda a, b: a + b), spans)
    return F.when(text.rlike(pattern), found.cast(SPAN)).otherwise(F.array().cast(SPAN))


def _upper_tail(z: Column) -> Column:
    """The chance that a normal variable exceeds ``z``, to three places."""
    bounded = F.greatest(F.least(z, F.lit(12.0)), F.lit(-12.0))
    return 1 / (1 + F.exp(1.5976 * bounded + 0.07056 * F.pow(bounded, F.lit(3.0))))


def _encoding(token: Column) -> Column:
    """The number of the first encoding that fits."""
    found = F.lit(len(ENCODINGS) - 1)
    for i in range(len(ENCODINGS) - 2, -1, -1):
        found = F.when(token.rlike(ENCODINGS[i][1]), i).otherwise(found)
    return found


def _of_encoding(encoding: Column, values: list) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), encoding + 1)


def least_length(symbols: int) -> int:
    """From which length on text of that many symbols stands out by three deviations."""
    excess = max(symbols * COINCIDENCE - 1, 0.5)
    return max(20, math.ceil(1 + 3 * math.sqrt(2 * (symbols - 1)) / excess))


def battery(token: Column) -> Column:
    """``(p, stratum, reported, encoding)`` of a run of symbols.

    ``p`` is small where the run is unlikely as random symbols of its encoding:
    three times the smallest result of three tests. ``reported`` is false for
    runs that are too short for their encoding and for plain numbers.
    """
    n = F.char_length(token).cast("double")
    total = lambda array: F.aggregate(array, F.lit(0.0), lambda a, b: a + F.coalesce(b, F.lit(0.0)))
    behind = lambda array: F.slice(array, F.lit(2), F.size(array))

    def tested(encoding: Column) -> Column:
        alphabet = _of_encoding(encoding, [a for _, _, a in ENCODINGS])
        m = F.char_length(alphabet).cast("double")
        symbols = F.filter(F.split(token, ""), lambda c: c != "")
        values = F.transform(symbols, lambda c: F.instr(alphabet, c).cast("double") - 1)
        long_enough = n >= _of_encoding(encoding, [float(least_length(len(a))) for _, _, a in ENCODINGS])
        return F.struct(
            let(values, lambda x: F.least(F.lit(1.0), 3 * F.least(even(x, m), runs(x, m), serial(x)))).alias("p"),
            F.concat_ws("/", encoding.cast("string"), F.floor(F.log2(n) * 2).cast("string")).alias("stratum"),
            (long_enough & (encoding > 0)).alias("reported"),
            encoding.alias("encoding"),
        )

    def even(x: Column, m: Column) -> Column:
        counts = F.transform(
            F.array_distinct(x), lambda v: F.pow(F.size(F.filter(x, lambda w: w == v)).cast("double"), F.lit(2.0))
        )
        chi = m / n * total(counts) - n
        return _upper_tail((chi - (m - 1)) / F.sqrt(2 * (m - 1) * (n - 1) / n))

    def runs(x: Column, m: Column) -> Column:
        def of_sides(side: Column) -> Column:
            high = total(side)
            changes = total(F.zip_with(behind(side), side, lambda a, b: F.abs(a - b)))
            mean = 2 * high * (n - high) / n + 1
            spread = F.sqrt(F.greatest((mean - 1) * (mean - 2) / (n - 1), F.lit(1e-9)))
            return F.when((high < 1) | (high > n - 1), F.lit(0.0)).otherwise(
                2 * _upper_tail(F.abs(changes + 1 - mean) / spread)
            )

        return let(F.transform(x, lambda v: (v >= m / 2).cast("double")), of_sides)

    def serial(x: Column) -> Column:
        def of_distances(d: Column) -> Column:
            own = total(F.transform(d, lambda v: v * v))
            beside = total(F.zip_with(behind(d), d, lambda a, b: a * b))
            return F.when(own > 0, 2 * _upper_tail(F.abs(beside / own + 1 / n) * F.sqrt(n))).otherwise(0.0)

        return let(total(x) / n, lambda c: let(F.transform(x, lambda v: v - c), of_distances))

    return let(_encoding(token), tested)


def _bin(p: Column) -> Column:
    return F.least(F.floor(-20 * F.log10(F.greatest(p, F.lit(1e-30)))), F.lit(BINS)).cast("int")


def ordinary_bins(runs: DataFrame, rate: float) -> DataFrame:
    """One row: a map from stratum to the bin of p-values from which on runs are ordinary.

    ``runs`` are ``(value, p, stratum)``; equal runs count once. Strata and
    bins are few, whatever the size of the corpus.
    """
    once = runs.groupBy("value").agg(F.first("stratum").alias("stratum"), F.first("p").alias("p"))
    counted = once.groupBy("stratum", _bin(F.col("p")).alias("bin")).agg(F.count("*").alias("n"))
    smaller = Window.partitionBy("stratum").orderBy(F.desc("bin"))
    whole = Window.partitionBy("stratum")
    share = F.sum("n").over(smaller) / F.sum("n").over(whole)
    kept = counted.withColumn("share", share).filter(F.pow(F.lit(10.0), -F.col("bin") / 20) <= rate * F.col("share"))
    first = kept.groupBy("stratum").agg(F.min("bin").alias("bin"))
    return first.agg(F.map_from_entries(F.collect_list(F.struct("stratum", "bin"))).alias("bins"))


SECRETS = "array<struct<kind:string,start:int,end:int,value:string,encoding:string,p:double>>"


def find_secrets(
    docs: DataFrame, text: str = "text", into: str = "secrets", rate: float = RATE
) -> DataFrame:
    """``docs`` with an array of ``(kind, start, end, value, encoding, p)`` for every row.

    The spans come by start, then by the order of ``KINDS``; offsets count code
    points and ends are exclusive. ``random`` spans are those that pass the
    tests and overlap no known shape. ``encoding`` and ``p`` are what the tests
    say of the span's symbols, of an assignment those of the value: a known
    shape with a small ``p`` is hardly random, such as a placeholder. A NULL or
    empty text has no spans. Rows and other columns stay; a column that is
    called ``into`` is replaced.
    """
    kept = docs.drop(into)
    whole = F.coalesce(named(text).cast("string"), F.lit(""))
    tested = F.transform(
        matches(whole, RUN),
        lambda r: F.struct(
            r["start"].alias("start"), r["end"].alias("end"), r["value"].alias("value"), battery(r["value"]).alias("t")
        ),
    )
    runs = docs.select(F.explode(tested).alias("r")).select("r.value", "r.t.p", "r.t.stratum")
    bins = ordinary_bins(runs, rate).scalar()
    group_2 = lambda hit: F.regexp_extract(hit, ASSIGN, 2)

    def ranked(spans: Column, kind: str, secret=lambda v: v) -> Column:
        return F.transform(
            spans,
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), s["end"].alias("end"),
                s["value"].alias("value"), battery(secret(s["value"])).alias("t"),
            ),
        )

    known = F.concat(
        ranked(matches(whole, ASSIGN, lambda hit: F.char_length(group_2(hit)) >= 6), "assign", group_2),
        ranked(matches(whole, ACCESS), "access"),
        ranked(matches(whole, HEX), "hex"),
    )
    names = [free_name(name, kept) for name in ("known", "runs", "bins")]
    found, candidates, limits = map(F.col, names)

    def passes(run: Column) -> Column:
        limit = F.coalesce(F.element_at(limits, run["t"]["stratum"]), F.lit(BINS + 1))
        return run["t"]["reported"] & (_bin(run["t"]["p"]) < limit)

    rank = F.lit(KINDS.index("random"))
    random = F.transform(
        F.filter(candidates, passes),
        lambda r: F.struct(
            r["start"].alias("start"), rank.alias("rank"), r["end"].alias("end"), r["value"].alias("value"), r["t"].alias("t")
        ),
    )
    labels = F.array(*[F.lit(k) for k in KINDS])
    encodings = F.array(*[F.lit(name) for name, _, _ in ENCODINGS])
    spans = F.transform(
        let(F.array_sort(F.concat(found, random)), _clear_of_known),
        lambda s: F.struct(
            F.element_at(labels, s["rank"] + 1).alias("kind"), s["start"].alias("start"),
            s["end"].alias("end"), s["value"].alias("value"),
            F.element_at(encodings, s["t"]["encoding"] + 1).alias("encoding"), s["t"]["p"].alias("p"),
        ),
    )
    staged = kept.select("*", *[c.alias(n) for c, n in zip((known, tested, bins), names)])
    return staged.withColumn(into, spans.cast(SECRETS)).drop(*names)


def _clear_of_known(spans: Column) -> Column:
    """The spans without random ones that overlap a known one; all are in order."""
    is_known = lambda s: s["rank"] < KINDS.index("random")
    ends = F.transform(spans, lambda s: F.when(is_known(s), s["end"]).otherwise(0))
    far = (1 << 31) - 1
    starts = F.transform(F.reverse(spans), lambda s: F.when(is_known(s), s["start"]).otherwise(far))

    def clear(before: Column, behind: Column) -> Column:
        last = F.size(spans) - 1
        outside = lambda s, i: (F.get(before, i) <= s["start"]) & (F.get(behind, last - i) >= s["end"])
        return F.filter(spans, lambda s, i: is_known(s) | outside(s, i))

    return let(running(ends, F.greatest), lambda a: let(running(starts, F.least), lambda b: clear(a, b)))
