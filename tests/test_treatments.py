"""Each treatment through a policy, on typed and on text columns."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilframe import Policy, figures_of, merged, moments, profile, pseudonymize, read_table, write_table
from veilframe.functions import round_at, to_number
from veilframe.functions.texts import ALPHABET, BLOCK

ROUNDED = [
    (12.345, "R", 3, 12.35),
    (12.345, "R", 1, 12.0),
    (12.345, "R", 0, 12.0),
    (1234.0, "R", -2, 1200.0),
    (1234.0, "RU", -2, 1300.0),
    (1234.0, "RD", -2, 1200.0),
    (-2.5, "R", 1, -2.0),
    (2.5, "R", 1, 3.0),
    (-0.5, "RU", 1, 0.0),
    (12.341, "RU", 3, 12.35),
    (12.349, "RD", 3, 12.34),
    (0.49999999999999994, "R", 1, 0.0),
    (4503599627370497.0, "R", 1, 4503599627370497.0),
    (1e300, "R", 20, 1e300),
    (1e20, "RU", -2, 1e20),
    (math.inf, "RD", 2, math.inf),
]


def column(df, name):
    return [row[name] for row in df.collect()]


def one_column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}").coalesce(1)


@pytest.mark.parametrize("x,mode,digit,expected", ROUNDED)
def test_round(spark, x, mode, digit, expected):
    got = spark.range(1).select(round_at(F.lit(x), mode, digit).alias("r")).head().r
    assert got == expected and math.copysign(1, got) == math.copysign(1, expected)


def test_round_keeps_nan_and_blanks_text(spark):
    policy = Policy.from_dict({"x": ["Round", "R", "2"]})
    got = column(pseudonymize(one_column(spark, ["1.25", "abc", "", None, "NaN"]), policy), "x")
    assert got == ["1.3", "", "", None, "NaN"]
    got = column(pseudonymize(one_column(spark, [1.25, None], "double"), policy), "x")
    assert got == [1.3, None]


def test_numbers_are_read_as_in_text_tables(spark):
    texts = ["1.5d", "1.5f", "0x1p3", " 3 ", "1e3", "+5", "", "abc", "NaN", "nan", "Inf", "-Infinity"]
    df = one_column(spark, texts).select(to_number(F.col("x"), T.StringType()).alias("x"))
    got = column(df, "x")
    assert got[:6] == [1.5, 1.5, 8.0, 3.0, 1000.0, 5.0]
    assert got[6:8] == [None, None] and math.isnan(got[8])
    assert got[9:] == [None, None, -math.inf]


def test_spellings_of_numbers(spark):
    numbers = {"1e999": math.inf, "1.e5": 1e5, ".5": 0.5, "-.5E+1": -5.0, "0x.8p1": 1.0, "0X1.8P-1d": 0.75, "5\n": 5.0}
    numbers |= {"007": 7.0, "9" * 400: math.inf, "-Infinityf": None, "+NaN ": math.nan, "1e-999": 0.0}
    words = ["--5", "1,000", "١", "5 5", "1_0", "1e", "e5", ".", "+", "0x1", "1f5", "1ff", "NAN", "infinity", "5\u00a0", "5-LOW"]
    numbers |= dict.fromkeys(words)
    df = one_column(spark, list(numbers)).select("x", to_number(F.col("x"), T.StringType()).alias("n"))
    got = {r.x: r.n for r in df.collect()}
    assert math.isnan(got.pop("+NaN ")) and math.isnan(numbers.pop("+NaN "))
    assert got == numbers


@pytest.mark.parametrize(
    "text,digest",
    [
        ("abc", "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"),
        ("", "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"),
        ("A", "559aead08264d5795d3909718cdd05abd49572e84fe55590eef31a88a08fdffd"),
        ("가", "64ee5293d31bc58b72d76ae9a86a902e90442428e29f24f4ecb257ba841cdd36"),
    ],
)
def test_encryption(spark, text, digest):
    policy = Policy.from_dict({"x": ["Encryption"]})
    assert column(pseudonymize(one_column(spark, [text]), policy), "x") == [digest]


def test_top_bottom(spark):
    policy = Policy.from_dict({"x": ["TopBottom"]})
    got = column(pseudonymize(one_column(spark, [10.0, 11.0, 12.0, 13.0, 100.0], "double"), policy), "x")
    assert got == [10.0, 11.0, 12.0, 13.0, 29.2]


def test_top_bottom_keeps_spelling_and_blanks_words(spark):
    cells = ["10", "11.0", "1.2e1", "13", "100", "word", "", None]
    policy = Policy.from_dict({"x": ["TopBottom"]})
    got = column(pseudonymize(one_column(spark, cells), policy), "x")
    assert got == ["10", "11.0", "1.2e1", "13", "29.2", "", "", None]


def test_top_bottom_with_nan_and_infinity(spark):
    policy = Policy.from_dict({"x": ["TopBottom"]})
    got = column(pseudonymize(one_column(spark, ["1", "1", "1", "1", "9", "NaN"]), policy), "x")
    assert got == ["1", "1", "1", "1", "2.6", "NaN"]
    got = column(pseudonymize(one_column(spark, ["1", "2", "Infinity"]), policy), "x")
    assert got == ["1", "2", "Infinity"]


def test_top_bottom_without_any_number(spark):
    policy = Policy.from_dict({"x": ["TopBottom"]})
    assert column(pseudonymize(one_column(spark, ["a", "b"]), policy), "x") == ["", ""]
    assert column(pseudonymize(one_column(spark, [None], "double"), policy), "x") == [None]


@pytest.mark.parametrize("spelling", ["MicroAggregation", "Aggregation"])
def test_micro_aggregation(spark, spelling):
    rows = [("x", 1.0), ("x", 2.0), ("x", 3.0), ("x", 30.0), ("y", 500.0)]
    df = spark.createDataFrame(rows, "g string, v double").coalesce(1)
    got = column(pseudonymize(df, Policy.from_dict({"v": [spelling, "g=x"]})), "v")
    assert got == [1.0, 2.0, 3.0, 9.0, 500.0]


def test_micro_aggregation_conditions(spark):
    rows = [("x", 1, 1.0), ("x", 1, 1.0), ("x", 1, 1.0), ("x", 1, 5.0), ("x", 2, 90.0), (None, 1, 80.0)]
    df = spark.createDataFrame(rows, "g string, n int, v double").coalesce(1)

    def treated(*conditions):
        return column(pseudonymize(df, Policy.from_dict({"v": ["MicroAggregation", *conditions]})), "v")

    assert treated("g=x", "n=1") == [1.0, 1.0, 1.0, 2.0, 90.0, 80.0]
    # A value that is not how the integer prints equals no cell.
    assert treated("n=01") == treated("n=1.0") == treated("n=99999999999") == [r[2] for r in rows]
    # The same column twice must satisfy both.
    assert treated("n=1", "n=2") == [r[2] for r in rows]
    # No condition: all rows.
    mean = sum(r[2] for r in rows) / 6
    assert treated() == [1.0, 1.0, 1.0, 5.0, pytest.approx(mean), pytest.approx(mean)]


def test_condition_value_may_hold_an_equals_sign(spark):
    rows = [("a=b", 1.0), ("a=b", 1.0), ("a=b", 1.0), ("a=b", 9.0), ("a", 7.0)]
    df = spark.createDataFrame(rows, "g string, v double").coalesce(1)
    got = column(pseudonymize(df, Policy.from_dict({"v": ["MicroAggregation", "g=a=b"]})), "v")
    assert got == [1.0, 1.0, 1.0, 3.0, 7.0]


def test_conditions_read_untreated_cells(spark):
    rows = [("x", 1.0), ("x", 1.0), ("x", 1.0), ("x", 9.0)]
    df = spark.createDataFrame(rows, "g string, v double").coalesce(1)
    policy = Policy.from_dict({"g": ["Encryption"], "v": ["MicroAggregation", "g=x"]})
    assert column(pseudonymize(df, policy), "v") == [1.0, 1.0, 1.0, 3.0]


def test_random_numbers_stay_in_range(spark):
    df = spark.range(20000).select((F.col("id") % 90 - 50).alias("x"))
    policy = Policy.from_dict({"x": ["Random"]})
    got = pseudonymize(df, policy, seed=3)
    assert got.schema["x"].dataType == T.DoubleType()
    lo, hi, mean, distinct = got.agg(F.min("x"), F.max("x"), F.avg("x"), F.countDistinct("x")).head()
    assert -50 <= lo < -49 and 38 < hi <= 39 and abs(mean + 5.5) < 1 and distinct > 19900


def test_random_cells_choose_number_or_text(spark):
    df = one_column(spark, ["5", "-7.5", "word", "긴글자", "", None, "Nan"])
    got = column(pseudonymize(df, Policy.from_dict({"x": ["Random"]}), seed=1), "x")
    assert -7.5 <= float(got[0]) <= 5 and -7.5 <= float(got[1]) <= 5
    assert [len(got[i]) for i in (2, 3, 4, 6)] == [4, 3, 0, 3] and got[5] is None
    assert all(set(got[i]) <= set(ALPHABET) for i in (2, 3, 6))


def test_random_text_uses_every_symbol_evenly_at_every_length(spark):
    lengths = [1, 2, BLOCK - 1, BLOCK, BLOCK + 1, 3 * BLOCK, 1000]
    df = spark.range(2000).select(F.explode(F.array(*[F.repeat(F.lit("x"), n) for n in lengths])).alias("x"))
    got = pseudonymize(df, Policy.from_dict({"x": ["Random"]}), seed=5)
    counted = {r[0]: r[1] for r in got.groupBy(F.length("x")).agg(F.count("*")).collect()}
    assert counted == {n: 2000 for n in lengths}
    for position in (1, BLOCK, BLOCK + 1, 500):
        symbols = got.filter(F.length("x") == 1000).select(F.substring("x", position, 1).alias("s"))
        counts = {r.s: r["count"] for r in symbols.groupBy("s").count().collect()}
        assert set(counts) == set(ALPHABET)
        assert sum((c - 2000 / 24) ** 2 / (2000 / 24) for c in counts.values()) < 60
    assert got.filter(F.length("x") >= 23).distinct().count() == 5 * 2000


def test_random_is_repeatable_with_a_seed_and_differs_by_column(spark):
    df = spark.range(500).select(F.lit("aaaaaaaaaaaa").alias("x"), F.lit("aaaaaaaaaaaa").alias("y"))
    policy = Policy.from_dict({"x": ["Random"], "y": ["Random"]})
    first = [tuple(r) for r in pseudonymize(df, policy, seed=9).collect()]
    assert first == [tuple(r) for r in pseudonymize(df, policy, seed=9).collect()]
    assert first != [tuple(r) for r in pseudonymize(df, policy, seed=10).collect()]
    assert first != [tuple(r) for r in pseudonymize(df, policy).collect()]
    assert all(x != y for x, y in first)
    assert len({x for x, _ in first} | {y for _, y in first}) == 1000


def test_delete_and_column_order(spark):
    df = spark.createDataFrame([(1, "a", "b", 2.0)], "`k.1` int, `이름` string, `x y` string, v double")
    policy = Policy.from_dict({"v": ["Round", "R", 1], "이름": ["Delete"], "k.1": ["Masking", "0"]})
    got = pseudonymize(df, policy)
    assert got.columns == ["k.1", "x y", "v"]
    assert tuple(got.head()) == ("**", "b", 2.0)


def test_profile(spark):
    cells = one_column(spark, ["age", "10", "", "20", "x", "NaN"])
    got = profile(cells, Policy.from_dict({"x": ["TopBottom"]}), ("Count", "Avg", "Sd", "Min", "Max"))
    assert {r.stat: r.value for r in got.collect()} == {"Count": 2, "Avg": 15, "Sd": 5, "Min": 10, "Max": 20}
    negative = one_column(spark, ["-5", "-1"])
    got = profile(negative, Policy.from_json('{"전처리": ["통계", "Min", "Max"], "x": ["Random"]}'))
    assert [tuple(r) for r in got.collect()] == [("x", "Min", "", -5.0), ("x", "Max", "", -1.0)]


def test_profile_defaults_to_what_the_treatments_need(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 4.0)], "a double, b double")
    got = profile(df, Policy.from_dict({"a": ["TopBottom"], "b": ["Random"]}))
    assert [tuple(r) for r in got.collect()] == [
        ("a", "Avg", "", 2.0), ("a", "Sd", "", 1.0), ("b", "Min", "", 2.0), ("b", "Max", "", 4.0)
    ]


def test_variance_survives_large_offsets(spark):
    df = spark.createDataFrame([(1e9 + 0.1,), (1e9 + 0.2,), (1e9 + 0.3,)], "x double")
    got = {r.stat: r.value for r in profile(df, Policy.from_dict({"x": ["TopBottom"]})).collect()}
    assert got["Sd"] == pytest.approx(0.0816, abs=1e-3)


def test_mixed_conditional_statistics_do_not_disturb_each_other(spark):
    rows = [("x", 1.0, 10.0), ("x", 3.0, 20.0), ("y", 100.0, 30.0)]
    df = spark.createDataFrame(rows, "g string, v double, w double")
    policy = Policy.from_dict({"v": ["MicroAggregation", "g=x"], "w": ["MicroAggregation", "g=y"]})
    assert [r.value for r in profile(df, policy).collect()] == [2.0, 1.0, 30.0, 0.0]
    policy = Policy.from_dict({"v": ["MicroAggregation", "g=x"], "w": ["TopBottom"]})
    assert [r.value for r in profile(df, policy, ["Avg"]).collect()] == [2.0, 20.0]


def test_stored_statistics(spark, tmp_path):
    df = spark.createDataFrame([(v, float(v)) for v in (10, 11, 12, 13, 100)], "a int, b double")
    policy = Policy.from_dict({"a": ["TopBottom"], "b": ["Random"]})
    profile(df, policy).write.parquet(str(tmp_path / "stats"))
    stored = spark.read.parquet(str(tmp_path / "stats"))
    direct = pseudonymize(df, policy, seed=2).collect()
    assert pseudonymize(df, policy, seed=2, statistics=stored).collect() == direct


def test_incomplete_stored_statistics_fail(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    stored = profile(df, Policy.from_dict({"a": ["TopBottom"]}))
    policy = Policy.from_dict({"a": ["TopBottom"], "b": ["TopBottom"]})
    with pytest.raises(Exception, match="no stored Avg of b"):
        pseudonymize(df, policy, statistics=stored).collect()


def test_statistics_of_columns_with_unusual_names(spark):
    name, other = "소득.연 `평균`", "a(b)"
    df = spark.createDataFrame([(v, "x") for v in ("10", "11", "12", "13", "100")], [name, other]).coalesce(1)
    policy = Policy.from_dict({name: ["MicroAggregation", "a(b)=x"], other: ["Random"]})
    got = pseudonymize(df, policy)
    assert got.columns == [name, other]
    assert [r[0] for r in got.collect()] == ["10", "11", "12", "13", "29.2"]


@pytest.mark.parametrize("digit", [-3, -1, 0, 1, 2, 4])
def test_rounding_bounds(spark, digit):
    unit = 10.0 ** (1 - digit if digit > 0 else -digit)
    x = (F.rand(digit + 10) - 0.5) * 10_000
    df = spark.range(20_000).select(x.alias("x"))
    down, half, up = (round_at(F.col("x"), mode, digit) for mode in ("RD", "R", "RU"))
    slack = 1e-9
    ok = (
        (down <= F.col("x") + slack)
        & (up >= F.col("x") - slack)
        & (F.abs(half - F.col("x")) <= unit / 2 + slack)
        & (up - down <= unit + slack)
    )
    assert df.filter(~ok).count() == 0


def test_numbers_that_stay_keep_their_value(spark):
    rows = [("x", 1, 9007199254740993, "12345678901234567890.12"), ("y", 2, -9007199254740995, "0.05")]
    df = spark.createDataFrame(rows, "g string, i int, n long, d string").withColumn("d", F.col("d").cast("decimal(30,2)"))
    rule = ["MicroAggregation", "g=none"]
    got = pseudonymize(df, Policy.from_dict({"n": rule, "d": rule, "i": rule}))
    assert dict(got.dtypes) == {"g": "string", "i": "string", "n": "string", "d": "decimal(30,2)"}
    assert [(r.i, r.n, str(r.d)) for r in got.collect()] == [(str(i), str(n), d) for _, i, n, d in rows]
    got = pseudonymize(df, Policy.from_dict({"n": rule, "d": rule, "i": rule}), integers="round")
    assert dict(got.dtypes) == {"g": "string", "i": "int", "n": "bigint", "d": "decimal(30,2)"}
    assert [(r.g, r.i, r.n, str(r.d)) for r in got.collect()] == rows


@pytest.mark.parametrize("kind", ["tinyint", "smallint", "int", "bigint"])
def test_integers_keep_their_form_beside_a_mean(spark, tmp_path, kind):
    df = spark.createDataFrame([(v,) for v in (10, 11, 12, 13, 100, None)], "n int").select(F.col("n").cast(kind))
    policy = Policy.from_dict({"n": ["TopBottom"]})
    got = [r.n for r in pseudonymize(df, policy).collect()]
    assert got == ["10", "11", "12", "13", "29.2", None]
    write_table(pseudonymize(df, policy), str(tmp_path / "out"))
    assert sorted(r.n for r in read_table(spark, str(tmp_path / "out")).collect()) == ["", "10", "11", "12", "13", "29.2"]
    rounded = pseudonymize(df, policy, integers="round")
    assert rounded.dtypes == [("n", kind)] and [r.n for r in rounded.collect()] == [10, 11, 12, 13, 29, None]
    with pytest.raises(ValueError):
        pseudonymize(df, policy, integers="double")


def test_a_mean_between_two_integers_goes_up(spark):
    df = spark.createDataFrame([(v,) for v in (-9, -1, -2, -1, -2, -2, 0, -3)], "n long")
    some = pseudonymize(df, Policy.from_dict({"n": ["TopBottom"]}), integers="round")
    assert sorted(r.n for r in some.collect()) == [-3, -2, -2, -2, -2, -1, -1, 0]


@pytest.mark.parametrize(
    "entry",
    [["Encryption", "salt"], ["TopBottom", "k=3"], ["Masking", "1", "0", "1"], ["Round", "R", 1, 2], ["Random", 1],
     ["Delete", "now"], ["PartDelete"]],
)
def test_options_that_a_treatment_does_not_take_are_refused(entry):
    with pytest.raises(ValueError):
        Policy.from_dict({"c": entry})


def test_salt(spark):
    df = spark.createDataFrame([("a",), (None,)], "c string")
    got = [r.c for r in pseudonymize(df, Policy.from_dict({"c": ["Encryption", "salt=s,="]})).collect()]
    assert got == [hashlib.sha256(b"s,=a").hexdigest(), None]


def test_stored_statistics_are_taken_for_the_same_conditions_only(spark):
    rows = [("x", 1.0), ("x", 2.0), ("x", 3.0), ("x", 30.0), ("y", 500.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    whole, some = Policy.from_dict({"v": ["TopBottom"]}), Policy.from_dict({"v": ["MicroAggregation", "g=x"]})
    with pytest.raises(Exception, match="no stored Avg of v where g=x"):
        pseudonymize(df, some, statistics=profile(df, whole)).collect()
    both = profile(df, some).union(profile(df, whole))
    got = [r.v for r in pseudonymize(df, some, statistics=both).collect()]
    assert got == [1.0, 2.0, 3.0, 9.0, 500.0]
    with pytest.raises(Exception, match="more than one stored"):
        pseudonymize(df, some, statistics=both.union(profile(df, some))).collect()


def test_random_on_columns_that_are_neither_numbers_nor_text(spark):
    df = spark.sql("SELECT timestamp'2024-01-02 03:04:05' AS t, true AS b, date'2024-01-02' AS d, 1.5D AS x, "
                   "CAST(NULL AS DATE) AS n")
    entries = {c: ["Random"] for c in df.columns}
    row = pseudonymize(df, Policy.from_dict(entries), seed=1).head()
    assert (len(row.t), len(row.b), len(row.d), row.x, row.n) == (19, 4, 10, 1.5, None)
    stored = profile(df, Policy.from_dict(entries))
    assert len(pseudonymize(df, Policy.from_dict(entries), statistics=stored).head().t) == 19
    with pytest.raises(ValueError):
        pseudonymize(df, Policy.from_dict({"d": ["TopBottom"]}))


def test_checks_of_random_numbers_fail_where_nothing_is_drawn(spark):
    from veilframe.catalogue import drawn_numbers

    df = spark.range(1, 1001).select(F.col("id").cast("double").alias("x"))
    kept = df.agg(*drawn_numbers(F.col("x"), F.col("x"))).head()
    drawn = pseudonymize(df.withColumn("y", F.col("x")), Policy.from_dict({"y": ["Random"]}), seed=1)
    assert not kept.changed and all(drawn.agg(*drawn_numbers(F.col("x"), F.col("y"))).head())


def statistics(found):
    return {(r.column, r.stat, r.conditions): r.value for r in found.collect()}


def close(got, wanted, least):
    assert got.keys() == wanted.keys()
    for name, value in wanted.items():
        assert got[name] == value or math.isclose(got[name], value, rel_tol=least), name


@pytest.mark.parametrize("shift", [0, 1e9])
@pytest.mark.parametrize("parts", [1, 9])
def test_moments_of_parts_merge_to_those_of_the_whole(spark, parts, shift):
    i = F.col("id")
    df = spark.range(2000).select(
        i,
        (F.sin(i) * 5 + shift).alias("x"),
        F.when(i % 3 == 0, F.lit("no number")).otherwise((i * i % 97).cast("string")).alias("t"),
        F.when(i % 11 == 0, F.lit(None)).otherwise((i % 5).cast("string")).alias("g"),
        F.when(i < 100, F.lit(None)).otherwise(i).alias("late"),
    )
    policy = Policy.from_dict({"x": ["TopBottom"], "t": ["MicroAggregation", "g=2"], "late": ["Random"]})
    pieces = [moments(df.filter((i * i) % parts == k), policy) for k in range(parts)]
    every = pieces[0]
    for piece in pieces[1:]:
        every = every.union(piece)
    figures = ("Count", "Avg", "Sd", "Min", "Max")
    least = 1e-8 if shift else 1e-12
    close(statistics(figures_of(merged(every), figures)), statistics(profile(df, policy, figures)), least)
    again = merged(merged(every).union(merged(every.limit(0))))
    close(statistics(figures_of(again)), statistics(profile(df, policy, figures[1:])), least)


def test_merged_moments_serve_as_statistics(spark):
    df = spark.createDataFrame([(v,) for v in (10.0, 11.0, 12.0, 13.0, 100.0)], "x double")
    policy = Policy.from_dict({"x": ["TopBottom"]})
    both = moments(df.filter("x < 12"), policy).union(moments(df.filter("x >= 12"), policy))
    got = pseudonymize(df, policy, statistics=figures_of(merged(both)))
    assert sorted(r.x for r in got.collect()) == [10.0, 11.0, 12.0, 13.0, 29.2]


def test_moments_of_columns_without_numbers(spark):
    df = spark.createDataFrame([("a", None), ("b", float("nan"))], "t string, x double")
    policy = Policy.from_dict({"t": ["TopBottom"], "x": ["TopBottom"]})
    found = merged(moments(df, policy).union(moments(df.limit(0), policy)))
    assert {(r.column, r.n, r.mean, r.m2, r.low, r.high) for r in found.collect()} == {
        ("t", 0, None, None, None, None), ("x", 0, None, None, None, None)}
    assert set(statistics(figures_of(found)).values()) == {None}
    with pytest.raises(ValueError):
        moments(df, Policy.from_dict({"t": ["Delete"]}))


def random_cells(spark, parts, by, **how):
    """Numbers, short texts and long ones, dealt out and ordered in some way."""
    df = spark.range(3000).select(
        "id", (F.col("id") % 50).cast("double").alias("x"), F.lit("a short one").alias("t"),
        F.repeat(F.lit("long "), 40).alias("u"), F.lit("same").alias("g"),
    )
    df = df.repartition(parts, by).sortWithinPartitions(F.rand(parts))
    policy = Policy.from_dict({"x": ["Random"], "t": ["Random"], "u": ["Random"]})
    return {r.id: (r.x, r.t, r.u) for r in pseudonymize(df, policy, **how).collect()}


def test_random_cells_follow_the_row(spark):
    first = random_cells(spark, 1, "id", seed=5, identity=["id"])
    assert first == random_cells(spark, 64, "x", seed=5, identity=["id"])
    assert first != random_cells(spark, 1, "id", seed=6, identity=["id"])
    for i in range(3):
        assert len({row[i] for row in first.values()}) > 2900
    draws = sorted(x / 49 for x, _, _ in first.values())
    # Kolmogorov and Smirnov: far from even with a chance of a millionth.
    assert max(abs(x - i / 3000) for i, x in enumerate(draws)) < 2.6 / 3000**0.5
    for place in (0, 7, 30, 95, 180):
        counts = [sum(u[place] == c for _, _, u in first.values()) for c in ALPHABET]
        assert sum((n - 125) ** 2 / 125 for n in counts) < 65
    # Positions, blocks and columns are drawn apart from each other.
    for a, b in ((0, 1), (0, 24), (10, 34), (0, 48)):
        same = sum(u[a] == u[b] for _, _, u in first.values())
        assert abs(same - 125) < 60
    assert sum(t[:4] == u[:4] for _, t, u in first.values()) < 5


def test_rows_alike_in_their_identity_draw_alike(spark):
    found = random_cells(spark, 3, "id", seed=1, identity=["g"])
    assert len(set(found.values())) == 1
    apart = random_cells(spark, 3, "id", identity=["id"])
    assert apart != random_cells(spark, 3, "id", identity=["id"])


def test_random_cells_by_the_place_in_a_file(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(2000).select((F.col("id") % 3).alias("id"), F.lit("text").alias("t"), F.lit(1.5).alias("place"))
    df.repartition(4).write.parquet(path)
    policy = Policy.from_dict({"t": ["Random"]})

    def treated(source):
        got = pseudonymize(source, policy, seed=3, identity="row")
        assert got.columns == ["id", "t", "place"]
        return sorted(map(tuple, got.collect()))

    first = treated(spark.read.parquet(path))
    assert len({t for _, t, _ in first}) > 1900
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3k")
    try:
        assert treated(spark.read.parquet(path)) == first
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(treated(df)) == 2000
    for wrong in ("id", "rows"):
        with pytest.raises(ValueError, match="identity"):
            pseudonymize(df, policy, identity=wrong)
    with pytest.raises(ValueError, match="no columns"):
        pseudonymize(df, policy, identity=["none"])
