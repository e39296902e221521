"""Column rules on literal rows."""

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from freightmart.functions import literals as fixed
from freightmart.functions import semantics as s
from freightmart.functions.ladder import Ladder, Rule, name_ladder


def one(spark, expr, **values):
    names = list(values)
    schema = ", ".join(f"{n} {v[1]}" for n, v in values.items())
    df = spark.createDataFrame([tuple(values[n][0] for n in names)], schema)
    return df.select(expr.alias("r")).head().r


def test_acronym_starts_words_after_any_mark(spark):
    for name, want in [("северо-западный филиал", "СЗФ"), ('филиал "юг"', 'Ф"Ю"'), ("дальний.восток", "Д.В"), (None, None)]:
        assert one(spark, s.acronym("n"), n=(name, "string")) == want


def test_age_months_counts_whole_calendar_months(spark):
    cases = [("2023-02-28", "2023-01-31", 0), ("2023-03-01", "2023-01-31", 1), ("2023-01-31", "2023-02-28", 0),
             ("2023-01-31", "2023-03-01", -1), ("2024-01-15", "2022-01-15", 24)]
    for later, earlier, want in cases:
        assert one(spark, s.age_months("a", "b"), a=(later, "string"), b=(earlier, "string")) == want


def test_integer_cast_rounds_half_away(spark):
    for value, want in [("2.5", 3), ("-2.5", -3), ("2.7", 3), ("2.4", 2)]:
        assert one(spark, s.round_int("v"), v=(Decimal(value), "decimal(10,2)")) == want


def test_codes_keep_nine_digits_and_longer(spark):
    for code, want in [("", "000000000"), ("12", "000000012"), ("123456789", "123456789"), ("123456789012", "123456789012"), (None, None)]:
        assert one(spark, s.pad_code("c"), c=(code, "string")) == want


def test_typed_quantities(spark):
    assert one(spark, s.to_quantity("q"), q=("1 234,50", "string")) == Decimal("1234.500000")


def test_zero_reference_is_not_a_reference(spark):
    df = spark.createDataFrame([("a",), (fixed.ZERO_REF,), (None,)], "r string")
    assert [r.r for r in df.where(s.has_ref("r")).collect()] == ["a"]
    assert [r.n for r in df.select(s.null_ref("r").alias("n")).collect()] == ["a", None, None]


def test_live_needs_both_flags_known(spark):
    rows = [(1, False, True), (2, True, True), (3, False, False), (4, None, True), (5, False, None)]
    df = spark.createDataFrame(rows, "id int, deleted boolean, posted boolean")
    assert [r.id for r in s.live(df).collect()] == [1]


def test_effective_date_takes_the_first_credible(spark):
    t = lambda d: (datetime.fromisoformat(d) if d else None, "timestamp_ntz")

    def got(unload, request, plan, load, load_plan):
        return one(spark, s.effective_date("u", "r", "p", "l", "lp"), u=t(unload), r=t(request), p=t(plan), l=t(load), lp=t(load_plan))

    assert got("2023-02-01", "2023-01-01", "2023-03-01", None, None) == date(2023, 2, 1)
    assert got("2022-12-01", "2023-01-01", "2023-03-01", None, None) == date(2023, 3, 1)  # unloaded before asked
    assert got("1970-01-01", "1960-01-01", "2010-12-31", "2023-01-01", None) == date(2023, 1, 6)
    assert got(None, "2023-01-01", None, "2001-01-01", "2000-01-01") == date(2000, 1, 6)  # last resort


def test_first_and_last_values_follow_null_order(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3), ("c", None)], "v string, k int")
    row = df.agg(s.latest("v", "k").alias("pg"), s.latest("v", "k", nulls_win=False).alias("known"), s.earliest("v", "k").alias("first")).head()
    assert (row.pg, row.known, row["first"]) == ("c", "b", "a")


def test_dimension_rules(spark):
    d = lambda v: (None if v is None else Decimal(v), "decimal(10,3)")
    weight = s.weight_by_dimension("kg", "w", "h", "d")
    assert one(spark, weight, kg=d("1"), w=d("14"), h=d(None), d=d("1")) == Decimal("40.000")
    assert one(spark, weight, kg=d("50"), w=d("14"), h=d("9"), d=d("1")) == Decimal("50.000")
    assert one(spark, weight, kg=d("0"), w=d("1"), h=d("1"), d=d("1")) == Decimal("0.001")
    assert one(spark, weight, kg=d("2"), w=d(None), h=d(None), d=d(None)) == Decimal("2.000")
    assert one(spark, s.largest_dimension("w", "h", "d"), w=d("3"), h=d(None), d=d("1")) is None


def test_repair_year_and_clock_shift(spark):
    t = (datetime(23, 5, 1, 8), "timestamp_ntz")
    assert one(spark, s.repair_year("t"), t=t) == datetime(2023, 5, 1, 8)
    assert one(spark, s.shift_hours("t", "h"), t=(datetime(2023, 1, 1, 22), "timestamp_ntz"), h=(5, "int")) == datetime(2023, 1, 2, 3)


def test_ladder_first_match_wins_and_unknown_is_no_match(spark):
    x = F.col("x")
    ladder = Ladder([Rule(x > 10, "1", "big"), Rule(x > 5, "2", "middle")], ("0", "none"))
    for value, want in [(11, ("big", "1")), (6, ("middle", "2")), (None, ("none", "0"))]:
        df = spark.createDataFrame([(value,)], "x int").select(ladder.text().alias("t"), ladder.code().alias("c"))
        assert tuple(df.head()) == want


def test_name_patterns_keep_their_order(spark):
    kind = name_ladder(F.col("n"), fixed.KIND_PATTERNS, fixed.KIND_OTHER)
    for name, want in [("СЛД-5 СО", "СЛД"), ("СО СУ", "СО"), ("склад ОП", "ЦС"), ("другой", "ЗАВОД")]:
        assert one(spark, kind, n=(name, "string")) == want
