import datetime as dt
import random
from decimal import Decimal
from fractions import Fraction
from math import floor

import pytest
from pyspark.sql import functions as F

from tillstar.functions import numeric, rules


def evaluate(spark, values, kind, rule):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", rule(F.col("v")).alias("x")).orderBy("i").collect()]


def test_city_tier(spark):
    found = evaluate(spark, ["A", "a", "B", "C", "D", None], "string", rules.city_tier)
    assert found == ["Metro", "Metro", "Urban", "Town", "Unknown", "Unknown"]


def test_stay(spark):
    values = ["0", "1", "2", "3", "4", "4+", "10", " 3 ", "x", "", "-2", "3.5", None]
    assert evaluate(spark, values, "string", rules.stay_years) == [0, 1, 2, 3, 4, 4, 10, 3, 0, 0, -2, 0, 0]
    assert evaluate(spark, values, "string", rules.stay_bucket) == [
        "0 yrs", "1 yr", "2 yrs", "3 yrs", "4+ yrs", "4+ yrs", "4+ yrs", "3 yrs", "0 yrs", "0 yrs", "0 yrs", "0 yrs",
        "0 yrs",
    ]


@pytest.mark.parametrize(
    "stay, marital, expected",
    [("0", 0, "Newcomer"), ("1", 1, "Emerging Family"), ("2", 0, "Loyal"), ("3", 1, "Loyal"), ("4+", 0, "Advocate")],
)
def test_loyalty(spark, stay, marital, expected):
    df = spark.createDataFrame([(stay, marital)], "s string, m int")
    assert df.select(rules.loyalty_segment(F.col("s"), F.col("m"))).first()[0] == expected


def test_steps(spark):
    jobs = evaluate(spark, [0, 4, 5, 9, 10, 14, 15, 20], "int", rules.occupation_bucket)
    assert jobs == ["Entry", "Entry", "Skilled", "Skilled", "Professional", "Professional", "Executive", "Executive"]
    assert evaluate(spark, [349, 350, 749, 750], "long", rules.store_tier) == ["Compact", "Large", "Large", "Mega"]
    tiers = evaluate(spark, [249, 250, 599, 600], "long", rules.supplier_tier)
    assert tiers == ["Long Tail", "Core", "Core", "Strategic"]
    assert evaluate(spark, [0, 1], "int", rules.marital_label) == ["Single", "Married"]


def test_price(spark):
    def priced(rule):
        texts = [None, "0.00", "39.99", "40.00", "69.99", "70.00"]
        return evaluate(spark, texts, "string", lambda v: rule(v.cast("decimal(10,2)")))

    assert priced(rules.price_band) == ["Unknown", "Value", "Value", "Core", "Core", "Premium"]
    assert priced(rules.is_premium) == [0, 0, 0, 0, 0, 1]


def test_flagship(spark):
    df = spark.createDataFrame(
        [(750, "10.00"), (749, "59.99"), (1, "60.00"), (1, None)], "n long, p string"
    ).select(rules.is_flagship(F.col("n"), F.col("p").cast("decimal(10,2)")).alias("x"))
    assert [r.x for r in df.collect()] == [1, 0, 1, 0]


def test_dates(spark):
    days = [dt.date(2020, 10, d) for d in (23, 24, 25)]  # Friday, Saturday, Sunday
    assert evaluate(spark, days, "date", rules.is_weekend) == [0, 1, 1]
    assert evaluate(spark, days[:1], "date", rules.date_key) == [20201023]
    edges = [dt.date(2017, 1, 31), dt.date(2017, 2, 1), dt.date(2017, 6, 30), dt.date(2017, 7, 1)]
    assert evaluate(spark, edges, "date", rules.fiscal_year) == [2016, 2017, 2017, 2017]
    assert evaluate(spark, edges, "date", lambda d: rules.fiscal_month(F.month(d))) == [12, 1, 5, 6]
    assert evaluate(spark, edges, "date", lambda d: rules.fiscal_quarter(F.month(d))) == ["F4", "F1", "F2", "F2"]
    assert evaluate(spark, edges, "date", rules.half_year) == ["H1", "H1", "H1", "H2"]
    seasons = evaluate(spark, list(range(1, 13)), "int", rules.season)
    assert seasons == ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Fall"] * 3 + ["Winter"]
    order = evaluate(spark, ["Spring", "Summer", "Fall", "Winter"], "string", rules.season_order)
    assert order == [1, 2, 3, 4]


def test_ratios_round_half_up_and_survive_zero(spark):
    df = spark.createDataFrame([("1.00", "8.00"), ("5.00", "0.00"), (None, "2.00"), ("3.00", "2.00")], "a string, b string")
    a, b = F.col("a").cast("decimal(22,2)"), F.col("b").cast("decimal(22,2)")
    shares = [r[0] for r in df.select(numeric.percent(a, b).cast("double")).collect()]
    assert shares == [12.5, None, None, 150.0]
    growth = [r[0] for r in df.select(numeric.growth(a, b).cast("double")).collect()]
    assert growth == [-87.5, None, None, 50.0]
    half = spark.createDataFrame([("0.01", 2), ("0.03", 2)], "t string, n long")
    means = [r[0] for r in half.select(numeric.mean(F.col("t").cast("decimal(22,2)"), F.col("n"), 2).cast("double")).collect()]
    assert means == [0.01, 0.02]


def test_ratios_are_rounded_once(spark):
    rng = random.Random(4)
    pairs = [(Decimal(rng.randrange(-10**top, 10**top)) / 100, Decimal(rng.randrange(-10**low, 10**low)) / 100) for top in (3, 9, 20) for low in (2, 9, 20) for _ in range(40)]
    bottom = Decimal(2 * 10**15)
    pairs += [(bottom / 200 - Decimal("0.01"), bottom), (bottom / 200, bottom), (-bottom / 200, bottom)]  # just below a half, and halves
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a decimal(22,2), b decimal(20,2)")
    for digits in (2, 6):
        found = df.orderBy("i").select(numeric.ratio(F.col("a"), F.col("b"), digits)).collect()
        for (a, b), (value,) in zip(pairs, found):
            if not b:
                assert value is None
                continue
            share = abs(Fraction(a) / Fraction(b)) * 10**digits
            sign = -1 if (a < 0) != (b < 0) else 1
            assert Fraction(value) == Fraction(sign * floor(share + Fraction(1, 2)), 10**digits)


def test_purchase_amount_is_exact(spark):
    df = spark.createDataFrame([(3, "0.10"), (7, "19.99")], "q int, p string")
    amounts = [str(r[0]) for r in df.select(rules.purchase_amount(F.col("q"), F.col("p").cast("decimal(10,2)"))).collect()]
    assert amounts == ["0.30", "139.93"]


@pytest.mark.parametrize("digits", [2, 6])
def test_mean_as_double_equals_the_decimal_mean(spark, digits):
    rng = random.Random(digits)
    few = 2**53 // 10 ** (digits - 2)  # of cents, up to which whole numbers are used
    cents = [0, 1, -1, few - 1, few, few + 1, -few, 10**17, *[rng.randrange(-10 ** (k % 5), 10**k) for k in range(1, 19) for _ in range(40)]]
    rows = [(Decimal(c).scaleb(-2), n) for c in cents for n in (1, 3, 8, rng.randrange(1, 10**7))]
    rows += [(None, 2), (Decimal("1.00"), None), (Decimal("1.00"), 0), (Decimal("-1.00"), -3), (Decimal("1.00"), 2**62)]
    df = spark.createDataFrame(rows, "t decimal(22,2), n bigint")
    both = df.select(
        "t", "n", numeric.mean_as_double(F.col("t"), F.col("n"), "quick", digits),
        numeric.as_double(numeric.mean(F.col("t"), F.col("n"), digits), "exact"),
    )
    assert both.where("not (quick <=> exact)").collect() == []
