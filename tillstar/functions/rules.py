"""Business attributes as Column expressions (no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values -----------------------------------------------------------
CITY_TIERS = {"A": "Metro", "B": "Urban", "C": "Town"}
STAY_BUCKETS = {0: "0 yrs", 1: "1 yr", 2: "2 yrs", 3: "3 yrs", 4: "4+ yrs"}
OCCUPATION_BUCKETS = [(15, "Executive"), (10, "Professional"), (5, "Skilled")]
PRICE_BANDS = [(70, "Premium"), (40, "Core")]
STORE_TIERS = [(750, "Mega"), (350, "Large")]
SUPPLIER_TIERS = [(600, "Strategic"), (250, "Core")]
PREMIUM_PRICE = 70
FLAGSHIP_AVERAGE_PRICE = 60
SEASONS = {"Spring": (3, 4, 5), "Summer": (6, 7, 8), "Fall": (9, 10, 11), "Winter": (12, 1, 2)}
FISCAL_YEAR_FIRST_MONTH = 2
STORE_CHANNEL = "In-Store"
# ----------------------------------------------------------------------------


def _tier(value: Column, steps: list[tuple[int, str]], lowest: str) -> Column:
    """The label of the first step that ``value`` reaches; NULL stays NULL."""
    label = F.lit(lowest)
    for least, name in reversed(steps):
        label = F.when(value >= least, name).otherwise(label)
    return F.when(value.isNotNull(), label)


def city_tier(city: Column) -> Column:
    tier = F.lit("Unknown")
    for code, name in CITY_TIERS.items():
        tier = F.when(F.upper(city) == code, name).otherwise(tier)
    return tier


def stay_years(stay: Column) -> Column:
    """Years as a number: ``4+`` is 4, anything unreadable is 0."""
    return F.coalesce(F.replace(stay, F.lit("+"), F.lit("")).try_cast("int"), F.lit(0))


def stay_bucket(stay: Column) -> Column:
    years = F.least(F.greatest(stay_years(stay), F.lit(0)), F.lit(max(STAY_BUCKETS)))
    pairs = [F.lit(part) for pair in STAY_BUCKETS.items() for part in pair]
    return F.element_at(F.create_map(*pairs), years)


def loyalty_segment(stay: Column, marital: Column) -> Column:
    years = stay_years(stay)
    newer = F.when(marital == 0, "Newcomer").otherwise("Emerging Family")
    return F.when(years >= 4, "Advocate").when(years >= 2, "Loyal").otherwise(newer)


def marital_label(marital: Column) -> Column:
    return F.when(marital == 1, "Married").otherwise("Single")


def occupation_bucket(occupation: Column) -> Column:
    return _tier(occupation, OCCUPATION_BUCKETS, "Entry")


def price_band(price: Column) -> Column:
    """``price`` must be a decimal: a double NaN would compare as the largest value."""
    return F.coalesce(_tier(price, PRICE_BANDS, "Value"), F.lit("Unknown"))


def is_premium(price: Column) -> Column:
    return F.coalesce((price >= PREMIUM_PRICE).cast("int"), F.lit(0))


def store_tier(sku_count: Column) -> Column:
    return _tier(sku_count, STORE_TIERS, "Compact")


def supplier_tier(sku_count: Column) -> Column:
    return _tier(sku_count, SUPPLIER_TIERS, "Long Tail")


def is_flagship(sku_count: Column, average_price: Column) -> Column:
    """Largest tier, or an average price (already rounded) at the flagship level."""
    largest = store_tier(sku_count) == STORE_TIERS[0][1]
    return F.when(largest | (average_price >= FLAGSHIP_AVERAGE_PRICE), 1).otherwise(0)


def date_key(day: Column) -> Column:
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def day_of_key(key: Column) -> Column:
    """The day of a ``date_key``."""
    return F.make_date(F.floor(key / 10000).cast("int"), F.floor(key / 100).cast("int") % 100, key % 100)


def is_weekend(day: Column) -> Column:
    return (F.weekday(day) >= 5).cast("int")


def day_type(weekend_flag: Column) -> Column:
    return F.when(weekend_flag == 1, "Weekend").otherwise("Weekday")


def half_year(day: Column) -> Column:
    return F.when(F.month(day) <= 6, "H1").otherwise("H2")


def season(month: Column) -> Column:
    label = F.lit(None).cast("string")
    for name, months in SEASONS.items():
        label = F.when(month.isin(*months), name).otherwise(label)
    return label


def season_order(name: Column) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in SEASONS]), name)


def fiscal_month(month: Column) -> Column:
    return F.pmod(month - FISCAL_YEAR_FIRST_MONTH, F.lit(12)) + 1


def fiscal_quarter(month: Column) -> Column:
    quarter = F.floor((fiscal_month(month) - 1) / 3) + 1
    return F.concat(F.lit("F"), quarter.cast("string"))


def fiscal_year(day: Column) -> Column:
    return F.year(day) - (F.month(day) < FISCAL_YEAR_FIRST_MONTH).cast("int")


def quarter_label(quarter: Column, year: Column) -> Column:
    return F.concat(F.lit("Q"), quarter.cast("string"), F.lit("-"), year.cast("string"))


def purchase_amount(quantity: Column, price: Column) -> Column:
    """NULL when the amount does not fit its column."""
    return (quantity.cast("decimal(10,0)") * price).try_cast("decimal(12,2)")
