"""Roll sales up to dimension attributes with little shuffling, whatever the dimension's size."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.plans.star import Star
from tillstar.session import fits_broadcast

SURROGATE = {
    "dim_customer": "Customer_Key",
    "dim_product": "Product_Key",
    "dim_store": "Store_Key",
    "dim_supplier": "Supplier_Key",
}


def sales_on(star: Star, dates: DataFrame, *columns: str) -> DataFrame:
    """Facts of the given calendar rows with calendar ``columns``.

    The year is part of the join condition, so a filter on the calendar prunes fact partitions.
    The calendar holds one row per day, a size that does not grow with the facts.
    """
    wanted = dates.select("Date_Key", F.col("Year").alias("Sale_Year"), *[c for c in columns if c != "Date_Key"])
    return star.fact_sales.join(F.broadcast(wanted), ["Date_Key", "Sale_Year"])


def sales_in_year(star: Star, year: int, *columns: str) -> DataFrame:
    return sales_on(star, star.dim_date.where(F.col("Year") == year), *columns)


def roll_up(
    star: Star,
    sales: DataFrame,
    attributes: dict[str, list[str]],
    by: list[str],
    measures: dict[str, Column],
    count_customers: bool = False,
    customers_first: bool = False,
) -> DataFrame:
    """Sum ``measures`` per calendar columns ``by`` and dimension ``attributes``.

    A dimension that Spark can broadcast is joined to the facts directly. Before each larger one is joined the
    rows are summed per surrogate keys still to be joined: the sums combine before the shuffle, so a key with very
    many rows costs one row per task, and raw facts never meet a large dimension.
    With ``count_customers`` the result has ``Unique_Customers``: sums per customer come first and
    the customers are then counted as rows.

    Parts of the facts with customers of their own (``plans.bucketed``) are summed one by one, each with ``customers_first``: the
    first sums and the join with the customers then stay where the facts lie. Sums and customers of the parts add up.
    """
    final = [*by, *[c for columns in attributes.values() for c in columns]]
    if star.fact_parts and sales is star.fact_sales and "dim_customer" in attributes:
        each = [
            roll_up(replace(star, fact_sales=p, fact_parts=()), p, attributes, by, measures, count_customers, customers_first=True)
            for p in star.fact_parts
        ]
        counts = [F.sum("Unique_Customers").alias("Unique_Customers")] if count_customers else []
        return reduce(DataFrame.unionByName, each).groupBy(*final).agg(*_sums(measures), *counts)
    lookups = {t: getattr(star, t).select(SURROGATE[t], *columns) for t, columns in attributes.items()}
    late = [t for t, lookup in lookups.items() if not fits_broadcast(lookup)]
    if (count_customers or customers_first) and "dim_customer" in lookups and "dim_customer" not in late:
        late.append("dim_customer")
    if customers_first and not count_customers:
        late.sort(key="dim_customer".__ne__)
    elif "dim_customer" in late:
        late.sort(key="dim_customer".__eq__)  # customers last: by then the sales are summed by the rest
    base = sales.select(
        *by, *[SURROGATE[t] for t in lookups], *(["Customer_Key"] if count_customers and "dim_customer" not in lookups else []),
        *[m.alias(name) for name, m in measures.items()],
    )
    for table in [t for t in lookups if t not in late]:
        base = base.join(lookups[table], SURROGATE[table]).drop(SURROGATE[table])
    for place in range(len(late)) if late else [0] * count_customers:
        held = [SURROGATE[t] for t in late[place:]]
        if count_customers and "Customer_Key" not in held:
            held.append("Customer_Key")
        known = [c for t, columns in attributes.items() if t not in late[place:] for c in columns]
        base = base.groupBy(*by, *known, *held).agg(*_sums(measures))
        for table in late[place : place + 1]:
            base = base.join(lookups[table], SURROGATE[table])
    counts = [F.count(F.lit(1)).alias("Unique_Customers")] if count_customers else []
    return base.groupBy(*final).agg(*_sums(measures), *counts)


def _sums(measures: dict[str, Column]) -> list[Column]:
    return [F.sum(name).alias(name) for name in measures]
