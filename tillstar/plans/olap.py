"""The twenty sales reports. Each takes the star and its parameters and returns a DataFrame.

Facts are unique per (order, product, date) and every foreign key matches one dimension row, so the
number of transactions is the number of fact rows; no distinct count over the facts is needed.
Sums stay decimal until the last projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.functions import numeric, rules
from tillstar.operators.affinity import top_pairs
from tillstar.plans.star import Star
from tillstar.plans.summary import roll_up, sales_in_year, sales_on
from tillstar.session import as_lookup



def _revenue() -> Column:
    return F.col("Total_Purchase_Amount")


def _one() -> Column:
    return F.lit(1).cast("bigint")


def _quantity() -> Column:
    return F.col("Quantity").cast("bigint")


def _mean_sale(total: str, count: str, name: str) -> Column:
    return numeric.mean_as_double(F.col(total), F.col(count), name)


def _money(*names: str) -> dict[str, Column]:
    return {name: F.col(name).cast("double") for name in names}


def _with(df: DataFrame, dimension: DataFrame, key: str, *columns: str) -> DataFrame:
    """Names for already aggregated rows; the size of both sides decides the join strategy."""
    return df.join(dimension.select(key, *columns), key).drop(key)


# Q1
def top_products_by_day_type_monthly(star: Star, year: int, top: int = 5) -> DataFrame:
    """Products ranked by yearly revenue on weekdays and at weekends, with their months.

    One pass over the facts: a product's months (twelve at most) travel in an array while ranking.
    """
    sales = sales_in_year(star, year, "Month", "Month_Name", "Is_Weekend")
    monthly = sales.groupBy(
        "Product_Key", rules.day_type(F.col("Is_Weekend")).alias("Day_Type"), "Month", "Month_Name"
    ).agg(F.sum(_revenue()).alias("Monthly_Revenue"), F.sum(_quantity()).alias("Monthly_Quantity"))
    yearly = monthly.groupBy("Product_Key", "Day_Type").agg(
        F.sum("Monthly_Revenue").alias("Yearly_Revenue"),
        F.collect_list(F.struct("Month", "Month_Name", "Monthly_Revenue", "Monthly_Quantity")).alias("Months"),
    )
    place = F.rank().over(Window.partitionBy("Day_Type").orderBy(F.desc("Yearly_Revenue")))
    best = yearly.withColumn("Day_Rank", place).where(F.col("Day_Rank") <= top)
    named = _with(best, star.dim_product, "Product_Key", "Product_ID", "Product_Category")
    return (
        named.select("*", F.inline("Months"))
        .select(
            "Product_ID", "Product_Category", "Day_Type", F.col("Day_Rank").cast("bigint").alias("Day_Rank"),
            "Month", "Month_Name", numeric.as_double(F.col("Monthly_Revenue"), "Monthly_Revenue"),
            "Monthly_Quantity", numeric.as_double(F.col("Yearly_Revenue"), "Yearly_Revenue"),
        )
        .orderBy("Day_Type", "Day_Rank", "Month", "Product_ID")
    )


# Q2
def demographics_share(star: Star) -> DataFrame:
    """Revenue per gender, age and city, with its share of all revenue."""
    grouped = roll_up(
        star, star.fact_sales, {"dim_customer": ["Gender", "Age", "City_Category", "City_Tier"]}, [],
        {"Total_Transactions": _one(), "Total_Purchase_Amount": _revenue()}, count_customers=True,
    )
    # one row per attribute combination, so the single-partition total is small
    whole = F.sum("Total_Purchase_Amount").over(Window.partitionBy())
    return (
        grouped.withColumn("Share", numeric.percent(F.col("Total_Purchase_Amount"), whole))
        .select(
            "Gender", "Age", "City_Category", "City_Tier", "Total_Transactions",
            numeric.as_double(F.col("Total_Purchase_Amount"), "Total_Purchase_Amount"),
            _mean_sale("Total_Purchase_Amount", "Total_Transactions", "Avg_Purchase_Amount"),
            numeric.as_double(F.col("Share"), "Revenue_Share_Pct"),
            "Unique_Customers",
        )
        .orderBy(F.desc("Total_Purchase_Amount"))
    )


# Q3
def category_by_occupation(star: Star) -> DataFrame:
    grouped = roll_up(
        star, star.fact_sales,
        {"dim_product": ["Product_Category"], "dim_customer": ["Occupation", "Occupation_Bucket"]}, [],
        {"Total_Transactions": _one(), "Total_Sales": _revenue(), "Total_Quantity": _quantity()},
    )
    return grouped.select(
        "Product_Category", "Occupation", "Occupation_Bucket", "Total_Transactions",
        numeric.as_double(F.col("Total_Sales"), "Total_Sales"), "Total_Quantity",
        _mean_sale("Total_Sales", "Total_Transactions", "Avg_Transaction_Value"),
    ).orderBy("Product_Category", F.desc("Total_Sales"))


# Q4
def gender_age_quarterly(star: Star, year: int) -> DataFrame:
    grouped = roll_up(
        star, sales_in_year(star, year, "Year", "Quarter"), {"dim_customer": ["Gender", "Age"]}, ["Year", "Quarter"],
        {"Total_Transactions": _one(), "Total_Purchase_Amount": _revenue()},
    )
    return grouped.select(
        "Gender", "Age", "Year", "Quarter", rules.quarter_label(F.col("Quarter"), F.col("Year")).alias("Quarter_Label"),
        "Total_Transactions", numeric.as_double(F.col("Total_Purchase_Amount"), "Total_Purchase_Amount"),
        _mean_sale("Total_Purchase_Amount", "Total_Transactions", "Avg_Purchase_Amount"),
    ).orderBy("Gender", "Age", "Quarter")


# Q5
def top_occupations_per_category(star: Star, top: int = 5) -> DataFrame:
    grouped = roll_up(
        star, star.fact_sales,
        {"dim_product": ["Product_Category"], "dim_customer": ["Occupation", "Occupation_Bucket"]}, [],
        {"Total_Sales": _revenue()},
    )
    place = F.dense_rank().over(Window.partitionBy("Product_Category").orderBy(F.desc("Total_Sales")))
    return _ranked(grouped, place, "Sales_Rank", top).select(
        "Product_Category", "Occupation", "Occupation_Bucket",
        numeric.as_double(F.col("Total_Sales"), "Total_Sales"), "Sales_Rank",
    ).orderBy("Product_Category", "Sales_Rank")


def _ranked(df: DataFrame, place: Column, name: str, top: int) -> DataFrame:
    """Rows up to rank ``top``; Spark limits each group before the shuffle as well as after it."""
    return df.withColumn(name, place).where(F.col(name) <= top).withColumn(name, F.col(name).cast("bigint"))


# Q6
def city_marital_recent_months(star: Star, months: int = 6) -> DataFrame:
    """The last ``months`` of the calendar, after the day that lies ``months`` before its end."""
    last_day = star.dim_date.agg(F.max("Full_Date"))
    first_day = star.dim_date.agg(F.add_months(F.max("Full_Date"), -months))
    recent = star.dim_date.where(
        (F.col("Full_Date") > first_day.scalar()) & (F.col("Full_Date") <= last_day.scalar())
    )
    grouped = roll_up(
        star, sales_on(star, recent, "Year", "Month", "Month_Name"),
        {"dim_customer": ["City_Category", "Marital_Status"]}, ["Year", "Month", "Month_Name"],
        {"Total_Purchase_Amount": _revenue(), "Total_Transactions": _one()}, count_customers=True,
    )
    return grouped.select(
        "City_Category", "Marital_Status", "Year", "Month", "Month_Name",
        numeric.as_double(F.col("Total_Purchase_Amount"), "Total_Purchase_Amount"),
        "Total_Transactions", "Unique_Customers",
    ).orderBy("Year", "Month", "City_Category", "Marital_Status")


# Q7
def stay_and_gender_average(star: Star) -> DataFrame:
    grouped = roll_up(
        star, star.fact_sales, {"dim_customer": ["Stay_In_Current_City_Years", "Stay_Bucket", "Gender"]}, [],
        {"Total_Transactions": _one(), "Total_Purchase_Amount": _revenue()}, count_customers=True,
    )
    return grouped.select(
        "Stay_In_Current_City_Years", "Stay_Bucket", "Gender", "Total_Transactions",
        numeric.as_double(F.col("Total_Purchase_Amount"), "Total_Purchase_Amount"),
        _mean_sale("Total_Purchase_Amount", "Total_Transactions", "Avg_Purchase_Amount"), "Unique_Customers",
    ).orderBy("Stay_In_Current_City_Years", "Gender")


# Q8
def top_cities_per_category(star: Star, top: int = 5) -> DataFrame:
    grouped = roll_up(
        star, star.fact_sales,
        {"dim_product": ["Product_Category"], "dim_customer": ["City_Category", "City_Tier"]}, [],
        {"Total_Revenue": _revenue()},
    )
    place = F.rank().over(Window.partitionBy("Product_Category").orderBy(F.desc("Total_Revenue")))
    return _ranked(grouped, place, "Revenue_Rank", top).select(
        "Product_Category", "City_Category", "City_Tier",
        numeric.as_double(F.col("Total_Revenue"), "Total_Revenue"), "Revenue_Rank",
    ).orderBy("Product_Category", "Revenue_Rank")


# Q9
def monthly_growth_by_category(star: Star, year: int) -> DataFrame:
    """Growth against the previous month that has sales."""
    monthly = roll_up(
        star, sales_in_year(star, year, "Year", "Month", "Month_Name"), {"dim_product": ["Product_Category"]},
        ["Year", "Month", "Month_Name"], {"Monthly_Sales": _revenue()},
    )
    before = F.lag("Monthly_Sales").over(Window.partitionBy("Product_Category").orderBy("Year", "Month"))
    return (
        monthly.withColumn("Previous_Month_Sales", before)
        .withColumn("Growth", numeric.growth(F.col("Monthly_Sales"), F.col("Previous_Month_Sales")))
        .select(
            "Product_Category", "Year", "Month", "Month_Name",
            numeric.as_double(F.col("Monthly_Sales"), "Monthly_Sales"),
            numeric.as_double(F.col("Previous_Month_Sales"), "Previous_Month_Sales"),
            numeric.as_double(F.col("Growth"), "Growth_Percentage"),
        )
        .orderBy("Product_Category", "Month")
    )


# Q10
def weekend_share_by_age(star: Star, year: int) -> DataFrame:
    at_weekend = F.col("Is_Weekend") == 1
    grouped = roll_up(
        star, sales_in_year(star, year, "Is_Weekend"), {"dim_customer": ["Age"]}, [],
        {
            "Weekday_Sales": F.when(~at_weekend, _revenue()).otherwise(0),
            "Weekend_Sales": F.when(at_weekend, _revenue()).otherwise(0),
            "Total_Sales": _revenue(),
        },
    )
    return (
        grouped.withColumn("Share", numeric.percent(F.col("Weekend_Sales"), F.col("Total_Sales")))
        .select(
            "Age",
            *[numeric.as_double(F.col(c), c) for c in ("Weekday_Sales", "Weekend_Sales", "Total_Sales")],
            numeric.as_double(F.col("Share"), "Weekend_Percentage"),
        )
        .orderBy(F.desc("Total_Sales"))
    )


# Q11
def top_products_per_month_and_day_type(star: Star, year: int, top: int = 5) -> DataFrame:
    """Ties are broken by product (keys follow the order of the product ids)."""
    revenue = (
        sales_in_year(star, year, "Year", "Month", "Month_Name", "Is_Weekend")
        .groupBy(
            "Product_Key", "Year", "Month", "Month_Name", rules.day_type(F.col("Is_Weekend")).alias("Day_Type")
        )
        .agg(F.sum(_revenue()).alias("Revenue"))
    )
    place = F.row_number().over(
        Window.partitionBy("Month", "Day_Type").orderBy(F.desc("Revenue"), "Product_Key")
    )
    best = _ranked(revenue, place, "Revenue_Rank", top)
    return (
        _with(best, star.dim_product, "Product_Key", "Product_ID", "Product_Category")
        .select(
            "Product_ID", "Product_Category", "Year", "Month", "Month_Name", "Day_Type",
            numeric.as_double(F.col("Revenue"), "Revenue"), "Revenue_Rank",
        )
        .orderBy("Month", "Day_Type", "Revenue_Rank")
    )


# Q12
def store_quarterly_growth(star: Star, year: int) -> DataFrame:
    quarterly = (
        sales_in_year(star, year, "Year", "Quarter")
        .groupBy("Store_Key", "Year", "Quarter")
        .agg(F.sum(_revenue()).alias("Quarterly_Revenue"))
    )
    before = F.lag("Quarterly_Revenue").over(Window.partitionBy("Store_Key").orderBy("Quarter"))
    return (
        _with(quarterly.withColumn("Previous", before), star.dim_store, "Store_Key", "Store_ID", "Store_Name")
        .select(
            "Store_ID", "Store_Name", "Year", "Quarter",
            rules.quarter_label(F.col("Quarter"), F.col("Year")).alias("Quarter_Label"),
            numeric.as_double(F.col("Quarterly_Revenue"), "Quarterly_Revenue"),
            numeric.as_double(F.col("Previous"), "Previous_Quarter_Revenue"),
            numeric.as_double(
                numeric.growth(F.col("Quarterly_Revenue"), F.col("Previous")), "Growth_Rate_Percentage"
            ),
        )
        .orderBy("Store_ID", "Quarter")
    )


# Q13
def supplier_store_product(star: Star) -> DataFrame:
    totals = star.fact_sales.groupBy("Store_Key", "Supplier_Key", "Product_Key").agg(
        F.sum(_revenue()).alias("Total_Sales"),
        F.sum(_quantity()).alias("Total_Quantity"),
        F.count(F.lit(1)).alias("Total_Transactions"),
    )
    named = _with(totals, star.dim_store, "Store_Key", "Store_ID", "Store_Name")
    named = _with(named, star.dim_supplier, "Supplier_Key", "Supplier_ID", "Supplier_Name")
    named = _with(named, star.dim_product, "Product_Key", "Product_ID", "Product_Category")
    return named.select(
        "Store_Name", "Store_ID", "Supplier_Name", "Supplier_ID", "Product_ID", "Product_Category",
        numeric.as_double(F.col("Total_Sales"), "Total_Sales"), "Total_Quantity", "Total_Transactions",
    ).orderBy("Store_Name", "Supplier_Name", F.desc("Total_Sales"))


# Q14
def product_by_season(star: Star) -> DataFrame:
    """Seasons of calendar years: January and December of one year share its winter row.

    Nearly every product has a row per season, so products are hashed, not sorted, to be joined, and rows are ordered before
    their measures are worked out: ordering computes what comes before it twice, once to find its ranges.
    """
    totals = (
        sales_on(star, star.dim_date, "Season", "Year")
        .groupBy("Product_Key", "Season", "Year")
        .agg(
            F.sum(_revenue()).alias("Total_Sales"),
            F.sum(_quantity()).alias("Total_Quantity"),
            F.count(F.lit(1)).alias("Total_Transactions"),
        )
    )
    products = as_lookup(star.dim_product.select("Product_Key", "Product_ID", "Product_Category"))
    return (
        totals.join(products, "Product_Key")
        .orderBy("Product_ID", "Year", rules.season_order(F.col("Season")))
        .select(
            "Product_ID", "Product_Category", "Season", "Year",
            numeric.as_double(F.col("Total_Sales"), "Total_Sales"), "Total_Quantity", "Total_Transactions",
            _mean_sale("Total_Sales", "Total_Transactions", "Avg_Transaction_Value"),
        )
    )


# Q15
def store_supplier_volatility(star: Star) -> DataFrame:
    monthly = (
        sales_on(star, star.dim_date, "Year", "Month", "Month_Name")
        .groupBy("Store_Key", "Supplier_Key", "Year", "Month", "Month_Name")
        .agg(F.sum(_revenue()).alias("Monthly_Revenue"))
    )
    before = F.lag("Monthly_Revenue").over(
        Window.partitionBy("Store_Key", "Supplier_Key").orderBy("Year", "Month")
    )
    change = monthly.withColumn("Previous", before).withColumn(
        "Change", numeric.growth(F.col("Monthly_Revenue"), F.col("Previous"))
    )
    named = _with(change, star.dim_store, "Store_Key", "Store_ID", "Store_Name")
    named = _with(named, star.dim_supplier, "Supplier_Key", "Supplier_ID", "Supplier_Name")
    return named.select(
        "Store_ID", "Store_Name", "Supplier_ID", "Supplier_Name", "Year", "Month", "Month_Name",
        numeric.as_double(F.col("Monthly_Revenue"), "Monthly_Revenue"),
        numeric.as_double(F.col("Previous"), "Previous_Month_Revenue"),
        numeric.as_double(F.col("Change"), "Revenue_Change_Percentage"),
        numeric.as_double(F.abs("Change"), "Volatility_Percentage"),
    ).orderBy("Store_ID", "Supplier_ID", "Year", "Month")


# Q16
def product_affinity(star: Star, top: int = 5) -> DataFrame:
    """The product pairs that most orders have in common; ties go to the smaller product ids."""
    baskets = star.fact_sales.select("Order_ID", "Product_Key")
    best = top_pairs(baskets, "Order_ID", "Product_Key", top)
    names = star.dim_product.select("Product_Key", "Product_ID", "Product_Category")
    first = names.toDF("First", "Product1_ID", "Product1_Category")
    second = names.toDF("Second", "Product2_ID", "Product2_Category")
    return (
        F.broadcast(best).join(first, "First").join(second, "Second")  # at most ``top`` rows
        .select(
            "Product1_ID", "Product1_Category", "Product2_ID", "Product2_Category",
            F.col("Baskets").alias("Times_Bought_Together"),
        )
        .orderBy(F.desc("Times_Bought_Together"), "Product1_ID", "Product2_ID")
    )


# Q17
def yearly_rollup(star: Star, years: tuple[int, ...]) -> DataFrame:
    """Year, store, supplier and product with subtotals.

    The facts are summed at the finest level once; the roll-up then expands those sums, not the facts.
    """
    finest = (
        sales_on(star, star.dim_date.where(F.col("Year").isin(*years)), "Year")
        .groupBy("Year", "Store_Key", "Supplier_Key", "Product_Key")
        .agg(F.sum(_revenue()).alias("Revenue"), F.sum(_quantity()).alias("Items"))
    )
    named = finest
    for dimension, key, column in (
        (star.dim_store, "Store_Key", "Store_Name"),
        (star.dim_supplier, "Supplier_Key", "Supplier_Name"),
        (star.dim_product, "Product_Key", "Product_ID"),
    ):
        named = named.join(dimension.select(key, column), key, "left").drop(key)

    def label(column: str, subtotal: str) -> Column:
        return F.when(F.grouping(column) == 1, subtotal).otherwise(F.col(column))

    return (
        named.rollup("Year", "Store_Name", "Supplier_Name", "Product_ID")
        .agg(
            label("Store_Name", "ALL STORES").alias("StoreName"),
            label("Supplier_Name", "ALL SUPPLIERS").alias("SupplierName"),
            label("Product_ID", "ALL PRODUCTS").alias("Product_Label"),
            F.sum("Revenue").alias("Total_Revenue"),
            F.sum("Items").alias("Total_Quantity"),
        )
        .where("Total_Revenue is not null")
        .select(
            "StoreName", "SupplierName", F.col("Product_Label").alias("Product_ID"), "Year",
            numeric.as_double(F.col("Total_Revenue"), "Total_Revenue"), "Total_Quantity",
        )
        .orderBy("Year", "StoreName", "SupplierName", "Product_ID")
    )


# Q18
def half_year_split(star: Star, year: int) -> DataFrame:
    first_half = F.col("Month") <= 6

    def part(condition: Column, value: Column, name: str) -> Column:
        return F.sum(F.when(condition, value).otherwise(0)).alias(name)

    totals = (
        sales_in_year(star, year, "Year", "Month")
        .groupBy("Product_Key", "Year")
        .agg(
            part(first_half, _revenue(), "H1_Revenue"),
            part(~first_half, _revenue(), "H2_Revenue"),
            F.sum(_revenue()).alias("Yearly_Revenue"),
            part(first_half, _quantity(), "H1_Quantity"),
            part(~first_half, _quantity(), "H2_Quantity"),
            F.sum(_quantity()).alias("Yearly_Quantity"),
        )
    )
    shares = {
        f"{half}_Revenue_Percentage": numeric.percent(F.col(f"{half}_Revenue"), F.col("Yearly_Revenue")).cast("double")
        for half in ("H1", "H2")
    }
    return (
        _with(totals, star.dim_product, "Product_Key", "Product_ID", "Product_Category")
        .withColumns(shares)
        .withColumns(_money("H1_Revenue", "H2_Revenue", "Yearly_Revenue"))
        .select(
            "Product_ID", "Product_Category", "Year", "H1_Revenue", "H2_Revenue", "Yearly_Revenue",
            "H1_Quantity", "H2_Quantity", "Yearly_Quantity", "H1_Revenue_Percentage", "H2_Revenue_Percentage",
        )
        .orderBy(F.desc("Yearly_Revenue"))
    )


# Q19
def daily_spikes(star: Star, factor: int = 2) -> DataFrame:
    """Days on which a product sold at least ``factor`` times its average over days with sales.

    A product has at most one row per calendar day here, so the window over a product is bounded.
    The test multiplies instead of dividing and is exact.
    """
    daily = star.fact_sales.groupBy("Product_Key", "Date_Key").agg(F.sum(_revenue()).alias("Daily_Sales"))
    product = Window.partitionBy("Product_Key")
    compared = daily.withColumn("Total", F.sum("Daily_Sales").over(product)).withColumn(
        "Days", F.count(F.lit(1)).over(product)
    )
    spikes = compared.where(F.col("Daily_Sales") * F.col("Days") >= F.col("Total") * factor)
    days = F.broadcast(star.dim_date.select("Date_Key", "Full_Date", "Day_Name"))
    return (
        _with(spikes.join(days, "Date_Key"), star.dim_product, "Product_Key", "Product_ID", "Product_Category")
        .select(
            "Product_ID", "Product_Category", "Full_Date", "Day_Name",
            numeric.as_double(F.col("Daily_Sales"), "Daily_Sales"),
            numeric.as_double(numeric.mean(F.col("Total"), F.col("Days"), 2), "Avg_Daily_Sales"),
            numeric.as_double(numeric.ratio(F.col("Daily_Sales") * F.col("Days"), F.col("Total")), "Sales_Multiple"),
            F.lit("HIGH SPIKE").alias("Anomaly_Flag"),
        )
        .orderBy("Product_ID", F.desc("Daily_Sales"))
    )


# Q20
STORE_QUARTERLY_VIEW = "STORE_QUARTERLY_SALES"


def create_store_quarterly_view(star: Star) -> None:
    """(Re)create the view; it stays a logical plan, sorting is left to its readers."""
    grouped = roll_up(
        star, sales_on(star, star.dim_date, "Year", "Quarter"), {"dim_store": ["Store_ID", "Store_Name"]},
        ["Year", "Quarter"],
        {"Quarterly_Sales": _revenue(), "Quarterly_Quantity": _quantity(), "Total_Transactions": _one()},
        count_customers=True,
    )
    grouped.select(
        "Store_ID", "Store_Name", "Year", "Quarter",
        rules.quarter_label(F.col("Quarter"), F.col("Year")).alias("Quarter_Label"),
        numeric.as_double(F.col("Quarterly_Sales"), "Quarterly_Sales"), "Quarterly_Quantity",
        "Total_Transactions", "Unique_Customers",
        _mean_sale("Quarterly_Sales", "Total_Transactions", "Avg_Transaction_Value"),
    ).createOrReplaceTempView(STORE_QUARTERLY_VIEW)


def store_quarterly_sales(star: Star) -> DataFrame:
    create_store_quarterly_view(star)
    return star.fact_sales.sparkSession.table(STORE_QUARTERLY_VIEW).orderBy("Store_Name", "Year", "Quarter")
