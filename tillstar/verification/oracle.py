"""Independent SQL for every registered query, run by another engine on the given tables.

Money is whole cents here and ratios are rounded half-up by integer division, so the results equal
exact decimal arithmetic without depending on an engine's decimal or rounding rules.
"""

from __future__ import annotations

import re

from tillstar.catalog import (
    CUSTOMER_PAGE_START,
    PAGE_SIZE,
    PRODUCT_PAGE_START,
    YEAR,
    YEARS,
)
from tillstar.sources import binding


def _listed(expressions: dict[str, str]) -> str:
    return ", ".join(f'{text} as "{name}"' for name, text in expressions.items())


def _mean(cents: str, n: str, digits: int) -> str:
    step = 10 ** (digits - 2)
    return f"((2 * {step} * cast({cents} as hugeint) + {n}) // (2 * nullif({n}, 0))) / {10 ** digits}.0"


def _pct(part: str, whole: str) -> str:
    return f"((20000 * cast({part} as hugeint) + {whole}) // (2 * nullif({whole}, 0))) / 100.0"


def _growth(now: str, before: str) -> str:
    return f"sign({now} - {before}) * ({_pct(f'abs({now} - {before})', before)})"


def _int(expression: str) -> str:
    return f"cast({expression} as integer)"


def _big(expression: str) -> str:
    return f"cast({expression} as bigint)"


_TIES = ", ".join(binding.TRANSACTION_ORDER)
_STAY = "coalesce(try_cast(replace(Stay_In_Current_City_Years, '+', '') as integer), 0)"


def _product_dims(prefix: str) -> dict[str, str]:
    """Keyed products, stores and suppliers over ``<prefix>raw_product``."""
    raw = f"{prefix}raw_product"
    return {
        f"{prefix}prod": f"""
            select row_number() over (order by Product_ID) as Product_Key, * from {raw}""",
        f"{prefix}store": f"""
            select row_number() over (order by StoreID, StoreName) as Store_Key, StoreID as Store_ID,
                   StoreName as Store_Name, count(distinct Product_ID) as skus,
                   count(distinct Product_Category) as categories,
                   {_mean('sum(price_cents)', 'count(price_cents)', 2)} as avg_price
            from {raw} where StoreID is not null and StoreName is not null group by StoreID, StoreName""",
        f"{prefix}supp": f"""
            select row_number() over (order by t.SupplierID) as Supplier_Key, t.SupplierID as Supplier_ID,
                   t.SupplierName as Supplier_Name, t.skus, t.avg_price, c.Product_Category as main_category
            from (select SupplierID, SupplierName, count(distinct Product_ID) as skus,
                         {_mean('sum(price_cents)', 'count(price_cents)', 2)} as avg_price
                  from {raw} where SupplierID is not null and SupplierName is not null
                  group by SupplierID, SupplierName) t
            join (select SupplierID, SupplierName, Product_Category,
                         row_number() over (partition by SupplierID, SupplierName
                                            order by count(*) desc, Product_Category) as pos
                  from {raw} group by SupplierID, SupplierName, Product_Category) c
              on c.SupplierID = t.SupplierID and c.SupplierName = t.SupplierName and c.pos = 1""",
    }


def _raw_product(condition: str, wrong: dict[str, str] = {}) -> str:
    return f"""
        select b.Product_ID, b.Product_Category, b.price, {_big('b.price * 100')} as price_cents,
               cast(b.storeID as varchar) as StoreID, concat('Store ', b.storeID) as StoreName,
               cast(b.supplierID as varchar) as SupplierID, s.s_name as SupplierName
        from (select {_listed({**binding.PRODUCT_BINDING, **wrong})} from part where {condition}) b
        left join supplier s on s.s_suppkey = b.supplierID"""


def _raw_customer(condition: str) -> str:
    return f"select {_listed(binding.CUSTOMER_BINDING)} from customer where {condition}"


def _faulty_lines(condition: str, wrong: dict[str, str]) -> str:
    column = {**binding.TRANSACTION_BINDING, **wrong}
    return f"""
        select l_orderkey, cast({column['Customer_ID']} as bigint), {column['Product_ID']}, cast({column['quantity']} as integer),
               {column['date']}, {_TIES}
        from lineitem, orders where l_orderkey = o_orderkey and {condition}"""


_PARTS: dict[str, str] = {
    "raw_customer": _raw_customer("true"),
    "raw_product": _raw_product("true"),
    # the whole masters with the products that cannot be sold
    "held_raw_product": " union all ".join(
        [_raw_product("true"), *[_raw_product(binding.FAULTY_PRODUCT_MODEL, wrong) for wrong in binding.FAULTY_PRODUCTS]]
    ),
    "cust": "select row_number() over (order by Customer_ID) as Customer_Key, * from raw_customer",
    **_product_dims(""),
    **_product_dims("held_"),
    "tx": f"""
        select l_orderkey as Order_ID, o_custkey as Customer_ID,
               {binding.TRANSACTION_BINDING['Product_ID']} as Product_ID,
               cast(l_quantity as integer) as Quantity, cast(o_orderdate as date) as Sale_Date, {_TIES}
        from lineitem, orders where l_orderkey = o_orderkey""",
    "cal": f"""
        select cast(d as date) as Full_Date, {_int("year(d)")} as Year, {_int("month(d)")} as Month,
               monthname(d) as Month_Name, {_int("quarter(d)")} as Quarter, dayname(d) as Day_Name,
               {_int("isodow(d) >= 6")} as Is_Weekend,
               {_int("year(d) * 10000 + month(d) * 100 + day(d)")} as Date_Key,
               case when month(d) in (12, 1, 2) then 'Winter' when month(d) < 6 then 'Spring'
                    when month(d) < 9 then 'Summer' else 'Fall' end as Season
        from (select unnest(generate_series(make_date(lo, 1, 1), make_date(hi, 12, 31), interval 1 day)) as d
              from (select year(min(Sale_Date)) as lo, year(max(Sale_Date)) as hi from tx))""",
    "picked": f"""
        select *, row_number() over (partition by Order_ID, Product_ID, Sale_Date order by {_TIES}) as pos,
               count(*) over (partition by Order_ID, Product_ID, Sale_Date) as group_size
        from tx""",
    # one row per fact with the attributes of its dimensions
    "sales": f"""
        select t.Order_ID, t.Quantity, t.Customer_ID, c.Customer_Key, c.Gender, c.Age, c.Occupation,
               c.City_Category, c.Stay_In_Current_City_Years, c.Marital_Status,
               p.Product_Key, p.Product_ID, p.Product_Category, p.price, st.Store_Key, st.Store_ID, st.Store_Name,
               su.Supplier_Key, su.Supplier_ID, su.Supplier_Name, d.*,
               {_big('t.Quantity * p.price_cents')} as cents
        from picked t
        join cust c on c.Customer_ID = t.Customer_ID
        join prod p on p.Product_ID = t.Product_ID
        join store st on st.Store_ID = p.StoreID
        join supp su on su.Supplier_ID = p.SupplierID
        join cal d on d.Full_Date = t.Sale_Date
        where t.pos = 1""",
    # every transaction, and the faulty ones, against the masters with the faulty products
    "held_tx": " union all ".join(["select * from tx", *[_faulty_lines(f, wrong) for f, wrong in binding.FAULTY_LINES]]),
    "held": f"""
        select t.*, c.Customer_Key, p.Product_Key, st.Store_Key, su.Supplier_Key, d.Date_Key, p.price,
               case when t.Quantity is null then 'unparsable'
                    when c.Customer_Key is null then 'customer_not_found'
                    when p.Product_Key is null then 'product_not_found'
                    when st.Store_Key is null then 'store_not_found'
                    when su.Supplier_Key is null then 'supplier_not_found'
                    when d.Date_Key is null then 'date_out_of_calendar'
                    when t.Quantity <= 0 then 'quantity_not_positive'
                    when p.price is null then 'price_missing'
                    when t.Quantity * cast(p.price_cents as hugeint) > 999999999999 then 'amount_out_of_range' end as reason
        from held_tx t
        left join cust c on c.Customer_ID = t.Customer_ID
        left join held_prod p on p.Product_ID = t.Product_ID
        left join held_store st on st.Store_ID = p.StoreID
        left join held_supp su on su.Supplier_ID = p.SupplierID
        left join cal d on d.Full_Date = t.Sale_Date""",
    "held_picked": f"""
        select *, row_number() over (partition by Order_ID, Product_ID, Sale_Date order by {_TIES}) as pos
        from held where reason is null""",
}


def _sql(select: str) -> str:
    """Prefix ``select`` with the parts it mentions, directly or through other parts."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name, body in _PARTS.items():
            if name not in ordered and re.search(rf"(?<![\w.]){name}(?!\w)", text):
                visit(body)
                if name not in ordered:
                    ordered.append(name)

    visit(select)
    parts = ",\n".join(f"{name} as materialized ({_PARTS[name].strip()})" for name in ordered)
    return f"with {parts}\n{select.strip()}" if ordered else select.strip()


_TIER = "case upper(City_Category) when 'A' then 'Metro' when 'B' then 'Urban' when 'C' then 'Town' else 'Unknown' end"
_STAY_BUCKET = (
    f"case when {_STAY} >= 4 then '4+ yrs' when {_STAY} = 1 then '1 yr' "
    f"when {_STAY} between 2 and 3 then concat({_STAY}, ' yrs') else '0 yrs' end"
)
_JOB = (
    "case when Occupation >= 15 then 'Executive' when Occupation >= 10 then 'Professional' "
    "when Occupation >= 5 then 'Skilled' else 'Entry' end"
)
_DAY_TYPE = "case when Is_Weekend = 1 then 'Weekend' else 'Weekday' end"
_SUM = "sum(cents) / 100.0"
_ITEMS = _big("sum(Quantity)")
_AVG6 = _mean("sum(cents)", "count(*)", 6)


def _olap() -> dict[str, str]:
    return {
        "q01_top_products_day_type_monthly": f"""
            select m.Product_ID, m.Product_Category, m.Day_Type, y.Day_Rank, m.Month, m.Month_Name,
                   m.cents / 100.0 as Monthly_Revenue, m.items as Monthly_Quantity, y.cents / 100.0 as Yearly_Revenue
            from (select Product_ID, Product_Category, {_DAY_TYPE} as Day_Type, Month, Month_Name,
                         sum(cents) as cents, {_ITEMS} as items
                  from sales where Year = {YEAR} group by all) m
            join (select Product_ID, Day_Type, cents, rank() over (partition by Day_Type order by cents desc) as Day_Rank
                  from (select Product_ID, {_DAY_TYPE} as Day_Type, sum(cents) as cents
                        from sales where Year = {YEAR} group by all)) y
              on y.Product_ID = m.Product_ID and y.Day_Type = m.Day_Type and y.Day_Rank <= 5""",
        "q02_demographics_share": f"""
            select Gender, Age, City_Category, {_TIER} as City_Tier, n as Total_Transactions,
                   cents / 100.0 as Total_Purchase_Amount, {_mean('cents', 'n', 6)} as Avg_Purchase_Amount,
                   {_pct('cents', '(select sum(cents) from sales)')} as Revenue_Share_Pct,
                   people as Unique_Customers
            from (select Gender, Age, City_Category, count(*) as n, sum(cents) as cents,
                         count(distinct Customer_ID) as people from sales group by all)""",
        "q03_category_by_occupation": f"""
            select Product_Category, Occupation, {_JOB} as Occupation_Bucket, count(*) as Total_Transactions,
                   {_SUM} as Total_Sales, {_ITEMS} as Total_Quantity, {_AVG6} as Avg_Transaction_Value
            from sales group by Product_Category, Occupation""",
        "q04_gender_age_quarterly": f"""
            select Gender, Age, Year, Quarter, concat('Q', Quarter, '-', Year) as Quarter_Label,
                   count(*) as Total_Transactions, {_SUM} as Total_Purchase_Amount, {_AVG6} as Avg_Purchase_Amount
            from sales where Year = {YEAR} group by Gender, Age, Year, Quarter""",
        "q05_top_occupations_per_category": f"""
            select Product_Category, Occupation, {_JOB} as Occupation_Bucket, cents / 100.0 as Total_Sales, Sales_Rank
            from (select Product_Category, Occupation, sum(cents) as cents,
                         dense_rank() over (partition by Product_Category order by sum(cents) desc) as Sales_Rank
                  from sales group by Product_Category, Occupation) where Sales_Rank <= 5""",
        "q06_city_marital_last6m": f"""
            select City_Category, Marital_Status, Year, Month, Month_Name, {_SUM} as Total_Purchase_Amount,
                   count(*) as Total_Transactions, count(distinct Customer_ID) as Unique_Customers
            from sales
            where Full_Date > (select max(Full_Date) - interval 6 month from cal)
            group by City_Category, Marital_Status, Year, Month, Month_Name""",
        "q07_stay_gender_avg": f"""
            select Stay_In_Current_City_Years, {_STAY_BUCKET} as Stay_Bucket, Gender, count(*) as Total_Transactions,
                   {_SUM} as Total_Purchase_Amount, {_AVG6} as Avg_Purchase_Amount,
                   count(distinct Customer_ID) as Unique_Customers
            from sales group by Stay_In_Current_City_Years, Gender""",
        "q08_top_cities_per_category": f"""
            select Product_Category, City_Category, {_TIER} as City_Tier, cents / 100.0 as Total_Revenue, Revenue_Rank
            from (select Product_Category, City_Category, sum(cents) as cents,
                         rank() over (partition by Product_Category order by sum(cents) desc) as Revenue_Rank
                  from sales group by Product_Category, City_Category) where Revenue_Rank <= 5""",
        "q09_monthly_growth": f"""
            select Product_Category, Year, Month, Month_Name, now / 100.0 as Monthly_Sales,
                   past / 100.0 as Previous_Month_Sales, {_growth('now', 'past')} as Growth_Percentage
            from (select *, lag(now) over (partition by Product_Category order by Month) as past
                  from (select Product_Category, Year, Month, Month_Name, sum(cents) as now
                        from sales where Year = {YEAR} group by all))""",
        "q10_weekend_vs_weekday_by_age": f"""
            select Age, (whole - free) / 100.0 as Weekday_Sales, free / 100.0 as Weekend_Sales,
                   whole / 100.0 as Total_Sales, {_pct('free', 'whole')} as Weekend_Percentage
            from (select Age, sum(cents) as whole, sum(cents * Is_Weekend) as free
                  from sales where Year = {YEAR} group by Age)""",
        "q11_top5_products_month_day_type": f"""
            select Product_ID, Product_Category, Year, Month, Month_Name, Day_Type, cents / 100.0 as Revenue, Revenue_Rank
            from (select *, row_number() over (partition by Month, Day_Type order by cents desc, Product_ID) as Revenue_Rank
                  from (select Product_ID, Product_Category, Year, Month, Month_Name, {_DAY_TYPE} as Day_Type,
                               sum(cents) as cents
                        from sales where Year = {YEAR} group by all)) where Revenue_Rank <= 5""",
        "q12_store_quarterly_growth": f"""
            select Store_ID, Store_Name, Year, Quarter, concat('Q', Quarter, '-', Year) as Quarter_Label,
                   now / 100.0 as Quarterly_Revenue, past / 100.0 as Previous_Quarter_Revenue,
                   {_growth('now', 'past')} as Growth_Rate_Percentage
            from (select *, lag(now) over (partition by Store_ID order by Quarter) as past
                  from (select Store_ID, Store_Name, Year, Quarter, sum(cents) as now
                        from sales where Year = {YEAR} group by all))""",
        "q13_supplier_store_product": f"""
            select Store_Name, Store_ID, Supplier_Name, Supplier_ID, Product_ID, Product_Category,
                   {_SUM} as Total_Sales, {_ITEMS} as Total_Quantity, count(*) as Total_Transactions
            from sales group by Store_Name, Store_ID, Supplier_Name, Supplier_ID, Product_ID, Product_Category""",
        "q14_product_season": f"""
            select Product_ID, Product_Category, Season, Year, {_SUM} as Total_Sales, {_ITEMS} as Total_Quantity,
                   count(*) as Total_Transactions, {_AVG6} as Avg_Transaction_Value
            from sales group by Product_ID, Product_Category, Season, Year""",
        "q15_store_supplier_volatility": f"""
            select Store_ID, Store_Name, Supplier_ID, Supplier_Name, Year, Month, Month_Name,
                   now / 100.0 as Monthly_Revenue, past / 100.0 as Previous_Month_Revenue,
                   {_growth('now', 'past')} as Revenue_Change_Percentage,
                   abs({_growth('now', 'past')}) as Volatility_Percentage
            from (select *, lag(now) over (partition by Store_ID, Supplier_ID order by Year, Month) as past
                  from (select Store_ID, Store_Name, Supplier_ID, Supplier_Name, Year, Month, Month_Name,
                               sum(cents) as now from sales group by all))""",
        "q16_product_affinity": """
            select a.Product_ID as Product1_ID, a.Product_Category as Product1_Category,
                   b.Product_ID as Product2_ID, b.Product_Category as Product2_Category,
                   count(distinct a.Order_ID) as Times_Bought_Together
            from sales a join sales b on a.Order_ID = b.Order_ID and a.Product_ID < b.Product_ID
            group by all order by Times_Bought_Together desc, Product1_ID, Product2_ID limit 5""",
        "q17_yearly_rollup": f"""
            select case when grouping(Store_Name) = 1 then 'ALL STORES' else Store_Name end as StoreName,
                   case when grouping(Supplier_Name) = 1 then 'ALL SUPPLIERS' else Supplier_Name end as SupplierName,
                   case when grouping(Product_ID) = 1 then 'ALL PRODUCTS' else Product_ID end as Product_ID,
                   Year, {_SUM} as Total_Revenue, {_ITEMS} as Total_Quantity
            from sales where Year in {YEARS}
            group by rollup (Year, sales.Store_Name, sales.Supplier_Name, sales.Product_ID)""",
        "q18_half_year_split": f"""
            select Product_ID, Product_Category, Year, h1 / 100.0 as H1_Revenue, h2 / 100.0 as H2_Revenue,
                   (h1 + h2) / 100.0 as Yearly_Revenue, n1 as H1_Quantity, n2 as H2_Quantity,
                   n1 + n2 as Yearly_Quantity, {_pct('h1', '(h1 + h2)')} as H1_Revenue_Percentage,
                   {_pct('h2', '(h1 + h2)')} as H2_Revenue_Percentage
            from (select Product_ID, Product_Category, Year,
                         coalesce(sum(cents) filter (Month < 7), 0) as h1,
                         coalesce(sum(cents) filter (Month > 6), 0) as h2,
                         {_big('coalesce(sum(Quantity) filter (Month < 7), 0)')} as n1,
                         {_big('coalesce(sum(Quantity) filter (Month > 6), 0)')} as n2
                  from sales where Year = {YEAR} group by all)""",
        "q19_daily_spikes": f"""
            select Product_ID, Product_Category, Full_Date, Day_Name, cents / 100.0 as Daily_Sales,
                   {_mean('total', 'days', 2)} as Avg_Daily_Sales,
                   ((200 * cents * days + total) // (2 * nullif(total, 0))) / 100.0 as Sales_Multiple,
                   'HIGH SPIKE' as Anomaly_Flag
            from (select *, sum(cents) over (partition by Product_ID) as total,
                         count(*) over (partition by Product_ID) as days
                  from (select Product_ID, Product_Category, Full_Date, Day_Name,
                               cast(sum(cents) as hugeint) as cents from sales group by all))
            where cents * days >= 2 * total""",
        "q20_store_quarterly_sales": f"""
            select Store_ID, Store_Name, Year, Quarter, concat('Q', Quarter, '-', Year) as Quarter_Label,
                   {_SUM} as Quarterly_Sales, {_ITEMS} as Quarterly_Quantity, count(*) as Total_Transactions,
                   count(distinct Customer_ID) as Unique_Customers, {_AVG6} as Avg_Transaction_Value
            from sales group by Store_ID, Store_Name, Year, Quarter""",
    }


_PRICE = 'cast(price as double) as "Price"'
_MASTER_PRODUCT = f"Product_ID, Product_Category, {_PRICE}, StoreID, StoreName, SupplierID, SupplierName"
_CUSTOMER = "Customer_ID, Gender, Age, Occupation, City_Category, Stay_In_Current_City_Years, Marital_Status"
_ENRICHED = f"""
    t.Order_ID, t.Customer_ID, t.Product_ID, t.Quantity, t.Sale_Date, c.Gender, c.Age, c.Occupation, c.City_Category,
    c.Stay_In_Current_City_Years, c.Marital_Status"""
_PRODUCT_PART = """p.Product_Category, cast(p.price as double) as "Price", p.StoreID, p.StoreName,
    p.SupplierID, p.SupplierName"""
_SALE = "Order_ID, Customer_ID, Product_ID, Quantity, Sale_Date"


_STAGES = """
            stages as (
                select 1 as Stage_No, 'stream' as Stage, n as Rows_In, n as Rows_Out from totals
                union all select 2, 'customer_join', n, c from totals
                union all select 3, 'product_join', c, p from totals
                union all select 4, 'fact_load', p, f from totals
                union all select 5, 'end_to_end', n, f from totals)
            select Stage_No, Stage, Rows_In, Rows_Out, Rows_In - Rows_Out as Rows_Dropped,
                   ((20000 * Rows_Out + Rows_In) // (2 * nullif(Rows_In, 0))) / 100.0 as Rate_Pct
            from stages"""


def _tables() -> dict[str, str]:
    return {
        "clean_transactions": f"select {_SALE}, 0 as Unparsable from tx",
        "clean_products": f"select {_MASTER_PRODUCT} from raw_product",
        "master_customer": f"select {_CUSTOMER} from raw_customer",
        "master_product": f"select {_MASTER_PRODUCT} from raw_product",
        "dim_date": f"""
            select Date_Key, Full_Date, Day_Name as Day_Of_Week, Day_Name, Is_Weekend,
                   {_int('day(Full_Date)')} as Day_Of_Month, {_int('dayofyear(Full_Date)')} as Day_Of_Year,
                   {_int('weekofyear(Full_Date)')} as Week_Number, Month, Month_Name, Quarter,
                   concat('Q', Quarter) as Quarter_Label, case when Month > 6 then 'H2' else 'H1' end as Half_Year,
                   Year, Season, fm as Fiscal_Month, concat('F', (fm + 2) // 3) as Fiscal_Quarter,
                   case when Month = 1 then Year - 1 else Year end as Fiscal_Year
            from (select *, case when Month = 1 then 12 else Month - 1 end as fm from cal)""",
        "dim_customer": f"""
            select Customer_Key, Customer_ID, Gender, Age, Occupation, {_JOB} as Occupation_Bucket, City_Category,
                   {_TIER} as City_Tier, Stay_In_Current_City_Years, {_STAY_BUCKET} as Stay_Bucket, Marital_Status,
                   case Marital_Status when 1 then 'Married' else 'Single' end as Marital_Status_Label,
                   case when {_STAY} >= 4 then 'Advocate' when {_STAY} >= 2 then 'Loyal'
                        when Marital_Status = 0 then 'Newcomer' else 'Emerging Family' end as Loyalty_Segment
            from cust""",
        "dim_product": """
            select Product_Key, Product_ID, Product_Category, cast(price as double) as Unit_Price,
                   case when price is null then 'Unknown' when price >= 70 then 'Premium'
                        when price >= 40 then 'Core' else 'Value' end as Price_Band,
                   case when price >= 70 then 1 else 0 end as Is_Premium
            from prod""",
        "dim_store": """
            select Store_Key, Store_ID, Store_Name, 'In-Store' as Store_Channel,
                   case when skus >= 750 then 'Mega' when skus >= 350 then 'Large' else 'Compact' end as Store_Tier,
                   skus as SKU_Count, categories as Category_Count, avg_price as Avg_List_Price,
                   case when skus >= 750 or avg_price >= 60 then 1 else 0 end as Is_Flagship, 1 as Is_Active
            from store""",
        "dim_supplier": """
            select Supplier_Key, Supplier_ID, Supplier_Name,
                   case when skus >= 600 then 'Strategic' when skus >= 250 then 'Core' else 'Long Tail' end as Supplier_Tier,
                   main_category as Primary_Category, skus as SKU_Count, avg_price as Avg_List_Price,
                   cast(null as double) as Reliability_Score
            from supp""",
        "dim_lookup_counts": """
            select 'dim_date' as Table_Name, count(*) as Row_Count from cal
            union all select 'dim_customer', count(*) from cust
            union all select 'dim_product', count(*) from prod
            union all select 'dim_store', count(*) from store
            union all select 'dim_supplier', count(*) from supp""",
        "star_row_counts": """
            select 'dim_date' as Table_Name, count(*) as Row_Count from cal
            union all select 'dim_customer', count(*) from cust
            union all select 'dim_product', count(*) from prod
            union all select 'dim_store', count(*) from store
            union all select 'dim_supplier', count(*) from supp
            union all select 'fact_sales', count(*) from sales
            union all select 'master_customer', count(*) from raw_customer
            union all select 'master_product', count(*) from raw_product""",
        "enrich_customer": f"select {_ENRICHED} from tx t join raw_customer c on c.Customer_ID = t.Customer_ID",
        "enrich_product": f"""
            select {_ENRICHED}, {_PRODUCT_PART} from tx t join raw_customer c on c.Customer_ID = t.Customer_ID
            join raw_product p on p.Product_ID = t.Product_ID""",
        "etl_batch_join": f"""
            select {_ENRICHED}, {_PRODUCT_PART}, t.Quantity * p.price_cents / 100.0 as Total_Purchase
            from tx t join raw_customer c on c.Customer_ID = t.Customer_ID
            join raw_product p on p.Product_ID = t.Product_ID""",
        **{
            name: """
            select Order_ID, 1 as Order_Line_Number, Customer_Key, Product_Key, Store_Key, Supplier_Key, Date_Key,
                   Quantity, cast(price as double) as Unit_Price, cents / 100.0 as Total_Purchase_Amount,
                   cast(0 as double) as Discount_Amount, cents / 100.0 as Net_Sales_Amount,
                   Is_Weekend as Weekend_Flag, 'In-Store' as Order_Channel
            from sales"""
            for name in ("fact_sales", "fact_append", "csv_fact_load", "stream_fact_load")
        },
        "fact_rejects": f"""
            select {_SALE}, reason as Reason, count(*) as Copies from held where reason is not null group by all
            union all
            select {_SALE}, 'duplicate' as Reason, count(*) as Copies from held_picked where pos > 1
            group by {_SALE}""",
        "fact_dedup": f"select {_SALE}, group_size as Source_Rows from picked where pos = 1",
        "fact_duplicates": f"select {_SALE}, count(*) as Copies from picked where pos > 1 group by {_SALE}",
        "master_customer_page": f"""
            select {_CUSTOMER} from raw_customer where Customer_ID >= {CUSTOMER_PAGE_START}
            order by Customer_ID limit {PAGE_SIZE}""",
        "master_product_page": f"""
            select {_MASTER_PRODUCT} from raw_product where Product_ID >= '{PRODUCT_PAGE_START}'
            order by Product_ID limit {PAGE_SIZE}""",
        "load_audit": f"""
            with totals as (
                select count(*) as n, count(Customer_Key) as c,
                       count(*) filter (Customer_Key is not null and Product_Key is not null) as p,
                       (select count(*) from held_picked where pos = 1) as f
                from held),{_STAGES}""",
        "stream_load_audit": f"""
            with totals as (
                select count(*) as n, count(*) as c, count(*) as p, (select count(*) from picked where pos = 1) as f
                from (select 1 from tx union all select 1 from tx where {binding.LATE_LINES.replace('l_orderkey', 'Order_ID')})),{_STAGES}""",
    }


def _null_counts(table: str, source: str, columns: dict[str, str]) -> str:
    return " union all ".join(
        f"select '{table}' as Table_Name, '{c}' as Column_Name, '{kind}' as Data_Type, count({c}) as Non_Null_Count "
        f"from {source}"
        for c, kind in columns.items()
    )


def _broken(table: str, source: str, rules: dict[str, str]) -> str:
    return " union all ".join(
        f"select '{table}' as Table_Name, '{rule}' as Rule, count(*) as Violations from {source} where {condition}"
        for rule, condition in rules.items()
    )


def _missing(columns: list[str]) -> dict[str, str]:
    return {f"{c} not null": f"{c} is null" for c in columns}


def _unique(table: str, source: str, column: str, name: str) -> str:
    return f"""
        select '{table}' as Table_Name, '{name}' as Key_Column, {_big('coalesce(sum(n), 0)')} as Total_Rows,
               count({column}) as Distinct_Keys, count(*) filter (n > 1 and {column} is not null) as Repeated_Keys,
               case when count(*) filter (n > 1 and {column} is not null) = 0 then 1 else 0 end as Is_Unique
        from (select {column}, count(*) as n from {source} group by {column})"""


def _foreign(key: str, lost: str) -> str:
    return f"""
        select '{key}' as Foreign_Key, count(distinct {key}) as Missing_Keys, count(*) as Fact_Rows
        from sales where {lost}"""


def _orphans(key: str, master: str) -> str:
    gone = f"(select distinct {key} as k from held_tx where {key} not in (select {key} from {master}))"
    return f"""
        select 'orphan_keys' as Measure, cast(count(*) as varchar) as "Value" from {gone}
        union all
        select 'example', cast(k as varchar) from (select k from {gone} order by k limit 5)"""


def _summary(source: str, column: str, scale: int) -> str:
    exact = f"cast({column} as double)"
    return f"""
        select count({column}) as Value_Count,
               {_mean(f'sum(cast({column} * {scale} as bigint))', f'count({column})', 6)} as Mean,
               round(stddev_samp({exact}), 6) as Std_Dev, min({exact}) as Minimum,
               round(quantile_cont({exact}, 0.25), 6) as Quartile_1, round(quantile_cont({exact}, 0.5), 6) as Median,
               round(quantile_cont({exact}, 0.75), 6) as Quartile_3, max({exact}) as Maximum
        from {source}"""


def _reports() -> dict[str, str]:
    keys = ["Order_ID", "Customer_Key", "Product_Key", "Store_Key", "Supplier_Key", "Date_Key", "Quantity"]
    positive = {"Quantity > 0": "Quantity <= 0"}
    fact_rules = {**positive, **_missing(keys), "Unit_Price not null": "price is null",
                  "Total_Purchase_Amount not null": "cents is null"}
    profiled = ["Age", "Occupation", "City_Category", "Stay_In_Current_City_Years", "Gender", "Marital_Status"]
    return {
        "dq_key_uniqueness": " union all ".join([
            _unique("customer_master", "raw_customer", "Customer_ID", "Customer_ID"),
            _unique("product_master", "raw_product", "Product_ID", "Product_ID"),
            _unique("dim_customer", "cust", "Customer_ID", "Customer_ID"),
            _unique("dim_product", "prod", "Product_ID", "Product_ID"),
            _unique("dim_store", "store", "Store_ID", "Store_ID"),
            _unique("dim_supplier", "supp", "Supplier_ID", "Supplier_ID"),
            _unique("dim_date", "cal", "Full_Date", "Full_Date"),
            _unique("fact_sales", "(select row(Order_ID, Product_Key, Date_Key) as sale from sales)", "sale", "Sales_Key"),
        ]),
        "dq_orphan_customers": _orphans("Customer_ID", "raw_customer"),
        "dq_orphan_products": _orphans("Product_ID", "held_raw_product"),
        "dq_reconciliation": """
            select count(*) as Rows_Before, count(*) filter (found) as Rows_After, count(*) filter (not found) as Rows_Lost
            from (select Customer_ID in (select Customer_ID from raw_customer)
                         and Product_ID in (select Product_ID from held_raw_product) as found from held_tx)""",
        "dq_non_null_counts": " union all ".join([
            _null_counts("customer_master", "raw_customer", {
                "Customer_ID": "bigint", "Gender": "string", "Age": "string", "Occupation": "int",
                "City_Category": "string", "Stay_In_Current_City_Years": "string", "Marital_Status": "int"}),
            _null_counts("product_master", "raw_product", {
                "Product_ID": "string", "Product_Category": "string", "Price": "decimal(10,2)", "StoreID": "string",
                "StoreName": "string", "SupplierID": "string", "SupplierName": "string"}),
            _null_counts("transactions", "tx", {
                "Order_ID": "bigint", "Customer_ID": "bigint", "Product_ID": "string", "Quantity": "int",
                "Sale_Date": "date"}),
        ]),
        "dq_fk_violations": " union all ".join([
            _foreign("Customer_Key", "Order_ID % 50 = 1"),
            _foreign("Product_Key", "Order_ID % 50 = 2"),
            _foreign("Store_Key", "Order_ID % 50 = 3"),
            _foreign("Supplier_Key", "Order_ID % 50 = 4"),
            _foreign("Date_Key", "Order_ID % 50 = 5"),
        ]),
        "dq_constraint_violations": " union all ".join([
            _broken("staged_sales", "held", {**positive, **_missing(keys), "Price not null": "price is null"}),
            _broken("fact_sales", "sales", fact_rules),
            _broken("dim_date", "cal", _missing(["Full_Date"])),
            _broken("dim_customer", "cust", _missing(["Customer_ID"])),
            _broken("dim_product", "prod", _missing(["Product_ID"])),
            _broken("dim_store", "store", _missing(["Store_ID"])),
            _broken("dim_supplier", "supp", _missing(["Supplier_ID"])),
        ]),
        "dq_multi_product_orders": """
            select Order_ID, count(distinct Product_Key) as Product_Count from sales
            group by Order_ID having count(distinct Product_Key) > 1""",
        "eda_customer_value_counts": " union all ".join(
            f"""select '{c}' as Column_Name, cast({c} as varchar) as "Value", count(*) as Row_Count
                from raw_customer where {c} is not null group by {c}""" for c in profiled
        ),
        "eda_category_counts": """
            select Product_Category, count(*) as Row_Count from raw_product
            where Product_Category is not null group by Product_Category""",
        "eda_distinct_entities": """
            select 'StoreName' as Column_Name, count(distinct StoreName) as Distinct_Values from raw_product
            union all select 'SupplierName', count(distinct SupplierName) from raw_product""",
        "eda_joined_head": f"""
            select t.Order_ID, t.Customer_ID, t.Product_ID, t.Quantity, t.Sale_Date, c.Gender, p.Product_Category,
                   t.Quantity * p.price_cents / 100.0 as Total_Purchase
            from tx t join raw_customer c on c.Customer_ID = t.Customer_ID join raw_product p on p.Product_ID = t.Product_ID
            order by 1, 2, 3, 4, 5 limit 5""",
        "eda_distinct_sketch": " union all ".join(
            f"select '{c}' as Column_Name, count(distinct {c}) as Distinct_Values, 1 as Sketch_Is_Near from tx"
            for c in ("Customer_ID", "Product_ID", "Order_ID")
        ),
        "eda_price_summary": _summary("raw_product", "price", 100),
        "eda_quantity_summary": _summary("tx", "Quantity", 100),
        "eda_quantity_counts": "select Quantity, count(*) as Row_Count from tx group by Quantity",
        "eda_date_range": "select min(Sale_Date) as First_Date, max(Sale_Date) as Last_Date from tx",
        "eda_tx_by_year": f"select {_int('year(Sale_Date)')} as Year, count(*) as Row_Count from tx group by 1",
        "eda_hot_customers": """
            select Customer_ID, count(*) as Row_Count from tx group by Customer_ID
            order by Row_Count desc, Customer_ID limit 10""",
        "eda_hot_products": """
            select Product_ID, count(*) as Row_Count from tx group by Product_ID
            order by Row_Count desc, Product_ID limit 10""",
    }


def _alike(selects: dict[str, str]) -> dict[str, str]:
    """Queries that have to give what another one gives, by other means."""
    return {
        "q20_saved_quarters": selects["q20_store_quarterly_sales"],
        "bucketed_q02": selects["q02_demographics_share"],
        "bucketed_q03": selects["q03_category_by_occupation"],
        "bucketed_q05": selects["q05_top_occupations_per_category"],
        "bucketed_q08": selects["q08_top_cities_per_category"],
        "fact_compacted": selects["fact_sales"],
        "star_recreated_counts": selects["star_row_counts"],
        "star_reloaded_counts": selects["star_row_counts"],
    }


def statements() -> dict[str, str]:
    selects = {**_olap(), **_tables(), **_reports()}
    selects |= _alike(selects)
    # an inner WITH follows the shared parts as further parts
    return {name: _sql(text).replace("\nwith totals as", ",\ntotals as") for name, text in selects.items()}
