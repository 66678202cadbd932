"""The registered queries in SQL, written on their own and not derived from the Spark code.

Dates are rendered as ISO text, and doubles are rounded through decimal text, as a plain `round`
works on the binary value and not on the shortest decimal one.
"""

from __future__ import annotations

RAW_PRODUCTS = """
select case when p_partkey % 97 = 5 then null else concat(' sku-', cast(p_partkey as varchar), ' ') end as sku_id,
       concat(' ', p_name) as sku_name, concat(p_type, ' goods ') as category,
       concat(' ', p_name) as subcategory, concat(p_brand, ' ') as brand,
       case when p_partkey % 53 = 0 then null when p_partkey % 50 = 1 then cast(0 as double)
            else p_retailprice end as list_price
from part
union all
select concat('SKU-', cast(p_partkey as varchar)), 'dup', p_type, p_name, p_brand, p_retailprice + 1
from part where p_partkey % 10 = 0
"""

RAW_STORES = """
select concat('st-', cast(s_suppkey as varchar), ' ') as store_id, concat(n_name, ' ') as country,
       concat(' City ', cast(s_suppkey % 7 as varchar)) as city, r_name as channel,
       case when s_suppkey % 41 = 3 then null else cast((s_suppkey * 37) % 190 - 94 as double) end as latitude,
       cast((s_suppkey * 91) % 370 - 184 as double) as longitude
from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
"""

RAW_SALES = """
select case when l_orderkey % 211 = 0 then 'bad-date' else cast(cast(l_shipdate as date) as varchar) end as date,
       cast(extract(year from l_shipdate) as int) as year, cast(extract(month from l_shipdate) as int) as month,
       cast(extract(day from l_shipdate) as int) as day, cast(extract(week from l_shipdate) as int) as weekofyear,
       cast((l_orderkey + l_linenumber) % 7 as int) as weekday,
       case when (l_orderkey + l_linenumber) % 7 in (0, 6) then 1 else 0 end as is_weekend,
       case when l_orderkey % 30 = 0 then 1 else 0 end as is_holiday,
       l_tax * 400 - cast(2 as double) as temperature, l_tax * 100 as rain_mm,
       concat(' st-', cast(l_suppkey as varchar)) as store_id,
       concat('sku-', cast(l_partkey as varchar), ' ') as sku_id,
       case when l_orderkey % 307 = 0 then null when l_orderkey % 401 = 0 then -1
            else cast(l_quantity as int) end as units_sold,
       l_discount * 6 as discount_pct, case when l_discount > 0 then 1 else 0 end as promo_flag,
       l_extendedprice as gross_sales, floor(l_extendedprice * (1 - l_discount) * 100) / 100 as net_sales,
       cast(l_linenumber * 10 as int) as stock_on_hand,
       case when l_returnflag = 'R' then 1 else 0 end as stock_out_flag,
       cast(l_orderkey % 21 as int) as lead_time_days, concat('sup-', cast(l_suppkey as varchar)) as supplier_id,
       floor(l_extendedprice / l_quantity * 70) / 100 as purchase_cost, cast(0.3 as double) as margin_pct
from (select * from lineitem union all select * from lineitem where l_orderkey % 100 = 0)
"""


def _cents(amount: str) -> str:
    return f"cast(round(cast(cast({amount} as varchar) as decimal(38,18)), 2) as double)"


def _title(text: str) -> str:
    words = f"list_transform(string_split({text}, ' '), lambda w: upper(w[1]) || lower(w[2:]))"
    return f"array_to_string({words}, ' ')"


NORM_PRODUCTS = f"""
select upper(trim(sku_id)) as sku_id, trim(sku_name) as sku_name, {_title('trim(category)')} as category,
       {_title('trim(subcategory)')} as subcategory, trim(brand) as brand, {_cents('list_price')} as list_price
from raw_products
"""

CLEAN_PRODUCTS = """
select sku_id, sku_name, category, subcategory, brand, list_price
from (select *, row_number() over (partition by sku_id order by sku_name nulls first, category nulls first,
             subcategory nulls first, brand nulls first, list_price nulls first) as place
      from norm_products where sku_id is not null and list_price > 0)
where place = 1
"""

NORM_STORES = """
select upper(trim(store_id)) as store_id, trim(country) as country, trim(city) as city, trim(channel) as channel,
       latitude, longitude
from raw_stores
"""

CLEAN_STORES = """
select store_id, country, city, channel, latitude, longitude
from (select *, row_number() over (partition by store_id order by country nulls first, city nulls first,
             channel nulls first, latitude nulls first, longitude nulls first) as place
      from norm_stores
      where store_id is not null and latitude between -90 and 90 and longitude between -180 and 180)
where place = 1
"""

NORM_SALES = """
select * replace (upper(trim(store_id)) as store_id, upper(trim(sku_id)) as sku_id,
                  upper(trim(supplier_id)) as supplier_id, try_cast(date as date) as date)
from raw_sales
"""

CLEAN_SALES = """
select * replace (coalesce(units_sold, 0) as units_sold, coalesce(gross_sales, 0) as gross_sales,
                  coalesce(net_sales, 0) as net_sales, coalesce(stock_on_hand, 0) as stock_on_hand,
                  coalesce(purchase_cost, 0) as purchase_cost)
from (select distinct * from norm_sales)
where date is not null and store_id is not null and sku_id is not null and units_sold >= 0 and gross_sales >= 0
  and net_sales >= 0 and stock_on_hand >= 0 and purchase_cost >= 0
"""

JOINED = """
select s.*, p.sku_name, p.category, p.subcategory, p.brand, p.list_price, t.country, t.city, t.channel,
       t.latitude, t.longitude
from clean_sales s join clean_products p on s.sku_id = p.sku_id join clean_stores t on s.store_id = t.store_id
"""

SEASON = """case when rain_mm > cast(5 as double) then 'Monsoon' when temperature < cast(8 as double) then 'Winter'
     when temperature > cast(17 as double) then 'Summer' else 'Autumn/Spring' end"""

WEEKDAY = """case weekday when 0 then 'Sunday' when 1 then 'Monday' when 2 then 'Tuesday' when 3 then 'Wednesday'
     when 4 then 'Thursday' when 5 then 'Friday' else 'Saturday' end"""

BAND = """case when discount_pct = 0 then 'No Discount' when discount_pct <= cast(0.10 as double) then '0-10%'
     when discount_pct <= cast(0.25 as double) then '10-25%' when discount_pct <= cast(0.50 as double) then '25-50%'
     else '50%+' end"""

RISK = """case when stock_out_flag = 1 then 'Stock Out' when stock_on_hand < units_sold then 'Understocked'
     when lead_time_days >= 14 then 'Long Lead Time' else 'Normal' end"""

DISCOUNT = _cents("gross_sales - net_sales")
COST = _cents("purchase_cost * units_sold")
PROFIT = _cents("net_sales - total_cost")
PER_UNIT = f"case when units_sold > 0 then {_cents('net_sales / units_sold')} else cast(0 as double) end"

ENRICHED = f"""
select *, {PROFIT} as profit_amount
from (select *, {SEASON} as season, {WEEKDAY} as weekday_name, {DISCOUNT} as discount_amount, {COST} as total_cost,
             {PER_UNIT} as revenue_per_unit, {BAND} as discount_band, {RISK} as inventory_risk
      from joined)
"""

OVERVIEW = """
select cast(date as varchar) as date, weekday_name, is_weekend, is_holiday, season, store_id, country, city, channel,
       sku_id, sku_name, category, subcategory, brand, units_sold, discount_band, discount_amount, promo_flag,
       gross_sales, net_sales, profit_amount, margin_pct, inventory_risk
from enriched
"""

# Envelopes of 1000 over all sales rows: which row is in which one is open, their sizes are not.
ENVELOPES = """
select cast(i + 1 as int) as batch_id, cast(least(1000, n - i * 1000) as int) as n_rows
from (select n, unnest(range(0, cast(ceil(n / 1000) as bigint))) as i from (select count(*) as n from raw_sales))
"""

_PRICES = """
(select case when l_linenumber <> 7 then l_extendedprice * case when l_orderkey % 2 = 0 then 1 else 1000 end end as price
 from lineitem)"""


def _rejections() -> str:
    """Rows of each feed that fail each rule; a null fails."""
    rules = {
        "products": {"sku_id is known": "sku_id is not null", "list_price above zero": "list_price > 0"},
        "stores": {
            "store_id is known": "store_id is not null",
            "latitude in range": "latitude between -90 and 90",
            "longitude in range": "longitude between -180 and 180",
        },
        "sales": {f"{c} is known": f"{c} is not null" for c in ("date", "store_id", "sku_id")}
        | {f"{c} not negative": f"{c} >= 0" for c in ("units_sold", "gross_sales", "net_sales", "stock_on_hand", "purchase_cost")},
    }
    parts = [
        f"select '{feed}' as feed, '{name}' as rule, count(*) filter (where not coalesce({condition}, false)) as n_rows from norm_{feed}"
        for feed, of_feed in rules.items()
        for name, condition in [*of_feed.items(), ("any rule", " and ".join(of_feed.values()))]
    ]
    return " union all ".join(parts)


# A third of all sales on one product.
SPLIT_SALES = """
select * replace (case when lead_time_days % 3 = 0 then 'SKU-2' else sku_id end as sku_id) from clean_sales
"""

_VIEWS = {
    "raw_products": RAW_PRODUCTS,
    "raw_stores": RAW_STORES,
    "raw_sales": RAW_SALES,
    "norm_products": NORM_PRODUCTS,
    "clean_products": CLEAN_PRODUCTS,
    "norm_stores": NORM_STORES,
    "clean_stores": CLEAN_STORES,
    "norm_sales": NORM_SALES,
    "clean_sales": CLEAN_SALES,
    "split_sales": SPLIT_SALES,
    "joined": JOINED,
    "enriched": ENRICHED,
    "overview": OVERVIEW,
    "envelopes": ENVELOPES,
}

_DATED = "* replace (cast(date as varchar) as date)"

_QUERIES = {
    # Whole jobs
    "clean_products": "select * from clean_products",
    "clean_stores": "select * from clean_stores",
    "clean_sales": f"select {_DATED} from clean_sales",
    "clean_sales_staged": f"select {_DATED} from clean_sales",
    "replaced_table": "select * from clean_products",
    "join_sources": f"select {_DATED} from joined",
    "join_sources_split": f"""
        select {_DATED} from ({JOINED.replace("from clean_sales s", "from split_sales s")})""",
    "enriched": f"select {_DATED} from enriched",
    "retail_sales_overview": "select * from overview",
    # Normalising and typing
    "normalize_keys": """
        select store_id, sku_id, supplier_id, count(*) as n from norm_sales group by all""",
    "trim_text": "select sku_name, brand, count(*) as n from norm_products group by all",
    "initcap_category": "select category, subcategory, count(*) as n from norm_products group by all",
    "round_price": "select sku_id, list_price from norm_products",
    "parse_date": """
        select raw.date as text, cast(try_cast(raw.date as date) as varchar) as date, count(*) as n
        from raw_sales raw group by all""",
    "coerce_types": "select * from raw_sales",
    "coerce_decimal_text": """
        select l_orderkey, l_linenumber, cast(trunc(l_extendedprice) as int) as whole,
               cast(null as int) as no_number, l_discount as share
        from lineitem""",
    # Filters
    "filter_keys": """
        select cast(date as varchar) as date, store_id, sku_id, units_sold from norm_sales
        where date is not null and store_id is not null and sku_id is not null""",
    "filter_product_key": "select sku_id, sku_name from norm_products where sku_id is not null",
    "filter_price": "select * from norm_products where list_price is not null and list_price > 0",
    "filter_geo": """
        select * from norm_stores where latitude between -90 and 90 and longitude between -180 and 180""",
    "filter_store_key": "select store_id, country from norm_stores where store_id is not null",
    "filter_nonneg": """
        select store_id, sku_id, units_sold, gross_sales, net_sales, stock_on_hand, purchase_cost from norm_sales
        where units_sold >= 0 and gross_sales >= 0 and net_sales >= 0 and stock_on_hand >= 0 and purchase_cost >= 0""",
    "fill_after_filter": """
        select l_orderkey, l_linenumber, case when l_linenumber = 3 then cast(0 as double) else l_extendedprice end as amount
        from lineitem where l_linenumber <> 5""",
    "rejections": _rejections(),
    "clean_report": f"""
        {_rejections()}
        union all select 'products', 'written', count(*) from clean_products
        union all select 'stores', 'written', count(*) from clean_stores
        union all select 'sales', 'written', count(*) from clean_sales""",
    "coerce_rescued": """
        select name, text, count(*) as n from (
            select 'flag' as name, l_returnflag as text from lineitem
            union all select 'amount', '3e2x' from lineitem where l_linenumber = 3
            union all select 'status', l_linestatus from lineitem where l_linenumber <> 2)
        group by all""",
    # Duplicates
    "dedup_products": CLEAN_PRODUCTS.replace("where sku_id is not null and list_price > 0", ""),
    "dedup_stores": """
        select store_id, country, city, channel, latitude, longitude
        from (select *, row_number() over (partition by store_id order by country nulls first, city nulls first,
                     channel nulls first, latitude nulls first, longitude nulls first) as place
              from (select * from norm_stores
                    union all select * replace (concat('A', city) as city) from norm_stores))
        where place = 1""",
    "dedup_sales": f"select {_DATED} from (select distinct * from norm_sales)",
    "dedup_sales_staged": f"select {_DATED} from (select distinct * from norm_sales)",
    "distinct_fetch": """
        select *, count(*) as copies
        from (select * from raw_stores union all select * from raw_stores) group by all""",
    # Labels and measures
    "season": f"select temperature, rain_mm, {SEASON} as season, count(*) as n from raw_sales group by all",
    "weekday_name": f"select weekday, {WEEKDAY} as weekday_name, count(*) as n from raw_sales group by all",
    "discount_band": f"select discount_pct, {BAND} as discount_band, count(*) as n from raw_sales group by all",
    "inventory_risk": f"""
        select stock_out_flag, stock_on_hand, units_sold, lead_time_days, {RISK} as inventory_risk, count(*) as n
        from raw_sales group by all""",
    "discount_amount": f"select gross_sales, net_sales, {DISCOUNT} as discount_amount from raw_sales",
    "total_cost": f"select purchase_cost, units_sold, {COST} as total_cost from raw_sales",
    "profit_amount": f"""
        select net_sales, purchase_cost, units_sold, {PROFIT} as profit_amount
        from (select *, {COST} as total_cost from raw_sales)""",
    "revenue_per_unit": f"select net_sales, units_sold, {PER_UNIT} as revenue_per_unit from raw_sales",
    # Sources and sinks, read back
    "json_scan": "select * from raw_sales",
    "json_scan_inferred": "select *, 'x' as note from raw_sales",
    "parquet_scan": "select * exclude (margin_pct), cast(null as double) as margin_pct from raw_sales",
    "catalog_read": "select *, 1 as extra from raw_products",
    "store_csv": "select * from raw_stores",
    "row_feed": "select *, count(*) as n from raw_sales group by all",
    "row_feed_line_breaks": """
        select cast(p_partkey as varchar) as number, p_brand as brand,
               case when p_partkey % 3 = 0 then 'say "' || p_name || '",' || chr(10) || 'then' || chr(10) || 'stop'
                    else p_name end as name
        from part""",
    "store_csv_line_breaks": """
        select * replace (
            case when cast(regexp_extract(store_id, '[0-9]+') as int) % 3 = 0
                 then 'say "' || city || '",' || chr(10) || 'then' || chr(10) || 'stop' else city end as city)
        from raw_stores""",
    "table_roundtrip": "select * from overview",
    "overview_incremental": "select * from overview",
    "partitioned_table": "select country, count(*) as n, count(distinct sku_id) as n_skus from overview group by all",
    "csv_parallel_roundtrip": "select * from overview",
    "preview_ordered": """
        select date, store_id, sku_id, year, month from raw_sales
        order by date, store_id, sku_id, year, month limit 5""",
    # Dimension loads
    "dimension_append": "select *, cast(2 as bigint) as n from (select distinct * from raw_stores)",
    "dimension_append_unseen": """
        select *, cast(1 as bigint) as n
        from (select * from raw_stores union select * replace (concat('A', city) as city) from raw_stores)""",
    "load_stores": "select distinct * from raw_stores",
    "load_products": "select sku_id, sku_name, category, subcategory, brand, list_price from raw_products",
    "warehouse_splits": f"""
        select split, count(*) as n_rows
        from (select coalesce((
                  select max(split) from (
                      select min(price) as low, cast(part as int) as split
                      from (select price, ntile(8) over (order by price) as part from {_PRICES} where price is not null)
                      group by part)
                  where low <= price), 0) as split
              from {_PRICES} prices)
        group by split""",
    "upper_to_lower_columns": "select sku_id, sku_name, category, subcategory, brand, list_price from raw_products",
    "nan_to_null": """
        select p_partkey, case when p_partkey % 7 = 0 then null else p_retailprice end as list_price from part""",
    "union_all": "select * from raw_products union all select * from raw_products",
    # Counts
    "row_counts": """
        select 'raw_products' as dataset, count(*) as n_rows from raw_products
        union all select 'raw_stores', count(*) from raw_stores
        union all select 'raw_sales', count(*) from raw_sales
        union all select 'clean_products', count(*) from clean_products
        union all select 'clean_stores', count(*) from clean_stores
        union all select 'clean_sales', count(*) from clean_sales
        union all select 'overview', count(*) from overview""",
    # Envelopes and landing
    "envelope_sizes": "select * from envelopes",
    "batch_key": "select printf('batch-%05d', batch_id) as key, batch_id, n_rows from envelopes",
    "envelope_explode": "select * from raw_sales",
    "envelope_edges": """
        select cast(case o_orderkey % 4 when 0 then o_orderkey when 1 then o_orderkey end as int) as batch_id,
               o_orderkey % 4 < 2 as usable, case when o_orderkey % 4 = 0 then 1 else 0 end as n_rows, count(*) as n
        from orders group by all""",
    "landed_rows": "select * from raw_sales",
    "landed_parquet_rows": "select * from raw_sales",
    "landed_batch_counts": "select * from envelopes",
    "landing_totals": """
        select count(*) as n_batches, cast(sum(n_rows) as bigint) as n_rows from envelopes""",
    "redelivered_rows": "select * replace (cast(promo_flag + 1 as int) as promo_flag) from raw_sales",
    "landing_gaps": """
        , sent as (select batch_id, case when batch_id % 5 = 0 then 1 else 2 end as n
                      from envelopes where (batch_id // 5) % 2 = 0),
             missing as (select i - row_number() over (order by i) as island, i
                         from (select unnest(range(1, (select max(batch_id) + 1 from sent))) as i)
                         where i not in (select batch_id from sent)),
             repeated as (select batch_id - row_number() over (order by batch_id) as island, batch_id as i
                          from sent where n = 2)
        select 'missing' as kind, min(i) as first, max(i) as last, cast(0 as bigint) as deliveries
        from missing group by island
        union all
        select 'repeated', cast(min(i) as bigint), cast(max(i) as bigint), cast(2 as bigint) from repeated group by island""",
    "resent_empty": """
        select batch_id, case when batch_id % 2 = 0 then 0 else n_rows end as n_rows,
               cast(case when batch_id % 2 = 0 then 0 else n_rows end as bigint) as n_lines
        from envelopes""",
    "quarantined_messages": """
        select concat('order-', cast(o_orderkey as varchar)) as key,
               case when o_orderkey % 3 = 1 then '{"rows": [{"sku_id": "a"}]}'
                    else '{"batch_id": ' || o_orderkey || ', "rows": "torn' end as value
        from orders where o_orderkey % 3 > 0""",
    "compacted_rows": "select * from raw_sales",
    "snapshot_rows": "select * from raw_sales",
    "batch_files": "select printf('batch_%05d', batch_id) as batch, cast(n_rows as bigint) as n_rows from envelopes",
    "staged_flow": "select * from overview",
}


def oracle_sql() -> dict[str, str]:
    """Self-contained statements: each carries the views it is built on."""
    views = ", ".join(f"{name} as ({sql.strip()})" for name, sql in _VIEWS.items())
    return {name: f"with {views} {sql.strip()}" for name, sql in _QUERIES.items()}
