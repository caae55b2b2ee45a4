"""DuckDB twins of the named queries, for checking only.

Written as one chain of common table expressions: raw tables from the test
tables, silver from raw, gold from silver. Each query takes the ones it needs.
"""

from __future__ import annotations

import re

_DAY_MICROS = "86400000000"


def _key(moment: str) -> str:
    return f"coalesce(cast(strftime({moment}, '%Y%m%d') as integer), -1)"


def _second(moment: str) -> str:
    return f"date_trunc('second', {moment})"


_ZIP = "lpad(cast({0} * 37 + 100 as varchar), 5, '0')"
_CITY = "'sao ' || lower(n_name)"
_STATE = "upper(substr(r_name, 1, 2))"

_CTES: dict[str, str] = {
    # ------------------------------------------------------------------- raw
    "raw_customers": """
        select c_custkey as customer_id, c_custkey - c_custkey % 3 as customer_unique_id,
               cast(c_nationkey * 37 + 100 as varchar) as customer_zip_code_prefix,
               case when copy = 1 then 'Repetida' else '  São ' || n_name || ' ' end as customer_city,
               ' ' || lower(substr(r_name, 1, 2)) as customer_state, copy
        from customer join nation on c_nationkey = n_nationkey
        join region on n_regionkey = r_regionkey
        join (values (0), (1)) v(copy) on copy = 0 or c_custkey % 10 = 0""",
    "raw_geolocation": """
        select cast(c_nationkey * 37 + 100 as varchar) as geolocation_zip_code_prefix,
               cast(c_custkey % 50 - 40 as double) as geolocation_lat,
               cast(-30 - c_custkey % 47 as double) as geolocation_lng,
               case when c_custkey % 4 = 0 then 'SÃO ' || c_mktsegment else lower(c_mktsegment) end
                   as geolocation_city,
               lower(substr(c_mktsegment, 1, 2)) as geolocation_state
        from customer where c_nationkey <> 24""",
    "raw_sellers": """
        select s_suppkey as seller_id, cast(s_nationkey * 37 + 100 as varchar) as seller_zip_code_prefix,
               '  São ' || n_name || ' ' as seller_city, ' ' || lower(substr(r_name, 1, 2)) as seller_state
        from supplier join nation on s_nationkey = n_nationkey
        join region on n_regionkey = r_regionkey""",
    "raw_orders": """
        select o_orderkey as order_id, o_custkey as customer_id,
               case o_orderstatus when 'F' then 'Delivered ' when 'O' then 'shipped'
                    when 'P' then 'processing' end as order_status,
               o_orderdate as order_purchase_timestamp,
               case when o_orderkey % 400 <> 0
                    then o_orderdate + to_hours(o_orderkey % 48) end as order_approved_at,
               o_orderkey % 500 = 0 as bad_carrier,
               case when o_orderkey % 500 <> 0 and o_orderstatus <> 'P'
                    then o_orderdate + to_days(cast(1 + o_orderkey % 5 as integer)) end
                    as order_delivered_carrier_date,
               case when o_orderstatus = 'F'
                    then o_orderdate + to_days(cast(o_orderkey % 40 as integer)) + to_hours(o_orderkey % 24)
                    end as order_delivered_customer_date,
               o_orderdate + to_days(20) + to_hours(12) as order_estimated_delivery_date
        from orders""",
    "raw_order_items": """
        select l_orderkey as order_id,
               (l_partkey * 100000000 + l_suppkey) * 10 + l_linenumber as order_item_id,
               l_partkey as product_id, l_suppkey as seller_id, l_shipdate as shipping_limit_date,
               l_extendedprice as price, l_extendedprice * l_tax as freight_value
        from lineitem""",
    "raw_order_payments": """
        select event_id - event_id % 7 as order_id,
               cast(event_id % 7 + 1 as integer) as payment_sequential,
               case user_id % 4 when 0 then 'Credit_Card ' when 1 then 'boleto'
                    when 2 then 'voucher' else 'debit_card' end as payment_type,
               cast(1 + user_id % 10 as integer) as payment_installments, value as payment_value
        from events where event_type = 'purchase'""",
    "raw_order_reviews": f"""
        select event_id - event_id % 2 as review_id, event_id - event_id % 3 as order_id,
               cast(1 + event_id % 7 % 5 as integer) as review_score,
               cast(null as varchar) as review_comment_title, props as review_comment_message,
               {_second('ts')} as review_creation_date,
               {_second('ts')} + to_hours(event_id % 72) as review_answer_timestamp
        from events where event_type in ('view', 'click')""",
    "raw_products": """
        select p_partkey as product_id,
               case when p_type <> 'SMALL' then lower(p_type) end as product_category_name,
               length(p_name) as product_name_lenght, p_size * 10 as product_description_lenght,
               p_size % 6 as product_photos_qty, p_size * 100 as product_weight_g,
               p_size + 1 as product_length_cm, p_size + 2 as product_height_cm,
               p_size + 3 as product_width_cm
        from part""",
    "raw_category_translation": """
        select distinct lower(p_type) as product_category_name,
               lower(p_type) || '_en' as product_category_name_english
        from part where p_type not in ('SMALL', 'MEDIUM')""",
    # ---------------------------------------------------------------- silver
    "silver_customers": f"""
        select customer_id, customer_unique_id, lpad(customer_zip_code_prefix, 5, '0') as customer_zip_code_prefix,
               trim(lower(strip_accents(customer_city))) as customer_city,
               trim(upper(customer_state)) as customer_state
        from raw_customers
        qualify row_number() over (partition by customer_id order by copy) = 1""",
    "geo_points": """
        select lpad(geolocation_zip_code_prefix, 5, '0') as zip, geolocation_lat as lat, geolocation_lng as lng,
               trim(lower(strip_accents(geolocation_city))) as city, trim(upper(geolocation_state)) as state
        from raw_geolocation
        where geolocation_lat between -34 and 6 and geolocation_lng between -74 and -32""",
    "geo_city": """
        select zip, city from geo_points group by zip, city
        qualify row_number() over (partition by zip order by count(*) desc, city) = 1""",
    "geo_state": """
        select zip, state from geo_points group by zip, state
        qualify row_number() over (partition by zip order by count(*) desc, state) = 1""",
    "silver_geolocation": """
        select zip as geolocation_zip_code_prefix, avg(lat) as geolocation_lat, avg(lng) as geolocation_lng,
               any_value(city_mode) as geolocation_city, any_value(state_mode) as geolocation_state
        from geo_points
        join (select zip, city as city_mode from geo_city) using (zip)
        join (select zip, state as state_mode from geo_state) using (zip)
        group by zip""",
    "silver_orders": f"""
        select order_id, customer_id, trim(lower(order_status)) as order_status,
               order_purchase_timestamp, order_approved_at, order_delivered_carrier_date,
               order_delivered_customer_date, order_estimated_delivery_date,
               coalesce(trim(lower(order_status)) = 'delivered', false) as is_delivered,
               cast(floor((epoch_us(order_delivered_customer_date) - epoch_us(order_estimated_delivery_date))
                    / {_DAY_MICROS}.0) as integer) as delivery_delay_days
        from raw_orders""",
    "silver_order_items": "select * from raw_order_items",
    "silver_order_payments": """
        select order_id, payment_sequential, trim(lower(payment_type)) as payment_type,
               payment_installments, payment_value
        from raw_order_payments""",
    "silver_order_reviews": "select * from raw_order_reviews",
    "silver_products": """
        select product_id, coalesce(p.product_category_name, 'unknown') as product_category_name,
               cast(product_name_lenght as double) as product_name_lenght,
               cast(product_description_lenght as double) as product_description_lenght,
               cast(product_photos_qty as double) as product_photos_qty,
               cast(product_weight_g as double) as product_weight_g,
               cast(product_length_cm as double) as product_length_cm,
               cast(product_height_cm as double) as product_height_cm,
               cast(product_width_cm as double) as product_width_cm,
               coalesce(t.product_category_name_english, p.product_category_name, 'unknown')
                   as product_category_name_english
        from raw_products p left join raw_category_translation t
          on coalesce(p.product_category_name, 'unknown') = t.product_category_name""",
    "silver_sellers": """
        select seller_id, lpad(seller_zip_code_prefix, 5, '0') as seller_zip_code_prefix,
               trim(lower(strip_accents(seller_city))) as seller_city,
               trim(upper(seller_state)) as seller_state
        from raw_sellers""",
    # ------------------------------------------------------------------ gold
    "all_days": """
        select cast(unnest([order_purchase_timestamp, order_approved_at, order_delivered_carrier_date,
               order_delivered_customer_date, order_estimated_delivery_date]) as date) as d from silver_orders
        union all select cast(shipping_limit_date as date) from silver_order_items
        union all select cast(unnest([review_creation_date, review_answer_timestamp]) as date)
        from silver_order_reviews""",
    "spine": """
        select cast(unnest(generate_series(min(d)::timestamp, max(d)::timestamp, interval 1 day)) as date)
               as full_date from all_days""",
    "dim_date": """
        select cast(strftime(full_date, '%Y%m%d') as integer) as date_key, full_date,
               cast(day(full_date) as integer) as day, dayname(full_date) as day_name,
               cast(dayofweek(full_date) as integer) as day_of_week,
               cast(dayofyear(full_date) as integer) as day_of_year,
               cast(week(full_date) as integer) as week_of_year,
               cast(month(full_date) as integer) as month, monthname(full_date) as month_name,
               cast(quarter(full_date) as integer) as quarter, cast(year(full_date) as integer) as year,
               dayofweek(full_date) in (0, 6) as is_weekend
        from spine
        union all
        select -1, null, null, 'Unknown', null, null, null, null, 'Unknown', null, null, null""",
    "address": """
        select customer_unique_id, customer_city, customer_state, customer_zip_code_prefix
        from (select customer_unique_id, customer_city, customer_state, customer_zip_code_prefix,
                     count(*) as frequency, max(customer_id) as last_id
              from silver_customers group by all)
        qualify row_number() over (partition by customer_unique_id order by frequency desc, last_id desc) = 1""",
    "dim_customers": """
        select row_number() over (order by customer_unique_id) as customer_key, customer_unique_id,
               customer_city, customer_state, customer_zip_code_prefix,
               geolocation_lat as latitude, geolocation_lng as longitude
        from address left join silver_geolocation on customer_zip_code_prefix = geolocation_zip_code_prefix""",
    "staging_products": """
        select product_id, product_category_name, product_category_name_english,
               product_name_lenght as product_name_length,
               product_description_lenght as product_description_length,
               product_photos_qty, product_weight_g, product_length_cm, product_height_cm, product_width_cm
        from silver_products""",
    "dim_products": """
        select row_number() over (order by product_id) as product_key, * from staging_products""",
    "dim_sellers": """
        select row_number() over (order by seller_id) as seller_key, seller_id, seller_city, seller_state,
               seller_zip_code_prefix, geolocation_lat as latitude, geolocation_lng as longitude
        from silver_sellers left join silver_geolocation
          on seller_zip_code_prefix = geolocation_zip_code_prefix""",
    "bridge": """
        select customer_id, customer_key from silver_customers left join dim_customers using (customer_unique_id)""",
    "fact_order_items": f"""
        select i.order_id, order_item_id, product_key, seller_key, customer_key,
               {_key('order_purchase_timestamp')} as purchase_date_key,
               {_key('shipping_limit_date')} as shipping_limit_date_key, price, freight_value
        from silver_order_items i join silver_orders o on i.order_id = o.order_id
        left join dim_products p on i.product_id = p.product_id
        left join dim_sellers s on i.seller_id = s.seller_id
        left join bridge b on o.customer_id = b.customer_id""",
    "paid": """
        select order_id, sum(payment_value) as total_payment_value,
               count(distinct payment_sequential) as payment_method_count
        from silver_order_payments group by order_id""",
    "reviewed": """
        select order_id, cast(avg(review_score) as decimal(3,2)) as avg_review_score, count(*) as review_count
        from silver_order_reviews group by order_id""",
    "fact_orders": f"""
        select o.order_id, customer_key,
               {_key('order_purchase_timestamp')} as purchase_date_key,
               {_key('order_approved_at')} as approval_date_key,
               {_key('order_delivered_carrier_date')} as carrier_date_key,
               {_key('order_delivered_customer_date')} as delivery_date_key,
               {_key('order_estimated_delivery_date')} as estimated_delivery_date_key,
               order_status, delivery_delay_days,
               coalesce(total_payment_value, 0.0) as total_payment_value,
               coalesce(payment_method_count, 0) as payment_method_count, avg_review_score,
               coalesce(review_count, 0) as review_count
        from silver_orders o left join bridge b on o.customer_id = b.customer_id
        left join paid on o.order_id = paid.order_id
        left join reviewed on o.order_id = reviewed.order_id""",
    "fact_payments": "select * from silver_order_payments",
    "fact_reviews": f"""
        select review_id, order_id, {_key('review_creation_date')} as review_creation_date_key,
               {_key('review_answer_timestamp')} as review_answer_date_key, review_score
        from silver_order_reviews""",
}


def _query(body: str, ctes: dict[str, str] = _CTES) -> str:
    """Prefix the body with the expressions it mentions, directly or not."""
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name in ctes:
            if name not in needed and re.search(rf"\b{name}\b", sql):
                needed.add(name)
                visit(ctes[name])

    visit(body)
    chain = [f"{name} as ({sql})" for name, sql in ctes.items() if name in needed]
    return ("with " + ",\n".join(chain) + "\n" if chain else "") + body


def _round(source: str, *doubles: str) -> str:
    fixes = ", ".join(f"round({c}, 4) as {c}" for c in doubles)
    return f"select * {f'replace ({fixes}) ' if fixes else ''}from {source}"


# ------------------------------------------------------------------- checks

_STATUSES = (
    "('delivered', 'shipped', 'canceled', 'invoiced', 'processing', 'created', 'approved', 'unavailable')"
)


def _row_rule(label: str, rule: str, table: str, column: str, holds: str, mostly: str = "1.0") -> str:
    applies = "true" if rule == "not_null" else f"{column} is not null"
    return f"""
        select '{label}' as suite, '{rule}' as rule, '{column}' as "column",
               count(*) filter ({applies}) as checked,
               count(*) filter ({applies} and not ({holds})) as unexpected,
               count(*) filter ({applies} and not ({holds})) as failures, {mostly} as mostly
        from {table}"""


def _not_null(label: str, table: str, column: str, mostly: str = "1.0") -> str:
    return _row_rule(label, "not_null", table, column, f"{column} is not null", mostly)


def _unique(label: str, table: str, *columns: str) -> str:
    names = ", ".join(columns)
    some = " or ".join(f"{c} is not null" for c in columns)
    rule = "unique" if len(columns) == 1 else "compound_unique"
    return f"""
        select '{label}' as suite, '{rule}' as rule, '{",".join(columns)}' as "column",
               cast(coalesce(sum(n), 0) as bigint) as checked,
               cast(coalesce(sum(n) filter (n > 1), 0) as bigint) as unexpected,
               count(*) filter (n > 1) as failures, 1.0 as mostly
        from (select count(*) as n from {table} where {some} group by {names})"""


def _related(label: str, child: str, column: str, parent: str, parent_column: str) -> str:
    return f"""
        select '{label}' as suite, 'relationships' as rule, '{column}' as "column",
               count({column}) as checked, count(*) filter (bad) as unexpected,
               count(*) filter (bad) as failures, 1.0 as mostly
        from (select {column}, {column} is not null
                     and {column} not in (select {parent_column} from {parent}) as bad from {child})"""


def _accepted(label: str, table: str, column: str) -> str:
    bad = f"{column} is not null and {column} not in {_STATUSES}"
    return f"""
        select '{label}' as suite, 'accepted_values' as rule, '{column}' as "column",
               count({column}) as checked, count(*) filter ({bad}) as unexpected,
               count(distinct {column}) filter ({bad}) as failures, 1.0 as mostly
        from {table}"""


_RAW_RULES = "\nunion all\n".join([
    _not_null("customers", "raw_customers", "customer_id"),
    _unique("customers", "raw_customers", "customer_id"),
    _not_null("customers", "raw_customers", "customer_unique_id"),
    _not_null("customers", "raw_customers", "customer_state"),
    _row_rule("customers", "length_equals", "raw_customers", "customer_state", "length(customer_state) = 2"),
    _not_null("orders", "raw_orders", "order_id"),
    _unique("orders", "raw_orders", "order_id"),
    _not_null("orders", "raw_orders", "order_purchase_timestamp"),
    _row_rule("orders", "in_set", "raw_orders", "order_status", f"order_status in {_STATUSES}"),
    _not_null("orders", "raw_orders", "order_approved_at", "0.997"),
    _not_null("order_items", "raw_order_items", "order_id"),
    _not_null("order_items", "raw_order_items", "product_id"),
    _row_rule("order_items", "between", "raw_order_items", "price", "price >= 0"),
    _row_rule("order_items", "between", "raw_order_items", "freight_value", "freight_value >= 0"),
    _unique("order_items", "raw_order_items", "order_id", "order_item_id"),
    _not_null("order_reviews", "raw_order_reviews", "review_id"),
    _not_null("order_reviews", "raw_order_reviews", "order_id"),
    _row_rule("order_reviews", "between", "raw_order_reviews", "review_score", "review_score between 1 and 5"),
    _unique("order_reviews", "raw_order_reviews", "review_id", "order_id"),
])

_JUDGED = (
    'select suite, rule, "column", checked, unexpected, failures, '
    "case when checked = 0 then 0.0 else round(unexpected * 100.0 / checked, 4) end as unexpected_pct, "
    "case when checked = 0 then true else (checked - unexpected)::double / checked >= mostly::double end as success "
)

_MODEL_RULES = "\nunion all\n".join([
    _sql
    for model, column in [
        ("dim_date", "date_key"),
        ("dim_customers", "customer_key"), ("dim_customers", "customer_unique_id"),
        ("dim_products", "product_key"), ("dim_products", "product_id"),
        ("dim_sellers", "seller_key"), ("dim_sellers", "seller_id"),
        ("fact_orders", "order_id"),
    ]
    for _sql in (_unique(model, model, column), _not_null(model, model, column))
] + [
    _not_null("fact_order_items", "fact_order_items", "order_id"),
    _related("fact_order_items", "fact_order_items", "product_key", "dim_products", "product_key"),
    _related("fact_order_items", "fact_order_items", "seller_key", "dim_sellers", "seller_key"),
    _row_rule("fact_order_items", "between", "fact_order_items", "price", "price >= 0"),
    _unique("fact_order_items", "fact_order_items", "order_id", "order_item_id"),
    _accepted("fact_orders", "fact_orders", "order_status"),
    _row_rule("fact_payments", "between", "fact_payments", "payment_value", "payment_value >= 0"),
    _row_rule("fact_reviews", "between", "fact_reviews", "review_score", "review_score between 1 and 5"),
    _unique("fact_reviews", "fact_reviews", "review_id", "order_id"),
])

_COVERAGE_RULES = "\nunion all\n".join(
    _related(fact, fact, column, "dim_date", "date_key")
    for fact, columns in {
        "fact_order_items": ("purchase_date_key", "shipping_limit_date_key"),
        "fact_orders": ("purchase_date_key", "approval_date_key", "carrier_date_key",
                        "delivery_date_key", "estimated_delivery_date_key"),
        "fact_reviews": ("review_creation_date_key", "review_answer_date_key"),
    }.items()
    for column in columns
)

_MODEL_OUTPUT = 'select suite as model, rule as test, "column", failures, success'


# ---------------------------------------------------------------- profiling

_TYPES = {
    "customers": ("customer_id:bigint", "customer_unique_id:bigint", "customer_zip_code_prefix:string",
                  "customer_city:string", "customer_state:string"),
    "geolocation": ("geolocation_zip_code_prefix:string", "geolocation_lat:double", "geolocation_lng:double",
                    "geolocation_city:string", "geolocation_state:string"),
    "orders": ("order_id:bigint", "customer_id:bigint", "order_status:string",
               "order_purchase_timestamp:string", "order_approved_at:string",
               "order_delivered_carrier_date:string", "order_delivered_customer_date:string",
               "order_estimated_delivery_date:string"),
    "order_items": ("order_id:bigint", "order_item_id:bigint", "product_id:bigint", "seller_id:bigint",
                    "shipping_limit_date:string", "price:double", "freight_value:double"),
    "order_payments": ("order_id:bigint", "payment_sequential:int", "payment_type:string",
                       "payment_installments:string", "payment_value:double"),
    "order_reviews": ("review_id:bigint", "order_id:bigint", "review_score:string",
                      "review_comment_title:string", "review_comment_message:string",
                      "review_creation_date:string", "review_answer_timestamp:string"),
    "products": ("product_id:bigint", "product_category_name:string", "product_name_lenght:int",
                 "product_description_lenght:int", "product_photos_qty:int", "product_weight_g:int",
                 "product_length_cm:int", "product_height_cm:int", "product_width_cm:int"),
    "sellers": ("seller_id:bigint", "seller_zip_code_prefix:string", "seller_city:string",
                "seller_state:string"),
    "category_translation": ("product_category_name:string", "product_category_name_english:string"),
}


def _profiled(table: str, name: str, kind: str, width: int) -> str:
    value = name
    if name == "order_delivered_carrier_date":
        value = f"case when bad_carrier then 'unreadable' else cast({name} as varchar) end"
    return f"""
        select '{table}' as "table", '{name}' as "column", '{kind}' as type, {width} as columns,
               count(*) as rows, count(*) - count({value}) as nulls,
               count(distinct {value}) as distinct_values
        from raw_{table}"""


_PROFILE = "\nunion all\n".join(
    _profiled(table, *column.split(":"), len(columns))
    for table, columns in _TYPES.items()
    for column in columns
)


def _difference(pair: str, left: str, left_key: str, right: str, right_key: str) -> str:
    a, b = f"select {left_key} from {left}", f"select {right_key} from {right}"
    return f"""
        select '{pair}' as pair,
               (select count(*) from ({a} except {b})) as only_left,
               (select count(*) from ({b} except {a})) as only_right"""


_PAIRS = "\nunion all\n".join(
    _difference(f"{a}.{x}-{b}.{y}", f"raw_{a}", x, f"raw_{b}", y)
    for a, x, b, y in [
        ("orders", "order_id", "order_items", "order_id"),
        ("orders", "order_id", "order_payments", "order_id"),
        ("sellers", "seller_id", "order_items", "seller_id"),
        ("order_items", "product_id", "products", "product_id"),
        ("orders", "order_id", "order_reviews", "order_id"),
        ("customers", "customer_id", "orders", "customer_id"),
        ("products", "product_category_name", "category_translation", "product_category_name"),
    ]
)

_ZIPS = "\nunion all\n".join(
    f"""
        select '{table}' as pair, count(*) as missing_zips
        from (select lpad({column}, 5, '0') from raw_{table}
              except select geolocation_zip_code_prefix from silver_geolocation)"""
    for table, column in [
        ("customers", "customer_zip_code_prefix"), ("sellers", "seller_zip_code_prefix"),
    ]
)


def _any_duplicate(table: str, *columns: str) -> str:
    names = ", ".join(columns)
    return f"""
        select '{table}' as "table", '{",".join(columns)}' as columns,
               exists (select 1 from raw_{table} group by {names} having count(*) > 1) as has_duplicates"""


# ----------------------------------------------------------------- business

_DELIVERED = (
    "(select * from fact_orders where order_status = 'delivered' and delivery_delay_days is not null)"
)
_RATES = """
    count(*) as delivered_orders, count(*) filter (delivery_delay_days > 0) as late_orders,
    count(*) filter (delivery_delay_days <= 0) as on_time_orders,
    round(count(*) filter (delivery_delay_days > 0) / count(*), 4) as late_rate"""
_SCORED = (
    "(select delivery_delay_days as delay, avg_review_score::double as score from fact_orders "
    "where delivery_delay_days is not null and avg_review_score is not null)"
)


def _date_of(key: str) -> str:
    return f"case when {key} > 0 then strptime({key}::varchar, '%Y%m%d')::date end"


_ORDER_TEXT = """order_status,
        strftime(order_purchase_timestamp, '%Y-%m-%d %H:%M:%S') as order_purchase_timestamp,
        strftime(order_approved_at, '%Y-%m-%d %H:%M:%S') as order_approved_at,
        case when bad_carrier then 'unreadable'
             else strftime(order_delivered_carrier_date, '%Y-%m-%d %H:%M:%S') end as order_delivered_carrier_date,
        strftime(order_delivered_customer_date, '%Y-%m-%d %H:%M:%S') as order_delivered_customer_date,
        strftime(order_estimated_delivery_date, '%Y-%m-%d %H:%M:%S') as order_estimated_delivery_date"""

_LAYERS = {
    "silver": ("customers", "geolocation", "orders", "order_items", "order_payments", "order_reviews",
               "products", "sellers"),
    "gold": ("dim_date", "dim_customers", "dim_products", "dim_sellers", "fact_order_items", "fact_orders",
             "fact_payments", "fact_reviews"),
}

_BODIES: dict[str, str] = {
    "silver_customers": _round("silver_customers"),
    "silver_geolocation": _round("silver_geolocation", "geolocation_lat", "geolocation_lng"),
    "silver_orders": _round("silver_orders"),
    "silver_order_items": _round("silver_order_items", "price", "freight_value"),
    "silver_order_payments": _round("silver_order_payments", "payment_value"),
    "silver_order_reviews": _round("silver_order_reviews"),
    "silver_products": _round("silver_products"),
    "silver_sellers": _round("silver_sellers"),
    "staging_products_rename": "select * from staging_products",
    "staging_orders_cast": "select * exclude (is_delivered) from silver_orders",
    "dim_date": "select * from dim_date",
    "dim_date_fixed": """
        select strftime(day, '%Y%m%d')::integer as date_key, day::date as full_date, count(o.order_id) as orders_placed
        from generate_series(timestamp '2016-01-01', timestamp '2019-04-14', interval 1 day) as t(day)
        left join raw_orders o on o.order_purchase_timestamp::date = day::date
        group by day
        union all
        select -1, null, (select count(*) from raw_orders where order_purchase_timestamp is null
            or order_purchase_timestamp::date not between date '2016-01-01' and date '2019-04-14')""",
    "dim_customers": _round("dim_customers", "latitude", "longitude"),
    "dim_products": "select * from dim_products",
    "dim_sellers": _round("dim_sellers", "latitude", "longitude"),
    "fact_order_items": _round("fact_order_items", "price", "freight_value"),
    "fact_orders": _round("fact_orders", "total_payment_value"),
    "fact_payments": _round("fact_payments", "payment_value"),
    "fact_reviews": "select * from fact_reviews",
    "dq_raw_suites": f"select * exclude (failures) from ({_JUDGED} from ({_RAW_RULES}))",
    "dq_gate_status": f"""
        select suite, count(*) as rules, count(*) filter (not success) as failed_rules,
               case when bool_and(success) then 'PASS' else 'FAIL' end as status
        from ({_JUDGED} from ({_RAW_RULES})) group by suite""",
    "dq_gold_tests": f"{_MODEL_OUTPUT} from ({_JUDGED} from ({_MODEL_RULES}))",
    "dq_calendar_coverage": f"{_MODEL_OUTPUT} from ({_JUDGED} from ({_COVERAGE_RULES}))",
    "dq_grain_violations_raw": """
        select l_orderkey, l_linenumber, count(*) as copies from lineitem
        group by l_orderkey, l_linenumber having count(*) > 1""",
    "profile_nulls_distinct": _PROFILE,
    "profile_preview": f"select order_id, customer_id, {_ORDER_TEXT} from raw_orders order by order_id limit 10",
    "profile_duplicates": "\nunion all\n".join([
        _any_duplicate("geolocation", "geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"),
        _any_duplicate("order_items", "order_id", "order_item_id"),
        _any_duplicate("order_payments", "order_id", "payment_sequential"),
        _any_duplicate("order_reviews", "order_id", "review_id"),
    ]),
    "profile_duplicate_rows_top20": """
        select review_id, order_id, review_score::varchar as review_score from raw_order_reviews
        where review_id in (select review_id from raw_order_reviews group by 1 having count(*) > 1)
        order by review_id, order_id limit 20""",
    "profile_duplicate_rows": """
        select review_id, order_id, review_score::varchar as review_score from raw_order_reviews
        where review_id in (select review_id from raw_order_reviews group by 1 having count(*) > 1)""",
    "profile_referential_integrity": _PAIRS,
    "profile_missing_category": """
        select product_category_name, count(*) as rows from raw_products
        where product_category_name is null
           or product_category_name not in (select product_category_name from raw_category_translation)
        group by product_category_name""",
    "profile_zip_coverage": _ZIPS,
    "late_rate_by_region": f"""
        select customer_state, {_RATES} from {_DELIVERED} left join dim_customers using (customer_key)
        group by customer_state""",
    "late_rate_by_seller": f"""
        select seller_key, seller_id, {_RATES}
        from (select distinct order_id, seller_key from fact_order_items)
        join {_DELIVERED} using (order_id) left join dim_sellers using (seller_key)
        group by seller_key, seller_id""",
    "sales_trend": """
        select d.year, d.month, product_category_name_english as category, customer_state,
               round(sum(price), 4) as revenue, count(distinct order_id) as order_count, count(*) as item_count
        from fact_order_items left join dim_date d on purchase_date_key = d.date_key
        left join dim_products using (product_key) left join dim_customers using (customer_key)
        group by all""",
    "review_vs_delay_corr": f"""
        select count(*) as orders, round(corr(delay::double, score), 6) as correlation from {_SCORED}""",
    "review_by_delay_bucket": f"""
        select case when delay <= -7 then '1: 7+ days early' when delay <= 0 then '2: on time'
                    when delay <= 3 then '3: 1-3 days late' when delay <= 7 then '4: 4-7 days late'
                    else '5: 8+ days late' end as delay_bucket,
               count(*) as orders, round(avg(score), 4) as mean_score
        from {_SCORED} group by 1""",
    "seller_performance": f"""
        select seller_key, seller_id, seller_state, round(sum(price), 4) as revenue,
               cast(sum(items) as bigint) as item_count, count(*) as order_count,
               round(avg(days), 4) as mean_delivery_days
        from (select order_id, seller_key, sum(price) as price, count(*) as items
              from fact_order_items group by all)
        left join (select order_id,
                          {_date_of('delivery_date_key')} - {_date_of('purchase_date_key')} as days
                   from fact_orders) using (order_id)
        left join dim_sellers using (seller_key)
        group by seller_key, seller_id, seller_state""",
    "payment_mix": """
        select payment_type, count(*) as payments, round(sum(payment_value), 4) as total_value,
               round(count(*) / sum(count(*)) over (), 4) as payment_share,
               round(sum(payment_value) / sum(sum(payment_value)) over (), 4) as value_share
        from fact_payments group by payment_type""",
    "installment_trend": """
        select year, month, count(*) as payments, round(avg(payment_installments), 4) as mean_installments
        from fact_payments join fact_orders using (order_id)
        left join dim_date on purchase_date_key = date_key group by year, month""",
    "avg_order_value": """
        select count(*) as paid_orders, round(sum(total_payment_value), 4) as total_value,
               round(sum(total_payment_value) / count(*), 4) as avg_order_value
        from fact_orders where payment_method_count > 0""",
    "bronze_roundtrip": f"""
        select '2024-01-01' as load, order_id::varchar as order_id, customer_id::varchar as customer_id,
               {_ORDER_TEXT.replace("order_status", "'created' as order_status", 1)}
        from raw_orders
        union all
        select '2024-02-01', order_id::varchar, customer_id::varchar, {_ORDER_TEXT} from raw_orders""",
    "bronze_manifest": "\nunion all\n".join(
        f"""select '{table}' as table_name, '2024-01-01' as ingestion_date, count(*) as row_count,
                   true as all_files, true as all_bytes from raw_{table}"""
        for table in _TYPES
    ),
    "bronze_timestamp_forms": """
        select order_id::varchar as order_id,
               case when order_id % 10 <> 3 then date_trunc('second', order_purchase_timestamp) end as order_purchase_timestamp,
               date_trunc('second', order_approved_at) as order_approved_at,
               date_trunc('day', order_delivered_carrier_date)::timestamp as order_delivered_carrier_date,
               date_trunc('minute', order_delivered_customer_date) as order_delivered_customer_date,
               date_trunc('second', order_estimated_delivery_date) as order_estimated_delivery_date
        from raw_orders""",
    "pipeline_catalog": """
        select o.order_status, count(distinct o.order_id) as orders, count(i.order_id) as items, round(sum(i.price), 4) as revenue
        from silver_orders o left join silver_order_items i on o.order_id = i.order_id group by o.order_status""",
    "pipeline_report": "\nunion all\n".join(
        f"""select '{layer}' as layer, '{table}' as "table", count(*) as rows_reported,
                   count(*) as rows_stored from {"silver_" if layer == "silver" else ""}{table}"""
        for layer, tables in _LAYERS.items()
        for table in tables
    ),
}


# ------------------------------------------------------- two runs and their report

# The raw tables of the second run: what the gate refused, mended.
_MENDED = {
    "raw_customers": "select * replace (trim(customer_state) as customer_state) from fed_customers where copy = 0",
    "raw_orders": "select * replace (trim(lower(order_status)) as order_status) from fed_orders",
    "raw_order_items": """
        select order_id, order_item_id, min(product_id) as product_id, min(seller_id) as seller_id,
               min(shipping_limit_date) as shipping_limit_date, min(price) as price, min(freight_value) as freight_value
        from fed_order_items group by order_id, order_item_id""",
    "raw_order_reviews": """
        select review_id, order_id, min(review_score) as review_score, min(review_comment_title) as review_comment_title,
               min(review_comment_message) as review_comment_message, min(review_creation_date) as review_creation_date,
               min(review_answer_timestamp) as review_answer_timestamp
        from fed_order_reviews group by review_id, order_id""",
}
_FED = {name.replace("raw_", "fed_"): _CTES[name] for name in _MENDED}

# How cleaning turns a raw text column into the stored one.
_CLEANED = {
    **{
        f"{table}.{prefix}_{part}": rule.format(f"{prefix}_{column}")
        for table, prefix in (("customers", "customer"), ("geolocation", "geolocation"), ("sellers", "seller"))
        for part, column, rule in (
            ("zip_code_prefix", "zip_code_prefix", "lpad({0}, 5, '0')"),
            ("city", "city", "trim(lower(strip_accents({0})))"), ("state", "state", "trim(upper({0}))"),
        )
    },
    "orders.order_status": "trim(lower(order_status))",
    "order_payments.payment_type": "trim(lower(payment_type))",
    "products.product_category_name": "coalesce(product_category_name, 'unknown')",
}

_STORED = {
    "orders": ("is_delivered", "delivery_delay_days"), "products": ("product_category_name_english",),
}


def _line(step: str, subject: str, metric: str, value: str, source: str) -> str:
    return f"""select '{step}' as step, '{subject}' as subject, '{metric}' as metric, cast({value} as bigint) as value from {source}"""


def _ruled(step: str, rules: str) -> str:
    judged = f"({_JUDGED} from ({rules}))"
    subject = """suite || '.' || "column" || ':' || rule"""
    return f"""
        select '{step}' as step, {subject} as subject, 'failures' as metric, cast(failures as bigint) as value from {judged}
        union all select '{step}', {subject}, 'success', cast(success as bigint) from {judged}"""


def _landed(day: str) -> list[str]:
    return [
        _line("bronze", table, metric, value, f"raw_{table}")
        for table in _TYPES for metric, value in (("rows", "count(*)"), ("load_date", f"max({day})"))
    ]


def _silver_lines(table: str) -> list[str]:
    columns = [c.partition(":")[0] for c in _TYPES[table]]
    raw, stored = f"raw_{table}", f"silver_{table}"
    lines = [_line("silver", table, "rows_in", "count(*)", raw), _line("silver", table, "rows", "count(*)", stored)]
    for c in columns:
        missing = f"{c} is null and not bad_carrier" if c == "order_delivered_carrier_date" else f"{c} is null"
        lines.append(_line("silver", table, f"nulls_in.{c}", f"count(*) filter ({missing})", raw))
        if f"{table}.{c}" in _CLEANED:
            changed = f"count(*) filter ({c} is distinct from {_CLEANED[f'{table}.{c}']})"
            lines.append(_line("silver", table, f"changed.{c}", changed, raw))
    lines += [_line("silver", table, f"nulls.{c}", f"count(*) filter ({c} is null)", stored) for c in (*columns, *_STORED.get(table, ()))]
    match table:
        case "customers":
            lines.append(_line("silver", table, "duplicates_dropped", f"(select count(*) from {raw}) - count(*)", stored))
        case "geolocation":
            inside = "geolocation_lat between -34 and 6 and geolocation_lng between -74 and -32"
            lines.append(_line("silver", table, "out_of_range", f"count(*) filter (not coalesce({inside}, false))", raw))
        case "orders":
            lines.append(_line("silver", table, "unparsed", "count(*) filter (bad_carrier)", raw))
        case "order_items" | "order_reviews":
            lines.append(_line("silver", table, "unparsed", "0 * count(*)", raw))
        case "products":
            lines.append(_line("silver", table, "category_filled", "count(*) filter (product_category_name is null)", raw))
            known = "product_category_name in (select product_category_name from raw_category_translation)"
            lines.append(_line("silver", table, "untranslated", f"count(*) filter (not {known})", stored))
    return lines


def _two_runs() -> str:
    """The report of both runs; the first is spelled out in a query of its own, over the tables as they are."""
    stopped = "\nunion all\n".join([*_landed("20240101"), _ruled("gate", _RAW_RULES)])
    whole = "\nunion all\n".join([
        *_landed("20240102"), _ruled("gate", _RAW_RULES),
        *[line for table in _LAYERS["silver"] for line in _silver_lines(table)],
        *[_line("gold", table, "rows", "count(*)", table) for table in _LAYERS["gold"]],
        _ruled("tests", _MODEL_RULES), _ruled("calendar", _COVERAGE_RULES),
    ])
    mended = {**_FED, **_CTES, **_MENDED}
    return f"""
        select '2024-01-01' as run, * from ({_query(stopped)})
        union all select '2024-01-02' as run, * from ({_query(whole, mended)})"""


ORACLE_SQL: dict[str, str] = {name: _query(body) for name, body in _BODIES.items()} | {"pipeline_run": _two_runs()}
