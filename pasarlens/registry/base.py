"""What a registered query is, and the SQL forms of the logical tables for the checks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def rnd(x: str, digits: int) -> str:
    """Half-up rounding of the decimal text of a double, as Spark's round does."""
    return f"cast(round(cast(cast({x} as varchar) as decimal(38,15)), {digits}) as double)"


def money(x: str) -> str:
    return f"round(cast(cast({x} as varchar) as decimal(38,15)), 4)"


def title(x: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower({x}), ' '), "
        "lambda w: upper(w[1]) || w[2:]), ' ')"
    )


K = "cast(json_extract_string(props, '$.k') as int)"

UI = f"""user_interactions as (
  select event_id as interaction_id, user_id, cast({K} as bigint) as product_id, event_type as interaction_type,
         cast(null as int) as implicit_score, ts as "timestamp",
         cast(user_id as varchar) || '-' || cast(cast(ts as date) as varchar) as session_id
  from events)"""

SCORE = """cast(case when interaction_type in ('view', 'search') then 1
  when interaction_type in ('like', 'share') then 3 when interaction_type = 'add_to_cart' then 4
  when interaction_type in ('checkout', 'review') then 5 when interaction_type = 'purchase' then 7 end as int)"""

TH = """transaction_history as (
  select l_orderkey * 10 + l_linenumber as transaction_id, o_custkey as user_id,
         l_partkey as product_id, l_suppkey as supplier_id,
         o_orderdate + to_hours(cast(l_partkey % 24 as int)) as "timestamp",
         cast(floor(l_quantity) as int) as quantity,
         l_extendedprice / l_quantity as unit_price_idr,
         l_extendedprice * l_discount as discount_amt_idr,
         l_extendedprice * l_tax as shipping_fee_idr,
         l_extendedprice as subtotal_idr,
         l_extendedprice * (1 - l_discount) * (1 + l_tax) as total_idr,
         case when l_linestatus = 'F' then 'paid' else 'pending' end as payment_status,
         l_returnflag as payment_method, o_orderpriority as platform,
         cast(date_diff('day', cast(o_orderdate as date), cast(l_shipdate as date)) as int) as delivery_days,
         cast(l_returnflag = 'R' and l_discount >= 0.09::double as int) as is_fraud
  from lineitem join orders on l_orderkey = o_orderkey)"""

TH_CLEAN = f"""{TH},
th as (
  select * from (
    select * from transaction_history
    qualify row_number() over (partition by transaction_id order by product_id, supplier_id, subtotal_idr) = 1)
  where user_id is not null and product_id is not null and total_idr is not null and total_idr > 0)"""

UP = f"""spending as (
  select o_custkey as buyer, cast(sum({money('o_totalprice')}) as double) as total_spend_idr,
         cast(count(*) as int) as total_orders, min(o_orderdate) as first_order, max(o_orderdate) as last_order
  from orders group by o_custkey),
user_profiles as (
  select c_custkey as user_id, cast(18 + c_custkey % 50 as int) as age,
         case when c_custkey % 2 = 0 then ' f ' else 'M' end as gender, lower(n_name) as city,
         c_mktsegment as user_segment, total_spend_idr,
         total_spend_idr / total_orders as avg_order_value_idr, total_orders,
         cast(total_orders * (1 + c_custkey % 3) as int) as total_items_purchased,
         cast(date_diff('day', cast(first_order as date), date '2001-08-02') as int) as tenure_days,
         cast(date_diff('day', cast(last_order as date), date '2001-08-02') as int) as days_since_last_purchase,
         greatest(0.0::double, least(100.0::double, c_acctbal / 100)) as loyalty_score,
         (c_custkey % 101) / 100 as email_open_rate,
         cast(c_custkey % 4 as int) as referral_count, cast(c_custkey % 2 as int) as push_notif_enabled,
         cast(c_custkey % 5 = 0 as int) as is_premium_member,
         (60 + c_custkey % 600)::double as avg_session_duration_sec,
         (1 + c_custkey % 12)::double as avg_pages_per_session,
         'device' || (c_custkey % 3) as preferred_device, 'channel' || (c_custkey % 4) as acquisition_channel,
         cast(date_diff('day', cast(last_order as date), date '2001-08-02')
           + 240.0::double * ((c_custkey * 7919 % 1000) / 1000.0::double) > 300.0::double as int) as is_churned,
         total_spend_idr * (0.6::double + 0.8::double * ((c_custkey * 7919 % 1000) / 1000.0::double)) as ltv_idr
  from customer left join nation on c_nationkey = n_nationkey left join spending on c_custkey = buyer)"""

UP_CLEAN = f"""{UP},
up as (
  select * replace (coalesce(loyalty_score, 50.0::double) as loyalty_score,
                    coalesce(total_spend_idr, 0.0::double) as total_spend_idr,
                    coalesce(avg_order_value_idr, 0.0::double) as avg_order_value_idr,
                    coalesce(days_since_last_purchase, 365) as days_since_last_purchase,
                    coalesce(email_open_rate, 0.0::double) as email_open_rate,
                    coalesce(referral_count, 0) as referral_count,
                    upper(trim(gender)) as gender, {title('trim(city)')} as city)
  from user_profiles where user_id is not null and age is not null)"""

PC = """sales as (
  select l_partkey as sold, count(*) as n_sold, sum(cast(round(l_discount * 100) as int)) as percent_sum
  from lineitem group by l_partkey),
catalog_base as (
  select *, coalesce(6.0::double * percent_sum::double / n_sold, 0.0::double) as discount_pct,
         coalesce(n_sold, 0) as n from part left join sales on p_partkey = sold),
product_catalog as (
  select p_partkey as product_id, p_name as product_name, p_type as category,
         'sub' || (p_size % 10) as subcategory, p_brand as brand, p_retailprice as base_price_idr,
         discount_pct, p_retailprice * (1 - discount_pct / 100) as final_price_idr,
         (1 + p_size % 5)::double as avg_rating, p_size::bigint as review_count,
         cast(p_partkey % 40 as int) as stock_quantity, n as sales_last_30d,
         10 * n + p_size as views_last_30d, cast(p_partkey % 365 as int) as days_since_listed,
         cast(100 + p_partkey % 900 as int) as weight_gram, cast(p_partkey % 7 = 0 as int) as is_digital,
         cast(p_partkey % 3 = 0 as int) as is_imported, cast(n + 20.0::double * (p_partkey * 7919 % 1000) / 1000.0::double > 40.0::double as int) as is_trending,
         n / (10 * n + p_size) as click_through_rate,
         n / (20 * n + p_partkey % 40 + 1) as conversion_rate
  from catalog_base)"""

PC_CLEAN = f"""{PC},
pc as (
  select * replace ({title('trim(category)')} as category, upper(trim(brand)) as brand)
  from product_catalog where product_id is not null and category is not null and final_price_idr > 0)"""

PR = """product_reviews as (
  select d.doc_id as review_id, d.doc_id % 150 as user_id, d.doc_id % 100 as product_id,
         cast(1 + n_chars % 6 as int) as rating, text as review_text,
         timestamp '2024-01-01 00:00:00' + to_hours(cast(d.doc_id as int)) as "timestamp",
         quality as verified_purchase, toxic as has_photo, cast(n_chars % 7 as int) as helpful_votes
  from documents d left join labels l on d.doc_id = l.doc_id)"""

PR_CLEAN = f"""{PR},
pr as (
  select * replace (trim(review_text) as review_text) from product_reviews
  where rating between 1 and 5 and review_text is not null)"""

SL = f"""search_base as (select *, {K} as k from events),
search_logs as (
  select event_id as log_id, user_id, ' ' || upper(event_type) || ' item ' || k || ' ' as query,
         ts as "timestamp", case when k % 3 <> 0 then 'c' || (k % 5) end as filter_category,
         case when k % 4 <> 0 then value end as filter_min_price,
         case when k % 2 <> 0 then value * 2 end as filter_max_price, cast(k % 20 as int) as n_results,
         cast(case when event_type in ('click', 'purchase') then 1 when event_type = 'error' then null
              else 0 end as int) as is_clicked,
         cast(event_type = 'purchase' as int) as has_purchase,
         cast(case when event_type in ('click', 'purchase') then 1 + k % 15
              when event_type = 'error' then null else -1 end as int) as clicked_position,
         cast(floor(value * 10) as int) as response_time_ms, event_type as sort_by, 'p' || (k % 3) as platform
  from search_base)"""

PRED = """predictions as (
  select event_id as id, cast(event_type = 'purchase' as int) as label, value / 500 as score,
         cast(value > 50 as int) as prediction from events)"""

RANKED = f"""ranked as (
  select event_id as id, {K} as query_id,
         cast(event_type in ('click', 'purchase') as int) + 2 * cast(event_type = 'purchase' as int) as relevance,
         value as score from events)"""

REQ = f"""requests as (
  select event_id as request_id, ts as requested_at,
    case when event_id % 17 = 0 then '{{"n": ' || {K} || '}}'
         when event_id % 19 = 0 then '{{"user_id": ' || user_id
         when event_id % 5 = 0 then '{{"user_id": ' || user_id || '}}'
         when event_id % 7 = 0 then '{{"user_id": "' || user_id || '"}}'
         when event_id % 11 = 0 then '{{"user_id": "guest' || user_id || '"}}'
         else '{{"user_id": ' || user_id || ', "n": ' || (1 + {K} % 10) || '}}' end as body
  from events),
parsed as (
  select request_id, requested_at, body, json_valid(body) as good_json,
         case when json_valid(body) then json_extract_string(body, '$.user_id') end as asked,
         case when json_valid(body) then cast(json_extract_string(body, '$.n') as int) end as asked_n
  from requests),
opened as (
  select request_id, requested_at, body, asked as user_id,
         cast(case when good_json and asked is not null then coalesce(asked_n, 5) end as int) as n,
         cast(case when good_json and asked is not null then 200 else 400 end as int) as status,
         case when not good_json then 'Invalid JSON in request body'
              when asked is null then 'Missing user_id' end as error
  from parsed)"""


def ask(*tables: str, then: str) -> str:
    return "with " + ",\n".join(tables) + "\n" + then
