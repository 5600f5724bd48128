"""DuckDB queries that say what the batch queries have to return.

Each is written from the report's rule over plain views of the tables, with row-by-row joins
and distinct counts, and shares no plan with the Spark queries. ``ORACLES`` maps the query's name
to complete SQL text; views that a query does not name cost nothing.
"""

from __future__ import annotations

from marketlens.plans import oracles_rows

SHOP = "'shop_' || lpad(cast({} % 20 as varchar), 3, '0')"

VIEWS = f"""
ev as (select event_id, ts, user_id, event_type, cast(value as decimal(12,2)) as value, cast(json_extract_string(props, '$.k') as bigint) as k from events),
ods_logs as (select event_id as id, {SHOP.format('k')} as shop_no, user_id, k as product_id, ts as event_time, cast(floor(value) as bigint) as duration_seconds,
  case when value < 5 then 1 else 0 end as is_bounce, cast(ts as date) as ds from ev where event_type = 'view'),
dim_favorite as (select event_id as id, user_id, k as product_id, {SHOP.format('k')} as shop_no, ts as favor_time, cast(ts as date) as ds from ev where event_type = 'signup'),
dim_cart as (select event_id as id, user_id, k as product_id, {SHOP.format('k')} as shop_no, event_id % 5 + 1 as qty, value as cart_price, ts as add_time from ev where event_type = 'click'),
order_info as (select event_id as id, user_id, {SHOP.format('k')} as shop_no, ts as order_time,
  case when event_id % 10 between 4 and 8 then ts + to_minutes(event_id % 120 + 1) end as pay_time,
  case when event_id % 10 < 4 then 'CREATED' when event_id % 10 < 9 then 'PAID' else 'CANCELLED' end as status from ev where event_type = 'purchase'),
order_detail as (select event_id * 10 + n as id, event_id as order_id, (k + 7 * n) % 100 as product_id, 'color' || (event_id % 6) as sku_color,
  'size' || n as sku_size, event_id % 4 + 1 as qty, value as unit_price, cast(value * (event_id % 4 + 1) as decimal(12,2)) as amount, ts as create_time
  from (select *, unnest(range(0, event_id % 3 + 1)) as n from ev where event_type = 'purchase')),
lines as (select d.*, o.user_id, o.shop_no, o.order_time, o.pay_time, o.status from order_detail d join order_info o on o.id = d.order_id),
ecom as (select event_id, user_id, k as product_id, k * 10 + event_id % 10 as sku_id, ts as visit_time,
  case event_type when 'signup' then 'collect' when 'click' then 'add_to_cart' when 'purchase' then 'purchase' else 'visit' end as action,
  cast(value * 4 as decimal(12,2)) as price,
  case event_id % 5 when 0 then 'direct' when 1 then 'search' when 2 then 'social' when 3 then 'email' else 'ad' end as channel, event_id % 5 + 1 as rating from ev),
oms_sale as (select event_id as id, k as product_id, user_id, event_id % 9 + 1 as num, cast(value * (event_id % 9 + 1) as decimal(12,2)) as amount,
  epoch_us(ts) // 1000 as ms from ev where event_type = 'purchase'),
docs as (select doc_id as event_id, text from documents),
comment_info as (select ev.event_id as id, user_id, k as sku_id, cast(ev.event_id % 3 + 1 as varchar) as appraise, ts as create_time, text from ev join docs using (event_id)),
sku_info as (select p_partkey as sku_id, p_name as sku_name, p_partkey % 50 as spu_id, p_brand as tm_name, cast(substr(p_brand, 7) as bigint) as tm_id,
  p_partkey % 25 as category3_id, {SHOP.format('p_partkey')} as shop_no, cast(p_retailprice as decimal(16,2)) as price from part),
category3 as (select n_nationkey as category3_id, n_name as category3_name, n_regionkey as category2_id from nation),
category2 as (select r_regionkey as category2_id, r_name as category2_name, r_regionkey % 2 as category1_id from region),
category1 as (select distinct r_regionkey % 2 as category1_id, 'C' || (r_regionkey % 2) as category1_name from region),
tree as (select * from category3 join category2 using (category2_id) join category1 using (category1_id)),
user_info as (select c_custkey as uid, c_name as uname, cast(date '1960-01-01' + cast(c_custkey * 37 % 16000 as int) as date) as birthday,
  case c_custkey % 3 when 0 then 'M' when 1 then 'F' end as gender, c_custkey % 3 + 1 as user_level from customer),
page_log as (select event_id as log_id, user_id,
  ['app_launch','home_page','search','product_list','product_detail','add_cart','order_confirm','payment'][event_id % 8 + 1] as log_type,
  epoch_us(ts) // 1000 as true_ms, case when event_id % 2 = 0 then epoch_us(ts) // 1000 else epoch_us(ts) // 1000000 * 1000 end as ms, k as product_id,
  case when event_id % 8 >= 6 then event_id end as order_id, case when event_id % 8 = 2 then 'word' || (k % 40) end as keyword,
  case when user_id % 2 = 0 then 'android' else 'ios' end as plat, 'brand' || (user_id % 4) as brand, cast(10 + user_id % 6 as varchar) as platv,
  case k % 4 when 0 then 'wifi' when 1 then '5g' else '4g' end as net, '10.' || (user_id % 30) as ip_prefix, strftime(ts, '%Y-%m-%d') as stat_date from ev),
ip_regions as (select '10.' || p as ip_prefix, r_name as province, n_name as city
  from (select n_name, r_name, unnest([n_nationkey, n_nationkey + 25]) as p from nation join region on n_regionkey = r_regionkey) where p < 30),
vehicle as (select event_id as id, 'V' || user_id as vehicleno, 100 + k * cast(0.01 as double) as lon, 20 + (event_id % 1000) * cast(0.001 as double) as lat,
  epoch_us(ts) // 1000000 * 1000 as ms, strftime(ts, '%Y%m%d') as day, event_type from ev),
behaviour as (
  select user_id, product_id as sku_id, 'cart' as kind, add_time as t, cast(cart_price as decimal(10,2)) as order_price, qty as cart_num, null as appraise, null as is_cancel from dim_cart
  union all select user_id, product_id, 'favor', favor_time, null, null, null, '0' from dim_favorite
  union all select user_id, sku_id, 'comment', create_time, null, null, appraise, null from comment_info),
trade as (select order_id, user_id, l.product_id as sku_id, sku_name, cast(unit_price as decimal(10,2)) as order_price, qty as sku_num, amount, status, s.tm_id, s.tm_name, category3_id,
  coalesce(pay_time, order_time) as payment_time from lines l left join sku_info s on s.sku_id = l.product_id),
sku_day as (
  select b.stat_date, b.sku_id, sku_name, category3_id, tm_id, tm_name, visitor_count, page_view_count, favor_count, cart_count, cart_user_count,
    coalesce(payment_user_count, 0) as payment_user_count, coalesce(payment_sku_count, 0) as payment_sku_count, coalesce(payment_amount, 0) as payment_amount
  from (select strftime(t, '%Y-%m-%d') as stat_date, sku_id, count(distinct user_id) as visitor_count, count(*) as page_view_count,
          count(distinct case when kind = 'favor' then user_id end) as favor_count, coalesce(sum(cart_num), 0) as cart_count,
          count(distinct case when kind = 'cart' then user_id end) as cart_user_count from behaviour group by all) b
  left join (select strftime(payment_time, '%Y-%m-%d') as stat_date, sku_id, count(distinct user_id) as payment_user_count, sum(sku_num) as payment_sku_count,
          sum(amount) as payment_amount from trade group by all) p using (stat_date, sku_id)
  left join sku_info s on s.sku_id = b.sku_id)
"""

HOUR = "strftime({}, '%Y-%m-%d %H:00:00')"
SECOND = "strftime(make_timestamp(({}) * 1000), '%Y-%m-%d %H:%M:%S')"
DAY_MS = 86_400_000

# The price bands of the reports.
TEN_BANDS = "case when {p} < 100 then '0-99' " + " ".join(
    f"when {{p}} between {low} and {low + 100} then '{low}-{low + 99}'" for low in range(100, 1000, 100)) + " else '1000+' end"
HALF_OPEN = "case when {p} < 50 then '0-50' when {p} < 100 then '50-100' when {p} < 300 then '100-300' when {p} < 1000 then '300-1000' else '1000+' end"
CLOSED = ("case when {p} between 0 and 99 then '0-99' when {p} between 100 and 199 then '100-199' when {p} between 200 and 499 then '200-499' "
          "when {p} between 500 and 999 then '500-999' else '1000+' end")


def price_of(amount: str, n: str) -> str:
    """Amount by number in whole cents, half a cent up; 0 without a number."""
    return f"case when coalesce({n}, 0) = 0 then 0 else cast((2 * cast({amount} * 100 as bigint) + {n}) // (2 * {n}) as double) / 100 end"


def ratio(a: str, b: str, scale: int, on_zero: str = "null") -> str:
    return f"case when coalesce({b}, 0) = 0 then {on_zero} else round(cast({a} as double) / cast({b} as double), {scale}) end"


PAGES = f"""select shop_no, product_id, {HOUR.format('event_time')} as stat_hour, count(*) as product_pv, count(distinct user_id) as product_uv,
  round(cast(sum(duration_seconds) as double) / count(*), 6) as avg_duration, round(cast(sum(is_bounce) as double) / count(*), 6) as bounce_rate from ods_logs group by all"""
FAVOURITES = f"select shop_no, product_id, {HOUR.format('favor_time')} as stat_hour, count(distinct user_id) as fav_users from dim_favorite group by all"
CART = f"select shop_no, product_id, {HOUR.format('add_time')} as stat_hour, cast(sum(qty) as bigint) as cart_qty, count(distinct user_id) as cart_users from dim_cart group by all"
ORDERS = f"""select shop_no, product_id, {HOUR.format('order_time')} as stat_hour, count(distinct case when status in ('CREATED', 'PAID') then user_id end) as order_users,
  cast(sum(qty) as bigint) as order_qty, cast(sum(amount) as double) as order_amount from lines group by all"""
PAYMENTS = f"""select shop_no, product_id, {HOUR.format('pay_time')} as stat_hour, count(distinct user_id) as pay_users, cast(sum(qty) as bigint) as pay_qty,
  cast(sum(amount) as double) as pay_amount from lines where status = 'PAID' and pay_time is not null group by all"""


def tumbling(ms: str, size: int) -> str:
    return f"{SECOND.format(f'{ms} // {size} * {size}')} as window_start, {SECOND.format(f'{ms} // {size} * {size} + {size}')} as window_end"


def cumulating(step: int, measures: str, item: str = "") -> str:
    """Every step of a day from the first one with a row on, with all rows of the day up to its end."""
    own = f", {item}" if item else ""
    return f"""
  select {SECOND.format('w.day')} as window_start, {SECOND.format('w.ends')} as window_end{own and ', w.' + item}, {measures}
  from (select day{own}, unnest(range(first, {DAY_MS} // {step} + 1)) * {step} + day as ends
        from (select ms // {DAY_MS} * {DAY_MS} as day{own}, min(ms % {DAY_MS} // {step}) + 1 as first from oms_sale group by all)) w
  join oms_sale s on s.ms >= w.day and s.ms < w.ends {'and s.' + item + ' = w.' + item if item else ''} group by all"""


QUERIES = {
    # sources and projections
    "scan_partition": "select shop_no, count(*) as n from ods_logs where ds = date '2024-01-15' group by all",
    "price_band": " union all ".join(f"select '{kind}' as bands, {bands.format(p='price')} as label, count(*) as n from ecom group by all"
                                     for kind, bands in (("ten", TEN_BANDS), ("half_open", HALF_OPEN), ("closed", CLOSED))),
    "json_text": "select event_id, json_extract_string(props, '$.k') as k from events",
    "platform_filter": "select plat, log_type, count(*) as n from page_log where log_type in ('product_detail', 'add_cart', 'order_confirm', 'payment') group by all",
    "safe_number": "select event_id, cast(value as double) as amount from ev where event_id % 7 <> 0 and event_id % 11 <> 0",
    "safe_ratio": f"""select k, {ratio('a', 'b % 7', 4, '0')} as zeroed, {ratio('a', 'b', 6)} as ratio, round(cast(a as double) / nullif(b, 0) * 100, 4) as pct
      from (select k, count(*) filter (where event_type = 'purchase') as a, count(*) filter (where event_type = 'view') as b from ev group by k)""",
    "default_values": "select id, strftime(coalesce(pay_time, timestamp '2024-01-01'), '%Y-%m-%d %H:%M:%S') as operate_time, 'none' as store_no from order_info",
    "clean_id": "select event_id, cast(k as varchar) as product_id from ev",
    "math_functions": "select event_id, cast(round(cast(value as decimal(18,6)) / 7, 3) as double) as third, event_id % 10 + 1 as bucket, nullif(k % 5, 0) as no_zero from ev",
    "day_part": """select event_id, case when hour(ts) < 6 then '凌晨' when hour(ts) < 9 then '早晨' when hour(ts) < 12 then '上午' when hour(ts) < 14 then '中午'
      when hour(ts) < 18 then '下午' when hour(ts) < 22 then '晚上' else '夜间' end as pay_time_slot from ev""",
    "array_functions": """select user_id, string_agg(keyword, ',' order by keyword) as words, string_agg(cast(n as varchar), ',' order by keyword) as freqs
      from (select user_id, keyword, count(*) as n from page_log where keyword is not null group by all) group by user_id""",
    "upsert_by_key": """select id, cast(price as double) as price, ts_ms from (
      select *, row_number() over (partition by id order by ts_ms desc, new desc) as rn from (
        select p_partkey as id, cast(p_retailprice as decimal(12,2)) as price, 0 as ts_ms, 0 as new from part
        union all select sku_id * 25, price, epoch_us(visit_time) // 1000 * 1000000 + event_id, 1 from ecom)) where rn = 1""",
    # joins
    "order_lines": "select id, order_id, product_id, user_id, shop_no, status, qty, cast(amount as double) as amount, strftime(order_time, '%Y-%m-%d %H:%M:%S') as order_time from lines",
    "sku_dimension": """select sku_id, sku_name, spu_id, tm_id, tm_name, s.category3_id, category3_name, category2_id, category2_name, category1_id, category1_name, cast(price as double) as price
      from sku_info s left join tree using (category3_id)""",
    "category_tree": "select category3_id, category3_name, category2_id, category2_name, category1_id, category1_name from tree",
    "trade_detail": """select order_id, user_id, sku_id, sku_name, cast(order_price as double) as order_price, sku_num, cast(amount as double) as total_amount, status as order_status,
      case status when 'CREATED' then '已下单' when 'PAID' then '已支付' else 'N/A' end as order_status_name, tm_id, strftime(payment_time, '%Y-%m-%d %H:%M:%S') as payment_time from trade""",
    "visit_to_purchase": """select product_id, user_id, count(*) filter (where action = 'visit') as visits, count(*) filter (where action = 'purchase') as purchases,
      max(case when action = 'purchase' then 1 else 0 end) as purchased from ecom where action in ('visit', 'purchase') group by all having visits > 0""",
    "full_join_metrics": f"""select coalesce(p.shop_no, f.shop_no, c.shop_no) as shop_no, coalesce(p.product_id, f.product_id, c.product_id) as product_id,
      coalesce(p.stat_hour, f.stat_hour, c.stat_hour) as stat_hour, coalesce(product_pv, 0) as product_pv, coalesce(product_uv, 0) as product_uv, coalesce(fav_users, 0) as fav_users,
      coalesce(cart_qty, 0) as cart_qty, coalesce(cart_users, 0) as cart_users from ({PAGES}) p full join ({FAVOURITES}) f using (shop_no, product_id, stat_hour)
      full join ({CART}) c on c.shop_no = coalesce(p.shop_no, f.shop_no) and c.product_id = coalesce(p.product_id, f.product_id) and c.stat_hour = coalesce(p.stat_hour, f.stat_hour)""",
    "join_agg": """select v.product_id, pv, coalesce(qty, 0) as qty from (select product_id, count(*) as pv from ods_logs group by all) v
      left join (select product_id, cast(sum(qty) as bigint) as qty from order_detail group by all) using (product_id)""",
    "join_on_day": """select c.user_id, strftime(add_time, '%Y-%m-%d') as stat_date, c.id as cart_id,
      (select count(*) from order_info o where o.user_id = c.user_id and cast(o.order_time as date) = cast(c.add_time as date)) as orders from dim_cart c""",
    "with_scalar": "select k, count(distinct user_id) as uv, (select count(distinct user_id) from ev) as total_uv from ev group by k",
    "join_windows": f"""select {tumbling('w', 600_000)}, sales, coalesce(carts, 0) as carts from
      (select ms // 600000 * 600000 as w, count(*) as sales from oms_sale group by all)
      left join (select epoch_us(add_time) // 1000 // 600000 * 600000 as w, count(*) as carts from dim_cart group by all) using (w)""",
    "interval_join": """select a.user_id, a.event_id as click_id, epoch_us(a.ts) // 1000 as click_ms, b.event_id as buy_id, epoch_us(b.ts) // 1000 as buy_ms
      from ev a join ev b on a.user_id = b.user_id and a.event_type = 'click' and b.event_type = 'purchase' and abs(epoch_us(a.ts) // 1000 - epoch_us(b.ts) // 1000) <= 600000""",
    "lookup": "select id, appraise, case appraise when '1' then '好评' when '2' then '中评' else 'N/A' end as dic_name from comment_info",
    # dashboard
    "product_visits": """select product_id, count(distinct user_id) as visitor_count, count(*) filter (where action = 'visit') as page_views,
      count(*) filter (where action = 'add_to_cart') as add_to_cart_count, count(distinct case when action = 'add_to_cart' then user_id end) as add_to_cart_users from ecom group by all""",
    "purchase_conversion": """select v.product_id, count(*) as visitors, count(b.user_id) as purchasers, round(cast(count(b.user_id) as double) / count(*) * 100, 4) as conversion_rate
      from (select distinct product_id, user_id from ecom where action = 'visit') v
      left join (select distinct product_id, user_id from ecom where action = 'purchase') b using (product_id, user_id) group by v.product_id""",
    "price_band_sales": f"select {TEN_BANDS.format(p='price')} as price_band, count(*) as purchase_count, cast(sum(price) as double) as total_revenue from ecom where action = 'purchase' group by all",
    "channel_conversion": """select channel, count(*) as total_visits, count(*) filter (where action = 'purchase') as total_purchases,
      round(cast(count(*) filter (where action = 'purchase') as double) / count(*) * 100, 4) as conversion_rate from ecom group by channel""",
    "channel_share": """select channel, visitors, buyers, round(cast(visitors as double) / sum(visitors) over (), 6) as share, round(cast(buyers as double) / visitors * 100, 4) as conversion_rate
      from (select channel, count(distinct user_id) as visitors, count(distinct case when action = 'purchase' then user_id end) as buyers from ecom group by channel)""",
    "rating_histogram": "select product_id, rating, count(*) as rating_count from ecom group by all",
    "hourly_page_metrics": PAGES,
    "hourly_favourites": FAVOURITES,
    "hourly_cart": CART,
    "hourly_orders": ORDERS,
    "hourly_payments": PAYMENTS,
    "hourly_product_result": f"""
      select '2024-06-30' as dt, shop_no, stat_hour, product_id, coalesce(product_pv, 0) as product_pv, coalesce(product_uv, 0) as product_uv, coalesce(avg_duration, 0) as avg_duration,
        coalesce(bounce_rate, 0) as bounce_rate, coalesce(fav_users, 0) as fav_users, coalesce(cart_qty, 0) as cart_qty, coalesce(cart_users, 0) as cart_users,
        {ratio('coalesce(fav_users, 0)', 'product_uv', 6, '0')} as visit_to_fav_rate, {ratio('coalesce(cart_users, 0)', 'product_uv', 6, '0')} as visit_to_cart_rate,
        coalesce(order_users, 0) as order_users, coalesce(order_qty, 0) as order_qty, coalesce(order_amount, 0) as order_amount,
        {ratio('coalesce(order_users, 0)', 'product_uv', 6, '0')} as order_rate, coalesce(pay_users, 0) as pay_users, coalesce(pay_qty, 0) as pay_qty,
        coalesce(pay_amount, 0) as pay_amount, {ratio('coalesce(pay_users, 0)', 'product_uv', 6, '0')} as pay_rate
      from (select shop_no, product_id, stat_hour from ({PAGES}) union select shop_no, product_id, stat_hour from ({FAVOURITES}) union select shop_no, product_id, stat_hour from ({CART})
            union select shop_no, product_id, stat_hour from ({ORDERS}) union select shop_no, product_id, stat_hour from ({PAYMENTS}))
      left join ({PAGES}) using (shop_no, product_id, stat_hour) left join ({FAVOURITES}) using (shop_no, product_id, stat_hour) left join ({CART}) using (shop_no, product_id, stat_hour)
      left join ({ORDERS}) using (shop_no, product_id, stat_hour) left join ({PAYMENTS}) using (shop_no, product_id, stat_hour)""",
    "pay_price_buckets": f"""select shop_no, product_id, stat_hour, {HALF_OPEN.format(p='pay_amount / pay_qty')} as price_bucket, pay_qty as bucket_pay_qty, pay_amount as bucket_pay_amount from ({PAYMENTS})""",
    "top_products_by_views": "select product_id, count(*) as pv, count(distinct user_id) as uv from ods_logs group by all order by pv desc, product_id limit 20",
    # warehouse
    "behaviour_union": """select kind as behavior_type, strftime(t, '%Y-%m-%d') as ds, count(*) as n, count(cart_num) as cart_rows, count(appraise) as appraised, count(is_cancel) as cancel_flags
      from behaviour group by all""",
    "sku_daily": f"""select stat_date, d.sku_id, sku_name, d.category3_id, category3_name, tm_id, tm_name, visitor_count, page_view_count, favor_count, cast(cart_count as bigint) as cart_count,
        cart_user_count, 0 as order_user_count, 0 as order_sku_count, cast(0 as double) as order_amount, payment_user_count, cast(payment_sku_count as bigint) as payment_sku_count,
        cast(payment_amount as double) as payment_amount, {ratio('favor_count', 'visitor_count', 4)} as visitor_to_favor_rate, {ratio('cart_user_count', 'visitor_count', 4)} as visitor_to_cart_rate,
        cast(0 as double) as visitor_to_order_rate, {ratio('payment_user_count', 'visitor_count', 4)} as visitor_to_payment_rate,
        {price_of('payment_amount', 'payment_user_count')} as avg_order_price, {price_of('payment_amount', 'visitor_count')} as visitor_avg_value
      from sku_day d left join category3 using (category3_id)""",
    "category_daily": f"""select stat_date, d.category3_id, category3_name, category2_id, category2_name, category1_id, category1_name, visitor_count, sku_with_visitor_count, payment_user_count,
        payment_sku_count, cast(payment_amount as double) as payment_amount, sku_with_payment_count, {ratio('payment_user_count', 'visitor_count', 4)} as payment_conversion_rate,
        {price_of('payment_amount', 'payment_user_count')} as avg_order_price
      from (select stat_date, category3_id, cast(sum(visitor_count) as bigint) as visitor_count, count(*) as sku_with_visitor_count, cast(sum(payment_user_count) as bigint) as payment_user_count,
              cast(sum(payment_sku_count) as bigint) as payment_sku_count, cast(sum(payment_amount) as decimal(16,2)) as payment_amount,
              count(*) filter (where payment_user_count > 0) as sku_with_payment_count from sku_day group by all) d left join tree using (category3_id)""",
    "brand_daily": f"""select * replace (cast(payment_amount as double) as payment_amount), {ratio('payment_user_count', 'visitor_count', 4)} as payment_conversion_rate, {price_of('payment_amount', 'payment_user_count')} as avg_order_price
      from (select stat_date, tm_id, tm_name, cast(sum(visitor_count) as bigint) as visitor_count, count(*) as sku_with_visitor_count, cast(sum(payment_user_count) as bigint) as payment_user_count,
              cast(sum(payment_sku_count) as bigint) as payment_sku_count, cast(sum(payment_amount) as decimal(16,2)) as payment_amount,
              count(*) filter (where payment_user_count > 0) as sku_with_payment_count from sku_day group by all)""",
    "user_daily": """select b.stat_date, b.user_id, page_view_count, favor_count, cart_count, 0 as order_count, coalesce(payment_count, 0) as payment_count, cast(0 as double) as total_order_amount,
        cast(coalesce(total_payment_amount, 0) as double) as total_payment_amount, 1 as active_days, last_behavior_time
      from (select strftime(t, '%Y-%m-%d') as stat_date, user_id, count(*) as page_view_count, count(*) filter (where kind = 'favor') as favor_count,
              count(*) filter (where kind = 'cart') as cart_count, strftime(max(t), '%Y-%m-%d %H:%M:%S') as last_behavior_time from behaviour group by all) b
      left join (select strftime(payment_time, '%Y-%m-%d') as stat_date, user_id, count(distinct order_id) as payment_count, sum(amount) as total_payment_amount from trade group by all) p
        using (stat_date, user_id)""",
    "sku_interaction": """select sku_id, sku_name, shop_no as shop_id, tm_name, (select count(distinct user_id) from behaviour b where kind = 'favor' and b.sku_id = s.sku_id) as favor_buyer_num,
      (select count(distinct user_id) from behaviour b where kind = 'cart' and b.sku_id = s.sku_id) as cart_buyer_num from sku_info s""",
    "sku_conversion": f"""select s.sku_id, sku_name, shop_no as shop_id, category3_id, {ratio('coalesce(pay_buyer_num, 0)', 'visitors', 4, '0')} as pay_conversion_rate,
        cast(coalesce(pay_amt, 0) as double) as pay_amt, coalesce(pay_num, 0) as pay_num, coalesce(pay_buyer_num, 0) as pay_buyer_num, coalesce(cart_num, 0) as cart_num,
        coalesce(cart_buyer_num, 0) as cart_buyer_num, coalesce(favor_buyer_num, 0) as favor_buyer_num
      from sku_info s left join (select sku_id, count(distinct user_id) as visitors, cast(sum(cart_num) as bigint) as cart_num, count(distinct case when kind = 'cart' then user_id end) as cart_buyer_num,
          count(distinct case when kind = 'favor' then user_id end) as favor_buyer_num from behaviour group by all) b using (sku_id)
      left join (select sku_id, count(distinct user_id) as pay_buyer_num, cast(sum(sku_num) as bigint) as pay_num, sum(amount) as pay_amt from trade group by all) t using (sku_id)""",
    "sku_comments": f"""select s.sku_id, sku_name, shop_no as shop_id, tm_name, coalesce(n, 0) as total_comment_num, coalesce(good, 0) as good_comment_num, coalesce(mid, 0) as mid_comment_num,
        coalesce(bad, 0) as bad_comment_num, {ratio('good * 5 + mid * 3 + bad', 'n', 2, '0')} as avg_score, {ratio('good', 'n', 4, '0')} as good_comment_rate
      from sku_info s left join (select sku_id, count(*) as n, count(*) filter (where appraise = '1') as good, count(*) filter (where appraise = '2') as mid,
        count(*) filter (where appraise = '3') as bad from comment_info group by all) c using (sku_id)""",
    "sku_customers": f"""select stat_date, sku_id, count(*) as total_visitor_num, count(*) filter (where first_date = stat_date) as new_user_num,
        count(*) filter (where first_date <> stat_date) as old_user_num, {ratio('count(*) filter (where first_date = stat_date)', 'count(*)', 4)} as new_old_ratio,
        {ratio("count(*) filter (where gender = 'M')", 'count(*)', 4)} as male_ratio, {ratio("count(*) filter (where gender = 'F')", 'count(*)', 4)} as female_ratio
      from (select distinct strftime(t, '%Y-%m-%d') as stat_date, sku_id, user_id from behaviour)
      join (select user_id, strftime(min(t), '%Y-%m-%d') as first_date from behaviour group by user_id) using (user_id) left join user_info on uid = user_id group by stat_date, sku_id""",
    "count_audit": " union all ".join(f"select '{t}' as tbl, count(*) as row_count from {t}" for t in ("ods_logs", "dim_favorite", "dim_cart", "order_info", "order_detail")),
    "partition_audit": "select cast(ds as varchar) as ds, count(*) as row_count from ods_logs group by ds",
    # behaviour log
    "page_views_daily": "select stat_date as visit_date, log_type as page, count(*) as pv from page_log group by all",
    "with_history": "select stat_date as visit_date, log_type as page, count(*) as pv from page_log group by all",
    "region_heat": """select stat_date, province, count(*) as visit_count, row_number() over (partition by stat_date order by count(*) desc, province) as rank
      from page_log join ip_regions using (ip_prefix) group by stat_date, province""",
    "region_city_heat": """select stat_date, province, city, count(*) as visit_count, row_number() over (partition by stat_date order by count(*) desc, province, city) as rank
      from page_log join ip_regions using (ip_prefix) group by stat_date, province, city""",
    "ranked_map": """select stat_date, string_agg(province || '=' || n, ',' order by n desc, province) as ranking
      from (select stat_date, province, count(*) as n from page_log join ip_regions using (ip_prefix) group by all) group by stat_date""",
    "device_daily": "select stat_date, plat, brand, platv, count(distinct user_id) as device_count from page_log group by all",
    "device_history_today": """select brand, plat, net, case when stat_date < '2024-01-15' then 'history' else 'today' end as data_type, count(distinct user_id) as user_cnt
      from page_log where stat_date <= '2024-01-15' group by all""",
    "device_tree": """select stat_date, '{' || string_agg('"' || plat || '":' || inside, ',' order by plat) || '}' as log_content from (
      select stat_date, plat, '{' || string_agg('"' || brand || '":' || inside, ',' order by brand) || '}' as inside from (
        select stat_date, plat, brand, '{' || string_agg('"' || platv || '":' || n, ',' order by platv) || '}' as inside
        from (select stat_date, plat, brand, platv, count(*) as n from page_log group by all) group by all) group by all) group by all""",
    "top_words_daily": """select stat_date, keyword, cnt, rn from (select stat_date, keyword, count(*) as cnt, row_number() over (partition by stat_date order by count(*) desc, keyword) as rn
      from page_log where keyword is not null group by stat_date, keyword) where rn <= 10""",
    "top_word_map": """select stat_date, string_agg(keyword || '=' || cnt, ',' order by rn) as ranking from (select stat_date, keyword, count(*) as cnt,
      row_number() over (partition by stat_date order by count(*) desc, keyword) as rn from page_log where keyword is not null group by stat_date, keyword) where rn <= 10 group by stat_date""",
    "top_n": """select channel, product_id, visits, rn from (select channel, product_id, count(*) as visits, row_number() over (partition by channel order by count(*) desc, product_id) as rn
      from ecom group by channel, product_id) where rn <= 10""",
    "tag_history": "select case when stat_date < '2024-01-15' then 'history' else 'today' end as data_type, stat_date, count(*) as n from page_log where stat_date <= '2024-01-15' group by all",
    "page_transitions": """select user_id, coalesce(lag(log_type) over w, '') as last_page, log_type as current_page, ms as ts_ms, coalesce((ms - lag(ms) over w) // 1000, -1) as stay_seconds
      from page_log window w as (partition by user_id order by ms, log_id)""",
    "path_anomalies": """
      select user_id, ms as ts_ms, 'repeat' as kind, log_type || ':' || recent as detail from (
        select *, count(*) over (partition by user_id, stat_date, log_type order by ms range between 59999 preceding and current row) as recent from page_log) where recent > 5
      union all select user_id, ms, case last_type when 'payment' then 'after_payment' else 'hesitation' end, coalesce(cast(last_order as varchar), '') from (
        select *, lag(log_type) over w as last_type, lag(order_id) over w as last_order from page_log window w as (partition by user_id, stat_date order by ms, log_id))
      where log_type = 'product_detail' and last_type in ('payment', 'order_confirm')""",
    "daily_totals": "select stat_date, plat, brand, platv, count(*) as total from page_log group by all",
    "running_counts": "select log_id, stat_date, log_type as page, row_number() over (partition by stat_date, log_type order by ms, log_id) as running_count from page_log",
    "keep_rising": """select id, product_id, num from (select id, product_id, num, max(num) over (partition by product_id order by id rows between unbounded preceding and 1 preceding) as top
      from oms_sale) where top is null or num > top""",
    # sales
    "tumble": f"select {tumbling('ms', 600_000)}, cast(sum(amount) as double) as window_sales, count(distinct id) as order_count from oms_sale group by all",
    "window_top": f"""select {tumbling('w', 3_600_000)}, product_id, sold, rn from (select ms // 3600000 * 3600000 as w, product_id, cast(sum(num) as bigint) as sold,
      row_number() over (partition by ms // 3600000 order by sum(num) desc, product_id) as rn from oms_sale group by ms // 3600000, product_id) where rn <= 5""",
    "cumulate": cumulating(600_000, "cast(sum(amount) as double) as total_cumulative_amount"),
    "cumulate_measures": cumulating(600_000, "cast(sum(amount) as double) as gmv, count(*) as orders, count(distinct user_id) as buyers"),
    "cumulate_by_product": cumulating(3_600_000, "cast(sum(amount) as double) as gmv", "product_id"),
    "running_sales": """select strftime(make_timestamp(ms * 1000), '%Y-%m-%d') as stat_date, id, cast(amount as double) as amount,
      cast(sum(amount) over (partition by ms // 86400000 order by ms, id rows unbounded preceding) as double) as running_amount from oms_sale""",
    "ordered_list": "select order_id, 0 as part, string_agg(cast(product_id as varchar), ',' order by create_time, id) as items, count(*) as item_count from order_detail group by order_id",
    # market
    "co_items": """select item_a, item_b, users, moves, rank from (select item_a, item_b, count(distinct user_id) as users, count(*) as moves,
        row_number() over (partition by item_a order by count(*) desc, item_b) as rank from (
          select user_id, lag(product_id) over (partition by user_id order by epoch_us(visit_time) // 1000, event_id) as item_a, product_id as item_b from ecom)
        where item_a is not null and item_a <> item_b group by item_a, item_b) where rank <= 5""",
    "content_top": """select product_id, sku_id, visits, purchases, rn from (select product_id, sku_id, count(*) as visits, count(*) filter (where action = 'purchase') as purchases,
      row_number() over (partition by product_id order by count(*) desc, sku_id) as rn from ecom group by product_id, sku_id) where rn <= 50""",
    "crowd_portrait": """select crowd, coalesce(gender, 'home') as gender, user_level, count(*) as users from (
        select distinct user_id, 'search' as crowd from ecom where channel = 'search' union select distinct user_id, 'visit' from ecom where action = 'visit'
        union select distinct user_id, 'pay' from ecom where action = 'purchase') join user_info on uid = user_id group by all""",
    "attribute_sales": """select product_id, sku_color as attribute, cast(sum(qty) as bigint) as sold, cast(sum(amount) as double) as amount,
      row_number() over (partition by product_id order by sum(qty) desc, sku_color) as rank from order_detail group by product_id, sku_color""",
    "attribute_sales_size": """select product_id, sku_size as attribute, cast(sum(qty) as bigint) as sold, cast(sum(amount) as double) as amount,
      row_number() over (partition by product_id order by sum(qty) desc, sku_size) as rank from order_detail group by product_id, sku_size""",
    # wide and rolling reports
    "product_wide": """
      select ds, store_no, product_id, coalesce(max(uv), 0) as uv, coalesce(max(pv_cnt), 0) as pv_cnt, coalesce(max(favor_user_cnt), 0) as favor_user_cnt, coalesce(max(cart_user_cnt), 0) as cart_user_cnt,
        coalesce(max(cart_quantity), 0) as cart_quantity, coalesce(max(pay_user_cnt), 0) as pay_user_cnt, coalesce(max(pay_quantity), 0) as pay_quantity, cast(coalesce(max(pay_amount), 0) as double) as pay_amount
      from (
        select strftime(event_time, '%Y-%m-%d') as ds, shop_no as store_no, product_id, count(distinct user_id) as uv, count(*) as pv_cnt, null as favor_user_cnt, null as cart_user_cnt,
          null as cart_quantity, null as pay_user_cnt, null as pay_quantity, null as pay_amount from ods_logs group by all
        union all select strftime(favor_time, '%Y-%m-%d'), shop_no, product_id, null, null, count(distinct user_id), null, null, null, null, null from dim_favorite group by all
        union all select strftime(add_time, '%Y-%m-%d'), shop_no, product_id, null, null, null, count(distinct user_id), cast(sum(qty) as bigint), null, null, null from dim_cart group by all
        union all select strftime(order_time, '%Y-%m-%d'), shop_no, product_id, null, null, null, null, null, count(distinct user_id), cast(sum(qty) as bigint), sum(unit_price * qty)
          from lines where status = 'PAID' group by all) group by all""",
    "rolling_product": "select v.product_id, strftime(v.d, '%Y-%m-%d') as stat_date, " + ", ".join(
        f"""(select count(*) from ods_logs o where o.product_id = v.product_id and o.ds between v.d - {n - 1} and v.d) as pv_{n}d,
        (select count(distinct user_id) from ods_logs o where o.product_id = v.product_id and o.ds between v.d - {n - 1} and v.d) as uv_{n}d,
        cast(coalesce((select sum(amount) from lines l where l.status = 'PAID' and l.product_id = v.product_id and cast(l.order_time as date) between v.d - {n - 1} and v.d), 0) as double) as pay_{n}d"""
        for n in (1, 7, 15, 30)) + " from (select distinct product_id, ds as d from ods_logs) v",
    "price_trend": """select product_id, stat_date, avg_price, round(coalesce(avg_price - lag(avg_price) over (partition by product_id order by stat_date), 0), 4) as price_change,
        (select count(*) from ods_logs o where o.product_id = p.product_id and strftime(o.event_time, '%Y-%m-%d') = p.stat_date) as visits
      from (select product_id, strftime(order_time, '%Y-%m-%d') as stat_date, round(cast(sum(amount) as double) / sum(qty), 4) as avg_price from lines where status = 'PAID' group by all) p""",
    "title_words": """select word, count(*) filter (where action = 'visit') as visits, count(distinct case when action = 'visit' then user_id end) as visitors,
        count(distinct case when action = 'purchase' then user_id end) as buyers,
        round(cast(count(distinct case when action = 'purchase' then user_id end) as double) / nullif(count(distinct case when action = 'visit' then user_id end), 0) * 100, 4) as conversion_rate
      from ecom join (select sku_id as product_id, unnest(list_distinct(regexp_split_to_array(lower(sku_name), '\\s+'))) as word from sku_info) using (product_id)
      where action in ('visit', 'purchase') group by word""",
    "sku_traffic": f"""select s.sku_id, sku_name, shop_no as shop_id, tm_name, category3_id, (select count(distinct user_id) from behaviour) as total_uv, coalesce(sku_uv, 0) as sku_uv,
        coalesce(pv, 1) as sku_pv, coalesce(micro, 0) as sku_micro_uv, {ratio('pv * 30', 'sku_uv', 2, '0')} as avg_stay_time, {ratio('once', 'sku_uv', 4, '0')} as sku_jump_rate,
        cast(coalesce(clicks, 0) as bigint) as sku_click_cnt
      from sku_info s left join (select sku_id, count(*) as sku_uv, cast(sum(n) as bigint) as pv, count(*) filter (where acts > 0) as micro, count(*) filter (where n = 1) as once, sum(clicks) as clicks
        from (select sku_id, user_id, count(*) as n, count(*) filter (where kind in ('favor', 'cart')) as acts, sum(cart_num) as clicks from behaviour group by all) group by sku_id) using (sku_id)""",
    "partial_update": """select user_id as id, strftime(ts, '%Y-%m-%d') as ds, max(epoch_us(ts) // 1000) as ts_ms, arg_max(k, ts) filter (where event_type = 'click') as sku_num,
        arg_max(event_id, ts) filter (where event_type = 'purchase') as sku_id from ev where event_type <> 'error' group by all""",
    "dim_upsert": """select md5(cast(o_custkey as varchar)) as row_key, cast(o_custkey as varchar) as id, o_orderstatus as status, cast(o_orderkey as varchar) as seq from (
        select *, row_number() over (partition by o_custkey order by o_orderkey desc) as rn from orders) where rn = 1""",
    "drop_seen": """select user_id, hour, event_id, k from (select user_id, epoch_us(ts) // 3600000000 as hour, event_id, k,
        row_number() over (partition by user_id, epoch_us(ts) // 3600000000 order by event_id) as rn from ev) where rn = 1""",
    "last_per_interval": """select window_start, log_id, user_id, log_type, ms from (select *, ms // 7200000 * 7200000 as window_start,
        row_number() over (partition by user_id, ms // 7200000 order by ms desc, log_id desc) as rn from page_log) where rn = 1""",
    "cumulate_seconds": cumulating(10_000, "cast(sum(amount) as double) as total_cumulative_amount"),
    "cumulative_report": f"""
      with sold as ({cumulating(600_000, "sum(amount) as amount", "product_id")}),
      best as (select *, row_number() over (partition by window_start, window_end order by amount desc, product_id) as rn from sold)
      select left(window_start, 10) as ds, window_start, window_end, cast(sum(amount) as double) as win_gmv, cast(sum(amount) filter (where rn <= 5) as double) as top5_gmv,
        string_agg(cast(product_id as varchar), ',' order by rn) filter (where rn <= 5) as top5_product_ids from best group by all""",
    "cumulative_top_sold": f"""
      with sold as ({cumulating(600_000, "cast(sum(num) as bigint) as amount", "product_id")}),
      best as (select *, row_number() over (partition by window_start, window_end order by amount desc, product_id) as rn from sold)
      select window_start, window_end, string_agg(product_id || '(' || amount || ')', ', ' order by rn) as top5_product_ids from best where rn <= 5 group by all""",
    **{name: f"""
      with days as (select user_id, stat_date, count(*) as event_count, (max(ms) - min(ms)) // 1000 as total_duration, max(case when log_type = 'payment' then 1 else 0 end) as paid,
          string_agg(log_type, ' → ' order by ms, log_id) as path_sequence from page_log group by all),
      past as (select *, count(*) over w as past_days, coalesce(sum(paid) over w, 0) as past_paid from days
        window w as (partition by user_id order by stat_date rows between unbounded preceding and {upto}))
      select user_id, stat_date as analysis_date, 0 as part, path_sequence, case when paid = 1 then '已转化' else '未转化' end as conversion_status, event_count, total_duration,
        {kind} as user_type from past"""
       for name, upto, kind in (
           ("user_paths", "1 preceding", "case when past_paid > 0 and paid = 1 then '高价值用户' when past_paid = 0 and paid = 0 then '普通用户' else '观望用户' end"),
           ("user_paths_literal", "current row", "case when past_paid > 0 and paid = 1 then '高价值用户' when past_paid = 0 and paid = 0 then '普通用户' else '观望用户' end"),
           ("user_paths_v1106", "1 preceding", "case when past_paid > 0 and paid = 1 then '高价值用户' when past_days >= 3 and past_paid = 0 then '观望用户' "
                                               "when paid = 1 and past_days = 0 then '新用户首单' else '普通用户' end"))},
    # rows reshaped, and small reports
    "scan_days": "select shop_no, count(*) as n from ods_logs where event_time >= date '2024-01-08' and event_time < date '2024-01-16' group by all",
    "median_and_mean": "select product_id, round(median(cast(price as double)), 4) as median, round(avg(cast(price as double)), 4) as mean from ecom group by all",
    "rank_pivot": f"""select {tumbling('w', 3_600_000)}, array_to_string(list_resize(list(cast(id as varchar) order by rn) filter (where rn <= 5), 5, ''), ',') as top5_ids
      from (select ms // 3600000 * 3600000 as w, id, row_number() over (partition by ms // 3600000 order by num desc, id) as rn from oms_sale) group by w""",
    "salt_keys": """select bucket, cast(sum(n) as bigint) as rows, count(*) as keys from (
        select lpad(cast(cast('0x' || substr(md5(cast(user_id as varchar)), 30, 3) as int) % 128 as varchar), 4, '0') as bucket, count(*) as n from ev group by user_id) group by bucket""",
    "calendar_features": """select uid, 2024 - year(birthday) - case when month(birthday) * 100 + day(birthday) > 630 then 1 else 0 end as age, year(birthday) // 10 * 10 as decade,
        case when d <= 119 then '摩羯座' when d <= 218 then '水瓶座' when d <= 320 then '双鱼座' when d <= 419 then '白羊座' when d <= 520 then '金牛座' when d <= 621 then '双子座'
          when d <= 722 then '巨蟹座' when d <= 822 then '狮子座' when d <= 922 then '处女座' when d <= 1023 then '天秤座' when d <= 1122 then '天蝎座' when d <= 1221 then '射手座'
          else '摩羯座' end as zodiac_sign, strftime(birthday, '%Y-%m-%d') as birthday from (select *, month(birthday) * 100 + day(birthday) as d from user_info)""",
    "reshape_details": """select event_id * 10 + n as id, event_id as order_id, (k + 7 * n) % 100 as sku_id, event_id % 4 + 1 as sku_num, cast(n * 5 as double) as split_coupon_amount,
        epoch_us(ts) // 1000 + n * 100000 as ts_ms from (select *, unnest(range(0, event_id % 3 + 1)) as n from ev where event_type = 'purchase')""",
    "parse_changes": """select db, "table", op, snapshot, count(*) as n, count(*) filter (where c < 4) as befores, count(*) filter (where c > 0) as afters, max(ts_ms) as last_ts_ms from (
        select 'shop' as db, "table", c, ['d','u','u','u','r','c','c','c','c','c'][c + 1] as op, case when c = 4 then 'true' else 'false' end as snapshot, ts_ms from (
          select 'order_info' as "table", o_orderkey % 10 as c, epoch_ms(cast(o_orderdate as timestamp)) + o_orderkey % 86400000 as ts_ms from orders
          union all select 'user_info', c_custkey % 10, 1704067200000 + c_custkey * 1000 from customer
          union all select 'base_category3', n_nationkey % 10, 1704067200000 + n_nationkey * 1000 from nation)) group by all""",
    "product_wide_joined": """select strftime(l.event_time, '%Y-%m-%d') as ds, l.shop_no as store_no, l.product_id, count(distinct l.user_id) as uv, count(*) as pv_cnt,
        count(distinct f.user_id) as favor_user_cnt, count(distinct c.user_id) as cart_user_cnt, cast(coalesce(sum(c.qty), 0) as bigint) as cart_quantity,
        count(distinct p.user_id) as pay_user_cnt, cast(coalesce(sum(p.qty), 0) as bigint) as pay_quantity, cast(coalesce(sum(p.unit_price * p.qty), 0) as double) as pay_amount
      from ods_logs l left join dim_favorite f on f.product_id = l.product_id and f.ds = l.ds
      left join dim_cart c on c.product_id = l.product_id and c.shop_no = l.shop_no and cast(c.add_time as date) = l.ds
      left join (select * from lines where status = 'PAID') p on p.product_id = l.product_id and p.shop_no = l.shop_no and cast(p.order_time as date) = l.ds group by all""",
    # listed words
    "word_counts": """
      select word, count(*) as texts from (select distinct doc_id, word from documents join (
        select word from (select unnest(list_distinct(regexp_split_to_array(lower(text), '[^a-z]+'))) as word, toxic from documents join labels using (doc_id))
        where length(word) >= 6 group by word having min(toxic) = 1) on contains(lower(text), word)) group by word""",
    # vehicles
    "trip_distance": """select vehicleno, day, round(coalesce(sum(m), 0), 0) as distance_m, count(*) filter (where m > 80000) as jumps, count(*) filter (where m < 1000) as idle_fixes from (
        select vehicleno, day, case when plon is not null then 2 * 6371008.8 * asin(sqrt(pow(sin(radians(lat - plat) / 2), 2) + cos(radians(plat)) * cos(radians(lat)) * pow(sin(radians(lon - plon) / 2), 2))) end as m
        from (select *, lag(lon) over w as plon, lag(lat) over w as plat from vehicle window w as (partition by vehicleno order by ms, id))) group by all""",
}


def complete(sql: str, views: str) -> str:
    """A query with common tables of its own takes the views into its list."""
    own = sql.strip()
    kind = "with recursive" if own.startswith("with recursive ") else "with"
    return f"{kind} {views}, {own.removeprefix(kind)}" if own.startswith("with ") else f"with {views} {own}"


ORACLES = {name: complete(sql, VIEWS) for name, sql in QUERIES.items()}
ORACLES |= {name: complete(sql, f"{VIEWS}, {oracles_rows.VIEWS}") for name, sql in oracles_rows.QUERIES.items()}
