"""DuckDB queries for reports on changes, raw logs, labels, comments, words and identity numbers.

The second half of ``oracles``: further views over the tables and further queries, written row by
row from each report's rule.
"""

from __future__ import annotations

from marketlens.functions.columns import ALLOWED_TEXT
from marketlens.functions.identity import CHECK_CHARACTERS, DIGITS, ID_PATTERN, LITERAL_PLACES, WEIGHTS
from marketlens.plans import labels
from marketlens.sources.shop import BRANDS, INTERESTS, TOP_CATEGORIES


def part_of_day(ts: str) -> str:
    return (f"case when hour({ts}) < 6 then '凌晨' when hour({ts}) < 9 then '早晨' when hour({ts}) < 12 then '上午' when hour({ts}) < 14 then '中午' "
            f"when hour({ts}) < 18 then '下午' when hour({ts}) < 22 then '晚上' else '夜间' end")


def listed(values: str) -> str:
    return values.replace("array(", "[").replace(")", "]")


def last_comma(text: str) -> str:
    return rf"string_split(regexp_replace({text}, ',+(\n?)$', '\1'), ',')[-1]"


AGE = "2024 - year(birthday) - case when month(birthday) * 100 + day(birthday) > 630 then 1 else 0 end"
SIGN = """case when d <= 119 then '摩羯座' when d <= 218 then '水瓶座' when d <= 320 then '双鱼座' when d <= 419 then '白羊座' when d <= 520 then '金牛座' when d <= 621 then '双子座'
  when d <= 722 then '巨蟹座' when d <= 822 then '狮子座' when d <= 922 then '处女座' when d <= 1023 then '天秤座' when d <= 1122 then '天蝎座' when d <= 1221 then '射手座' else '摩羯座' end"""

VIEWS = f"""
changes as (
  select 'shop' as db, tbl, c, ['d','u','u','u','r','c','c','c','c','c'][c + 1] as op, ts_ms, id, uid, status, amount from (
    select 'order_info' as tbl, o_orderkey % 10 as c, epoch_ms(cast(o_orderdate as timestamp)) + o_orderkey % 86400000 as ts_ms, o_orderkey as id, o_custkey as uid,
      o_orderstatus as status, cast(cast(o_totalprice as decimal(12,2)) as double) as amount from orders
    union all select 'user_info', c_custkey % 10, 1704067200000 + c_custkey * 1000, c_custkey, null, null, null from customer
    union all select 'base_category3', n_nationkey % 10, 1704067200000 + n_nationkey * 1000, n_nationkey, null, null, null from nation)),
raw as (
  select event_id as log_id, event_id % 97 = 0 as broken, case when event_id % 11 > 0 then cast(user_id as varchar) end as uid, 'm' || user_id as mid,
    case when event_id % 3 = 0 then '0' else '1' end as is_new, case when user_id % 2 = 0 then 'Android' else 'iOS' end as os, 'c' || (k % 5) as ch, 'md' || (k % 7) as md,
    'ba' || (user_id % 4) as ba, case when event_id % 8 = 2 then 'word' || (k % 40) when event_id % 8 > 0 then cast(k as varchar) end as item,
    case when event_id % 8 = 2 then 'keyword' when event_id % 8 > 0 then 'sku_id' end as item_type, event_id % 8 = 0 as started, event_id % 3 as displays,
    event_id % 2 > 0 as acted, event_type = 'error' as failed, k, epoch_us(ts) // 1000 as ms, user_id from ev),
pages as (select log_id, coalesce(uid, '-1') as uid, ms as ts, os, ch, md, ba, case when item_type = 'keyword' then item end as search_item from raw where not broken),
stopped as (
  select word from (select unnest(list_distinct(regexp_split_to_array(lower(text), '[^a-z]+'))) as word, toxic from documents join labels using (doc_id))
  where length(word) >= 6 group by word having min(toxic) = 1),
said as (
  select id, user_id, appraise, create_time, case when id % 5 = 0 then concat_ws(',', text, list_filter(regexp_split_to_array(lower(text), '[^a-z]+'), lambda w: length(w) >= 6)[-1])
    else text end as comment_txt from comment_info),
flagged as (select id, user_id, comment_txt, coalesce({last_comma('comment_txt')} in (select word from stopped), false) as hit from said),
last_seen as (select user_id as uid, max(epoch_us(ts) // 1000) as ts_ms from ev group by user_id),
people as (select u.*, ts_ms, month(birthday) * 100 + day(birthday) as d from user_info u join last_seen using (uid)),
bodies as (select uid, cast(150 + uid % 40 as varchar) as height, cast(45 + uid % 50 as varchar) as weight, ts_ms + uid % 10 * 60000 as ts_ms from people),
known as (
  select p.uid, uname, coalesce(gender, 'home') as gender, strftime(birthday, '%Y-%m-%d') as birthday, {AGE} as age, year(birthday) // 10 * 10 as decade, {SIGN} as zodiac_sign,
    height, weight, p.ts_ms from people p join bodies b on b.uid = p.uid and b.ts_ms between p.ts_ms - 300000 and p.ts_ms + 300000),
top_of as (select n_nationkey as category3_id, 'word' || n_nationkey as word, {listed(TOP_CATEGORIES)}[n_nationkey % 7 + 1] as b1_name from nation),
interest_of as (select {listed(TOP_CATEGORIES)}[r_regionkey + 1] as category_name, {listed(INTERESTS)}[r_regionkey + 1] as search_category from region),
buys as (
  select event_id * 10 + n as detail_id, event_id as id, user_id as uid, (k + 7 * n) % 100 as sku_id, event_id % 4 + 1 as sku_num, {part_of_day('ts')} as pay_time_slot,
    cast(n * 5 as double) as split_coupon_amount, epoch_us(ts) // 1000 as ts_ms, cast(value * 60 as decimal(12,2)) as total_amount, 'u' || user_id as consignee
  from (select *, unnest(range(0, event_id % 3 + 1)) as n from ev where event_type = 'purchase') where n * 100 <= 120),
bought as (
  select buys.*, tname, b1_name, case when total_amount < 1000 then '低消费' when total_amount > 1000 and total_amount < 4000 then '中消费' else '高消费' end as spending_pow
  from buys left join (select p_partkey as sku_id, p_partkey % 25 as category3_id, {listed(BRANDS)}[p_partkey % 7 + 1] as tname from part) using (sku_id) left join top_of using (category3_id)),
once as (select distinct uid, ts, os, ch, md, ba, search_item from pages),
searched as (select uid, string_agg(search_item, ',' order by ms, search_item) as search_item from (
  select uid, search_item, min(ts) as ms from once where search_item is not null group by all) group by uid),
log_profile as (
  select uid, count(*) as pv, string_agg(distinct os, ',' order by os) as os, string_agg(distinct ch, ',' order by ch) as ch, string_agg(distinct md, ',' order by md) as md,
    string_agg(distinct ba, ',' order by ba) as ba, arg_max(search_item, ts) filter (where search_item is not null) as last_search, max(ts) as ts_ms from once group by uid),
surfed as (
  select uid, ts_ms, string_split(os, ',')[1] as judge_os, coalesce(search_category, 'unknown') as search_category from log_profile
  left join (select word, min(b1_name) as b1_name from top_of group by word) w on w.word = last_search left join interest_of i on i.category_name = w.b1_name where uid <> '-1'),
events_of as (select user_id, stat_date, log_id, ms, log_type, keyword, order_id, product_id, plat, brand, platv, net, hour(make_timestamp(ms * 1000)) as h from page_log)
"""


def score(value: str, table: dict[str, list[float]], weight: float, band: int, other: float = 0.0) -> str:
    known = " ".join(f"when {value} = '{name}' then {scores[band]}" for name, scores in table.items())
    return f"round(cast(case when {value} is null then 0 {known} else {other} end * {weight} as double), 3)"


def scores(name: str, value: str, table: dict[str, list[float]], other: list[float] | None = None) -> dict[str, str]:
    return {f"{name}_{band}": score(value, table, labels.WEIGHTS[name], n, (other or [0.0] * 6)[n]) for n, band in enumerate(labels.BANDS)}


LOG_SCORES = {**scores("device", "judge_os", labels.DEVICE_SCORES), **scores("search", "search_category", labels.SEARCH_SCORES)}
LINE_SCORES = {
    **scores("pay_time", "pay_time_slot", labels.PAY_TIME_SCORES), **scores("amount", "spending_pow", labels.AMOUNT_SCORES),
    **scores("tname", "tname", labels.BRAND_SCORES, labels.OTHER_BRAND), **scores("b1name", "b1_name", labels.CATEGORY_SCORES, labels.OTHER_CATEGORY)}


def columns(found: dict[str, str]) -> str:
    return ", ".join(f"{sql} as {name}" for name, sql in found.items())


def summed(literal: bool = False) -> str:
    """Log and order scores of one user within six hours, with their sums per band."""
    def parts(band):
        if literal and band in ("25_29", "30_34"):
            return ["b1name", "amount", "tname", "pay_time"]
        if literal and band in ("35_39", "40_49"):
            return ["device", "search"]
        return ["b1name", "amount", "tname", "pay_time", "device", "search"]
    sums = ", ".join(f"round({' + '.join(f'{p}_{b}' for p in parts(b))}, 3) as sum_{b}" for b in labels.BANDS)
    return f"""select b.detail_id, b.uid, b.ts_ms, consignee, spending_pow, {sums} from (select *, {columns(LINE_SCORES)} from bought) b
      join (select cast(uid as bigint) as uid, ts_ms, {columns(LOG_SCORES)} from surfed) s on s.uid = b.uid and b.ts_ms between s.ts_ms - 21600000 and s.ts_ms + 21600000"""


TOP_SUM = "greatest(" + ", ".join(f"sum_{b}" for b in labels.BANDS) + ")"
BEST = f"case when {TOP_SUM} > 0 then case " + " ".join(f"when sum_{b} = {TOP_SUM} then '{b}'" for b in labels.BANDS) + " end end"


def digit(n: str) -> str:
    return f"substr('{DIGITS}', cast({n} as int) + 1, 1)"


def below_ten_thousand(n: str) -> str:
    """Numerals of 1 to 9999: a zero is read before the next digit that is none."""
    a, b, c, d = (f"(({n}) // {p} % 10)" for p in (1000, 100, 10, 1))
    return (f"concat(case when {a} > 0 then {digit(a)} || '仟' end, case when {b} > 0 then {digit(b)} || '佰' end, "
            f"case when {c} > 0 then case when {b} = 0 and {a} > 0 then '零' else '' end || {digit(c)} || '拾' end, "
            f"case when {d} > 0 then case when {c} = 0 and {a} + {b} > 0 then '零' else '' end || {digit(d)} end)")


def in_words(cents: str) -> str:
    """Amounts below a hundred million."""
    yuan, jiao, fen = f"(({cents}) // 100)", f"(({cents}) // 10 % 10)", f"(({cents}) % 10)"
    high, low = f"({yuan} // 10000)", f"({yuan} % 10000)"
    return (f"case when {cents} = 0 then '零元整' else concat(case when {high} > 0 then {below_ten_thousand(high)} || '万' end, "
            f"case when {low} > 0 then case when {high} > 0 and {low} < 1000 then '零' else '' end || {below_ten_thousand(low)} end, case when {yuan} > 0 then '元' end, "
            f"case when ({cents}) % 100 = 0 then '整' else concat(case when {jiao} > 0 then {digit(jiao)} || '角' when {yuan} > 0 then '零' end, "
            f"case when {fen} > 0 then {digit(fen)} || '分' end) end) end")


def in_words_literal(cents: str) -> str:
    yuan, jiao, fen = f"(({cents}) // 100)", f"(({cents}) // 10 % 10)", f"(({cents}) % 10)"
    places = "[" + ", ".join(f"'{p}'" for p in LITERAL_PLACES) + "]"
    at = f"({yuan} // cast(10 ** i as bigint) % 10)"
    lower = f"({yuan} // cast(10 ** (i - 1) as bigint) % 10)"
    return (f"concat(array_to_string(list_transform(range(15, -1, -1), lambda i: case when {at} > 0 then {digit(at)} || {places}[i + 1] || "
            f"case when i > 0 and {lower} = 0 then '零' else '' end else '' end), ''), case when ({cents}) % 100 = 0 then '元整' else concat('元', "
            f"case when {jiao} > 0 then {digit(jiao)} || '角' end, case when {fen} > 0 then {digit(fen)} || '分' end) end)")


NUMBERS = """(select uid, case when uid % 13 = 0 then substr(n, 1, 16) else n end as id_number from (
      select uid, '110101' || strftime(birthday, '%Y') || case when uid % 17 = 0 then '13' else strftime(birthday, '%m') end || strftime(birthday, '%d') || lpad(cast(uid % 1000 as varchar), 3, '0')
        || substr('0123456789Xx', cast(uid % 12 as int) + 1, 1) as n from user_info))"""
VERDICT = f"""case when length(id_number) <> 18 then '无效长度' when not regexp_matches(id_number, '{ID_PATTERN}') then '格式错误'
    when substr('{CHECK_CHARACTERS}', cast(list_sum(list_transform(range(1, 18), lambda i: cast(substr(id_number, cast(i as int), 1) as int) * {WEIGHTS}[i])) % 11 as int) + 1, 1)
      <> substr(id_number, 18, 1) then '校验码错误' else '有效身份证' end"""

DAY = "strftime(make_timestamp(({}) * 1000), '%Y-%m-%d')"


def moderated(found: str) -> str:
    return f"""
      with hits as (select id, string_agg(word, ', ' order by strpos(lower(comment_txt), word), word) as words from ({found}) group by id)
      select id, user_id, cast(hit as bigint) as is_violation, case when hit then 'P0' when words is not null then 'P1' else '' end as violation_grade,
        case when hit then {last_comma('comment_txt')} else coalesce(words, '') end as violation_msg from flagged left join hits using (id)"""


def slot(low: int, high: int, name: str, hour: str) -> str:
    return f"count(*) filter (where {hour} >= {low} and {hour} < {high}) as {name}"


SLOTS = [(6, 12, "morning_6_12"), (12, 18, "afternoon_12_18"), (18, 24, "evening_18_24"), (0, 6, "night_0_6")]
FULLEST = "greatest(morning_6_12, afternoon_12_18, evening_18_24, night_0_6)"
PRIMARY = f"case {FULLEST} when morning_6_12 then 'morning' when afternoon_12_18 then 'afternoon' when evening_18_24 then 'evening' else 'night' end"

PROFILES = f"""
  with base as (
    select user_id, count(distinct stat_date) as login_days_count, string_agg(distinct stat_date, ',' order by stat_date) as login_dates,
      coalesce(string_agg(distinct stat_date, ',' order by stat_date) filter (where log_type = 'search' and keyword is not null), '') as search_days,
      coalesce(string_agg(distinct stat_date, ',' order by stat_date) filter (where log_type = 'payment' or (log_type = 'order_confirm' and order_id is not null)), '') as purchase_days,
      coalesce(string_agg(distinct stat_date, ',' order by stat_date) filter (where log_type in ('product_detail', 'product_list')), '') as browse_days,
      {", ".join(slot(low, high, name, 'h') for low, high, name in SLOTS)},
      count(distinct order_id) filter (where log_type in ('payment', 'order_confirm')) as order_count,
      count(distinct product_id) filter (where log_type in ('product_detail', 'product_list')) as browsed_products_count,
      count(distinct keyword) filter (where log_type = 'search' and trim(keyword) <> '') as search_keyword_count,
      arg_min(brand, (ms, log_id)) as brand, arg_min(plat, (ms, log_id)) as plat, arg_min(platv, (ms, log_id)) as platv from events_of group by user_id),
  words as (
    select user_id, string_agg(keyword, ',' order by n desc, keyword) as top_search_keywords from (
      select user_id, keyword, count(*) as n, row_number() over (partition by user_id order by count(*) desc, keyword) as rn from events_of
      where log_type = 'search' and trim(keyword) <> '' group by user_id, keyword) where rn <= 10 group by user_id),
  nets as (select user_id, string_agg(net || '=' || n, ',' order by net) as network_types from (select user_id, net, count(*) as n from events_of where net is not null group by all) group by user_id),
  full_ as (select *, {PRIMARY} as primary_time_slot, login_days_count * 2 + order_count * 10 + browsed_products_count + search_keyword_count as points
    from base left join words using (user_id) left join nets using (user_id)),
  profiles as (select * exclude (points, top_search_keywords, network_types), coalesce(top_search_keywords, '') as top_search_keywords, coalesce(network_types, '') as network_types,
    concat_ws(',', case when login_days_count >= 7 then '高频用户' when login_days_count >= 3 then '活跃用户' else '低频用户' end,
      case when purchase_days <> '' then '已转化' else '潜在用户' end, case when purchase_days <> '' and order_count >= 3 then '高价值用户' end,
      case when search_days <> '' then '有搜索意图' end, case when browsed_products_count >= 10 then '高浏览用户' end, primary_time_slot || '活跃') as user_tags,
    case when points >= 100 then 'VIP' when points >= 50 then '高级' when points >= 20 then '中级' else '普通' end as user_level from full_)
"""

QUERIES = {
    # changes
    "flatten_changes": 'select tbl as "table", op, ts_ms, id from changes',
    "table_changes": "select op, ts_ms, id, uid as user_id, status, amount as total_amount from changes where tbl = 'order_info'",
    "change_filter": f"""select tbl as "table", {DAY.format('ts_ms')} as stat_date, count(*) as n from changes where op in ('c', 'u') group by all""",
    "snapshot_rows": 'select tbl as "table", id from changes where c = 4',
    "reshape_users": f"""select uid, uname, user_level, coalesce(gender, 'home') as gender, strftime(birthday, '%Y-%m-%d') as birthday, {AGE} as age, year(birthday) // 10 * 10 as decade,
        {SIGN} as zodiac_sign, 1704067200000 + uid * 1000 as ts_ms from (select *, month(birthday) * 100 + day(birthday) as d from user_info)""",
    "reshape_cart": f"""select id, cast(uid as varchar) as user_id, ts_ms, replace({DAY.format('ts_ms')}, '-', '') as ds from changes where tbl = 'order_info' and op in ('c', 'u')""",
    "route_changes": """select case tbl when 'user_info' then 'dim_user' else 'dim_category3' end as sink_table, md5(cast(id as varchar)) as row_key, ts_ms
      from changes where c > 0 and tbl in ('user_info', 'base_category3')""",
    # rows
    "generate_rows": "select s_suppkey, unnest(range(1, s_suppkey % 5 + 2)) as n from supplier",
    "write_day_buckets": "select case when event_id % 29 = 0 then 'error_bucket' else 'day=' || strftime(ts, '%Y%m%d') end as day, count(*) as n from ev group by all",
    "shop_bucket": """select product_id, order_id, cast(qty as bigint) as qty, 'SHOP_' || (row_number() over (partition by product_id order by order_id) % 10 + 1) as shop_id
      from (select product_id, order_id, sum(qty) as qty from order_detail group by all)""",
    "string_functions": rf"""select doc_id, length(regexp_replace(text, '[0-9]+', '#', 'g')) as masked_length, concat_ws('-', lang, source) as tag, md5({last_comma('text')}) as last_part_md5,
        case when text is null or trim(text, ' ') = '' then 1 else 0 end as blank, cast(regexp_matches(source, '{ALLOWED_TEXT}') as bigint) as allowed from documents""",
    "date_functions": """select event_id, strftime(ts, '%Y-%m-%d %H:00:00') as hour_key, strftime(ts, '%Y%m%d') as ds, epoch_us(ts) // 1000 as ms, strftime(ts, '%Y-%m-%d %H:%M:%S') as text_time,
        strftime(cast(ts as date) - 30, '%Y-%m-%d') as month_before from ev""",
    "time_slots": f"select *, {PRIMARY} as primary_time_slot from (select user_id, {', '.join(slot(low, high, name, 'hour(ts)') for low, high, name in SLOTS)} from ev group by user_id)",
    "reshape_orders": f"""select event_id as id, user_id as uid, 'u' || user_id as consignee, cast(cast(value * 60 as decimal(12,2)) as double) as total_amount, {part_of_day('ts')} as pay_time_slot,
        epoch_us(ts) // 1000 as ts_ms from ev where event_type = 'purchase'""",
    # the raw page log
    "has_keys": """select case when not broken and uid is not null then 1 else 0 end as keyed, case when not broken and item is not null then 1 else 0 end as worded, count(*) as n from raw group by all""",
    "json_functions": """select log_id, coalesce(uid, '-1') as uid, coalesce(item, '') as item, displays, case when failed then cast(1000 + k as varchar) else '' end as error_code from raw where not broken""",
    "reshape_page_log": "select * from pages",
    "split_log": """
      select log_id, 'dirty' as kind, left('{"common":{' || case when uid is null then '' else '"uid":"' || uid || '",' end || '"mid":"' || mid || '","sid":"' || log_id, 20) as detail, -1 as ts from raw where broken
      union all select log_id, 'err', cast(1000 + k as varchar), ms from raw where not broken and failed
      union all select log_id, 'start', 'icon', ms from raw where not broken and started
      union all select log_id, 'display', cast(k + i as varchar), ms from (select *, unnest(range(1, displays + 1)) as i from raw where not broken and not started)
      union all select log_id, 'action', cast(k as varchar), ms from raw where not broken and not started and acted
      union all select log_id, 'page', item_type, ms from raw where not broken and not started""",
    "repair_is_new": f"""
      with firsts as (select mid, arg_min(case when is_new = '1' then ms else ms - 86400000 end, (ms, log_id)) as first_ms from raw where not broken group by mid)
      select log_id, mid, case when is_new = '1' and {DAY.format('ms')} <> {DAY.format('first_ms')} then '0' else is_new end as is_new, ms as ts from raw join firsts using (mid) where not broken""",
    "drop_repeats": f"select distinct uid, os, ch, md, ba, {DAY.format('ts')} as day from pages",
    # joins
    "merge_columns": """select policy, p.uid, case when policy = 'right' then height else uname end as uname, case when policy = 'prefix' then height else weight end as extra
      from people p join bodies using (uid), (select unnest(['right', 'prefix', 'select']) as policy)""",
    "search_interest": """select log_id, keyword as search_item, coalesce(b1_name, '') as b1_category, coalesce(search_category, 'unknown') as search_category from page_log
      left join (select word, min(b1_name) as b1_name from top_of group by word) on word = keyword left join interest_of on category_name = b1_name where keyword is not null""",
    "vehicle_alarms": """select id, vehicleno, 'emergency' as alarm_kind from vehicle where id % 50 <> 0 and event_type = 'error'
      union all select id, vehicleno, 'vehicleno' from vehicle where vehicleno in (select 'V' || (n_nationkey * 3) from nation)""",
    "flatten_vehicle": """select event_id as id, 'V' || user_id as vehicleno, case when p then round(100 + k * cast(0.01 as double), 4) end as lon,
        case when p then round(20 + (event_id % 1000) * cast(0.001 as double), 4) end as lat, case when not p then '-' when k % 2 = 0 then cast(k as varchar) else '' end as vec1,
        case when p then '' else '-' end as vec2, case when p then strftime(ts, '%Y%m%d') else '99991231' end as ds, case when p then epoch_us(ts) // 1000000 * 1000 - 28800000 else -1 end as ts,
        case when not p then -1 when event_type = 'error' then 1 else 0 end as emergency_alarm from (select *, event_id % 50 <> 0 as p from ev)""",
    "word_flag": "select id, cast(hit as bigint) as is_violation from flagged",
    "word_semi": "select id from flagged where hit",
    "join_reports": """select s.sku_id, coalesce(pay_num, 0) as pay_num, (select count(distinct user_id) from behaviour b where kind = 'favor' and b.sku_id = s.sku_id) as inter_favor_num,
        (select count(distinct user_id) from behaviour b where kind = 'cart' and b.sku_id = s.sku_id) as inter_cart_num, coalesce(d.id, -1) as detail_id, coalesce(d.qty, 0) as line_qty
      from sku_info s left join (select sku_id, cast(sum(sku_num) as bigint) as pay_num from trade group by sku_id) t using (sku_id) left join order_detail d on d.product_id = s.sku_id""",
    "comment_facts": f"""select s.id, s.user_id, case appraise when '1' then '好评' when '2' then '中评' else 'N/A' end as dic_name, 'u' || e.user_id as info_consignee,
        epoch_us(e.ts) // 1000 + e.event_id % 100 * 1000 as info_ts_ms, md5(comment_txt) as text_md5, strftime(create_time, '%Y%m%d') as ds
      from said s join ev e on e.event_id = s.id and e.event_type = 'purchase' and e.event_id % 100 <= 60""",
    # reports
    "product_full_metrics": """
      with visits as (select strftime(event_time, '%Y-%m-%d') as ds, shop_no as store_no, product_id, user_id, count(*) as n, epoch_us(max(event_time)) // 1000000 - epoch_us(min(event_time)) // 1000000 as stay
          from ods_logs group by all),
      seen as (select ds, store_no, product_id, count(*) as sku_uv, cast(sum(n) as bigint) as sku_pv, round(cast(sum(stay) as double) / count(*), 4) as avg_stay_seconds,
          round(cast(count(*) filter (where n = 1) as double) / count(*), 4) as detail_page_bounce_rate from visits group by all),
      paid as (select strftime(order_time, '%Y-%m-%d') as ds, shop_no as store_no, product_id, user_id, qty, unit_price * qty as paid from lines where status = 'PAID'),
      bands as (select ds, store_no, product_id, case when paid between 0 and 99 then '0-99' when paid between 100 and 199 then '100-199' when paid between 200 and 499 then '200-499'
          when paid between 500 and 999 then '500-999' else '1000+' end as price_range, cast(sum(qty) as bigint) as q, cast(sum(paid) as double) as a from paid group by all),
      fav as (select strftime(favor_time, '%Y-%m-%d') as ds, shop_no as store_no, product_id, count(distinct user_id) as favor_user_cnt from dim_favorite group by all),
      cart as (select strftime(add_time, '%Y-%m-%d') as ds, shop_no as store_no, product_id, count(distinct user_id) as cart_user_cnt, cast(sum(qty) as bigint) as cart_quantity from dim_cart group by all),
      pays as (select ds, store_no, product_id, count(distinct user_id) as pay_user_cnt, cast(sum(qty) as bigint) as pay_quantity, cast(sum(paid) as double) as pay_amount from paid group by all)
      select ds, store_no, product_id, sku_uv, sku_pv, 1 as active_product_cnt, avg_stay_seconds, detail_page_bounce_rate, coalesce(favor_user_cnt, 0) as favor_user_cnt,
        coalesce(cart_user_cnt, 0) as cart_user_cnt, coalesce(cart_quantity, 0) as cart_quantity, round(cast(coalesce(cart_user_cnt, 0) as double) / sku_uv, 4) as cart_conversion_rate,
        round(cast(coalesce(favor_user_cnt, 0) as double) / sku_uv, 4) as favor_conversion_rate, coalesce(pay_user_cnt, 0) as pay_user_cnt, coalesce(pay_quantity, 0) as pay_quantity,
        coalesce(pay_amount, 0) as pay_amount, case when pay_user_cnt is null then 0 else 1 end as pay_product_cnt, round(cast(coalesce(pay_user_cnt, 0) as double) / sku_uv, 4) as pay_conversion_rate,
        coalesce(price_range, '') as price_range, coalesce(q, 0) as price_range_pay_quantity, coalesce(a, 0) as price_range_pay_amount
      from seen left join fav using (ds, store_no, product_id) left join cart using (ds, store_no, product_id) left join pays using (ds, store_no, product_id)
      left join bands using (ds, store_no, product_id)""",
    "cumulative_process": """
      select strftime(make_timestamp(day * 1000), '%Y-%m-%d %H:%M:%S') as window_start, strftime(make_timestamp(ends * 1000), '%Y-%m-%d %H:%M:%S') as window_end, 0 as part,
        string_agg(id || '(' || amount || ')', '+' order by ms, id) as step_process, count(*) as item_count,
        cast((select sum(amount) from oms_sale o where o.ms >= s.day and o.ms < s.ends) as double) as period_amount
      from (select *, ms // 86400000 * 86400000 as day, (ms // 600000 + 1) * 600000 as ends from oms_sale) s group by day, ends""",
    "session_restarts": """
      with recursive times as (select distinct user_id, stat_date, ms from page_log where user_id is not null),
      starts as (
        select user_id, stat_date, min(ms) as ms, 0 as n from times group by user_id, stat_date
        union all
        select s.user_id, s.stat_date, min(t.ms), s.n + 1 from starts s join times t on t.user_id = s.user_id and t.stat_date = s.stat_date and t.ms > s.ms + 1800000 group by s.user_id, s.stat_date, s.n)
      select user_id, stat_date, ms as session_start from starts where n > 0""",
    "user_profiles": f"{PROFILES} select * from profiles",
    "profile_daily_summary": f"""{PROFILES} select user_id, login_days_count as total_login_days, order_count as total_orders, browsed_products_count as total_browsed_products,
        search_keyword_count as total_search_keywords, user_level from profiles""",
    # labels
    "user_log_profile": """select p.uid, pv, os, ch, md, ba, coalesce(last_search, '') as last_search, ts_ms, 0 as part, coalesce(s.search_item, '') as search_item
      from log_profile p left join searched s using (uid)""",
    "device_search_scores": f"select uid, judge_os, search_category, {columns(LOG_SCORES)} from surfed",
    "order_facts": "select detail_id, id, uid, sku_id, sku_num, pay_time_slot, split_coupon_amount, ts_ms from buys",
    "order_scores": f"select detail_id, spending_pow, tname, b1_name, {columns(LINE_SCORES)} from bought",
    "base_profile": "select uid, uname, gender, birthday, age, decade, zodiac_sign, height, weight, ts_ms from known",
    "score_sums": f"select detail_id, uid, {', '.join(f'sum_{b}' for b in labels.BANDS)} from ({summed()})",
    "score_sums_literal": f"select detail_id, uid, {', '.join(f'sum_{b}' for b in labels.BANDS)} from ({summed(literal=True)})",
    "best_band": f"select detail_id, coalesce({BEST}, '') as calculate_age, case when {TOP_SUM} > 0 then {TOP_SUM} else 0 end as calculate_score from ({summed()})",
    "user_labels": f"""select s.uid, detail_id, consignee, age, zodiac_sign, height, spending_pow, {BEST} as calculate_age, replace({DAY.format('s.ts_ms')}, '-', '') as ds
      from ({summed()}) s join known k on k.uid = s.uid and k.ts_ms between s.ts_ms - 21600000 and s.ts_ms + 21600000""",
    # moderation
    "moderate": moderated("select id, comment_txt, word from flagged join stopped on contains(lower(comment_txt), word)"),
    "moderate_tokens": moderated(r"""select id, comment_txt, word from (select id, comment_txt, unnest(list_distinct(regexp_split_to_array(lower(comment_txt), '[^\p{L}]+'))) as word from flagged)
      where word in (select word from stopped)"""),
    # quality
    "id_audit": f"""select uid, id_number, {VERDICT} as verdict, case when try_strptime(substr(id_number, 7, 8), '%Y%m%d') is not null then 1 else 0 end as real_birth_date from {NUMBERS}""",
    "id_audit_counts": f"select {VERDICT} as verdict, count(*) as n from {NUMBERS} group by all",
    "amount_words": f"""select order_id, cast(total as double) as total, {in_words('cast(total * 100 as bigint)')} as amount_words
      from (select order_id, sum(amount) as total from order_detail group by order_id)""",
    "amount_words_literal": f"""select order_id, cast(total as double) as total, {in_words_literal('cast(total * 100 as bigint)')} as amount_words
      from (select order_id, sum(amount) as total from order_detail group by order_id)""",
    "sql_functions": f"select uid, {VERDICT} as verdict, {in_words('(uid * 125)')} as words from {NUMBERS}",
}
