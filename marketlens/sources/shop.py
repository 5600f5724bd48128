"""Shop tables derived from the generated star schema (FIXTURES.md, part B).

Every view is a lazy DataFrame over the whole table, so filters and column choices of a
report reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketlens.session import configure

PAGES = "array('app_launch','home_page','search','product_list','product_detail','add_cart','order_confirm','payment')"

# Fixed test mapping of part keys onto the brand and category names the score tables know.
BRANDS = "array('TCL','苹果','联想','小米','欧莱雅','香奈儿','其他')"
TOP_CATEGORIES = "array('数码','手机','家居家装','图书、音像、电子书刊','厨具','玩具乐器','珠宝')"
INTERESTS = "array('时尚与潮流','性价比','健康与养生','家庭与育儿','科技与数码','学习与发展','其他')"

LABEL_ROWS = 2_000_000  # labels that are sent to every task, some 70 bytes each


def shop_of(key: str) -> str:
    return f"concat('shop_', lpad(cast({key} % 20 as string), 3, '0'))"


class Shop:
    """Views of one folder of Parquet tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = str(folder).rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # ---- facts -----------------------------------------------------------------------
    def ev(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_id", "ts", "user_id", "event_type",
            "cast(value as decimal(12,2)) as value",
            "cast(get_json_object(props, '$.k') as bigint) as k",
        )

    def ods_logs(self) -> DataFrame:
        return self.ev().where("event_type = 'view'").selectExpr(
            "event_id as id", f"{shop_of('k')} as shop_no", "user_id", "k as product_id",
            "ts as event_time", "cast(floor(value) as bigint) as duration_seconds",
            "case when value < 5 then 1 else 0 end as is_bounce", "cast(ts as date) as ds",
        )

    def dim_favorite(self) -> DataFrame:
        return self.ev().where("event_type = 'signup'").selectExpr(
            "event_id as id", "user_id", "k as product_id", f"{shop_of('k')} as shop_no",
            "ts as favor_time", "cast(ts as date) as ds",
        )

    def dim_cart(self) -> DataFrame:
        return self.ev().where("event_type = 'click'").selectExpr(
            "event_id as id", "user_id", "k as product_id", f"{shop_of('k')} as shop_no",
            "event_id % 5 + 1 as qty", "value as cart_price", "ts as add_time", "cast(ts as date) as ds",
        )

    def order_info(self) -> DataFrame:
        return self.ev().where("event_type = 'purchase'").selectExpr(
            "event_id as id", "user_id", f"{shop_of('k')} as shop_no", "ts as order_time",
            """case when event_id % 10 between 4 and 8
                    then ts + make_dt_interval(0, 0, cast(event_id % 120 + 1 as int), 0) end as pay_time""",
            """case when event_id % 10 < 4 then 'CREATED' when event_id % 10 < 9 then 'PAID'
                    else 'CANCELLED' end as status""",
            "cast(ts as date) as ds",
        )

    def order_detail(self) -> DataFrame:
        lines = self.ev().where("event_type = 'purchase'").selectExpr(
            "*", "explode(sequence(0, cast(event_id % 3 as int))) as n"
        )
        return lines.selectExpr(
            "event_id * 10 + n as id", "event_id as order_id", "(k + 7 * n) % 100 as product_id",
            f"{shop_of('k')} as shop_no", "concat('color', cast(event_id % 6 as string)) as sku_color",
            "concat('size', cast(n as string)) as sku_size", "event_id % 4 + 1 as qty",
            "value as unit_price", "cast(value * (event_id % 4 + 1) as decimal(12,2)) as amount", "ts as create_time",
        )

    def ecommerce_data(self) -> DataFrame:
        return self.ev().selectExpr(
            "event_id", "user_id", "k as product_id", "k * 10 + event_id % 10 as sku_id", "ts as visit_time",
            """case event_type when 'signup' then 'collect' when 'click' then 'add_to_cart'
                    when 'purchase' then 'purchase' else 'visit' end as action""",
            "cast(value * 4 as decimal(12,2)) as price",
            """case event_id % 5 when 0 then 'direct' when 1 then 'search' when 2 then 'social'
                    when 3 then 'email' else 'ad' end as channel""",
            """case user_id % 3 when 0 then 'price_sensitive' when 1 then 'impulse_buyer'
                    else 'casual' end as user_type""",
            "event_id % 5 + 1 as rating",
        )

    def oms_sale(self) -> DataFrame:
        return self.ev().where("event_type = 'purchase'").selectExpr(
            "event_id as id", "k as product_id", "user_id", "cast(event_id % 9 + 1 as string) as sale_num",
            "cast(cast(value * (event_id % 9 + 1) as decimal(12,2)) as string) as total_amount", "ts as event_time",
        )

    def comment_info(self) -> DataFrame:
        """One comment per document, written by the user of the event of the same number."""
        return self.ev().join(
            self.table("documents").selectExpr("doc_id as event_id", "text"), "event_id"
        ).selectExpr(
            "event_id as id", "user_id", "k as sku_id", "event_id as order_id",
            "cast(event_id % 3 + 1 as string) as appraise",
            """case when event_id % 5 = 0 then concat_ws(',', text, try_element_at(
                    filter(split(lower(text), '[^a-z]+'), w -> length(w) >= 6), -1)) else text end as comment_txt""",
            "ts as create_time",
        )

    # ---- dimensions ------------------------------------------------------------------
    def nation_region(self) -> DataFrame:
        return self.table("nation").withColumnRenamed("n_regionkey", "r_regionkey").join(
            self.table("region"), "r_regionkey"
        )

    def category3(self) -> DataFrame:
        return self.table("nation").selectExpr(
            "n_nationkey as category3_id", "n_name as category3_name", "n_regionkey as category2_id"
        )

    def category2(self) -> DataFrame:
        return self.table("region").selectExpr(
            "r_regionkey as category2_id", "r_name as category2_name", "r_regionkey % 2 as category1_id"
        )

    def category1(self) -> DataFrame:
        return self.table("region").selectExpr(
            "r_regionkey % 2 as category1_id", "concat('C', cast(r_regionkey % 2 as string)) as category1_name"
        ).distinct()

    def sku_info(self) -> DataFrame:
        return self.table("part").selectExpr(
            "p_partkey as sku_id", "p_name as sku_name", "p_partkey % 50 as spu_id",
            "p_brand as tm_name", "cast(substr(p_brand, 7) as bigint) as tm_id", "p_partkey % 25 as category3_id",
            f"{shop_of('p_partkey')} as shop_no", "cast(p_retailprice as decimal(16,2)) as price",
        )

    def user_info(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "c_custkey as uid", "c_name as uname",
            "date_add(date '1960-01-01', cast(c_custkey * 37 % 16000 as int)) as birthday",
            "case c_custkey % 3 when 0 then 'M' when 1 then 'F' end as gender",
            "c_custkey % 3 + 1 as user_level",
        )

    def identity_numbers(self) -> DataFrame:
        """Invented numbers: some are cut short, some have month 13, most fail the check digit."""
        return self.user_info().selectExpr(
            "uid",
            """concat('110101', date_format(birthday, 'yyyy'),
                      case when uid % 17 = 0 then '13' else date_format(birthday, 'MM') end,
                      date_format(birthday, 'dd'), lpad(cast(uid % 1000 as string), 3, '0'),
                      substr('0123456789Xx', cast(uid % 12 as int) + 1, 1)) as full_number""",
        ).selectExpr("uid", "case when uid % 13 = 0 then substr(full_number, 1, 16) else full_number end as id_number")

    def ip_regions(self) -> DataFrame:
        return self.nation_region().selectExpr(
            "explode(array(n_nationkey, n_nationkey + 25)) as prefix_no", "r_name as province", "n_name as city"
        ).where("prefix_no < 30").selectExpr(
            "concat('10.', cast(prefix_no as string)) as ip_prefix", "province", "city"
        )

    # ---- logs ------------------------------------------------------------------------
    def page_log(self) -> DataFrame:
        """Flat page log; even rows carry epoch milliseconds, odd rows epoch seconds."""
        return self.ev().selectExpr(
            "event_id as log_id", "user_id",
            f"element_at({PAGES}, cast(event_id % 8 as int) + 1) as log_type",
            """case when event_id % 2 = 0 then unix_millis(cast(ts as timestamp))
                    else unix_seconds(cast(ts as timestamp)) end as ts""",
            "k as product_id", "case when event_id % 8 >= 6 then event_id end as order_id",
            "case when event_id % 8 = 2 then concat('word', cast(k % 40 as string)) end as keyword",
            "case when user_id % 2 = 0 then 'android' else 'ios' end as plat",
            "concat('brand', cast(user_id % 4 as string)) as brand",
            "cast(10 + user_id % 6 as string) as platv",
            "case k % 4 when 0 then 'wifi' when 1 then '5g' else '4g' end as net",
            "concat('10.', cast(user_id % 30 as string), '.0.', cast(k as string)) as ip",
        )

    def raw_log(self) -> DataFrame:
        """Nested page log as JSON text, some lines cut off."""
        doc = """to_json(named_struct(
            'common', named_struct(
                'uid', case when event_id % 11 = 0 then null else cast(user_id as string) end,
                'mid', concat('m', cast(user_id as string)), 'sid', cast(event_id as string),
                'is_new', case when event_id % 3 = 0 then '0' else '1' end,
                'os', case when user_id % 2 = 0 then 'Android 12' else 'iOS 16' end,
                'ch', concat('c', cast(k % 5 as string)), 'md', concat('md', cast(k % 7 as string)),
                'ba', concat('ba', cast(user_id % 4 as string))),
            'page', case when event_id % 8 = 0 then null else named_struct(
                'item', case when event_id % 8 = 2 then concat('word', cast(k % 40 as string)) else cast(k as string) end,
                'item_type', case when event_id % 8 = 2 then 'keyword' else 'sku_id' end) end,
            'start', case when event_id % 8 = 0 then named_struct('entry', 'icon', 'loading_time', k) end,
            'displays', case when event_id % 3 > 0 then transform(sequence(1, cast(event_id % 3 as int)),
                i -> named_struct('item', cast(k + i as string), 'pos', i)) end,
            'actions', case when event_id % 2 > 0 then array(named_struct('action_id', 'cart_add', 'item', cast(k as string))) end,
            'err', case when event_type = 'error' then named_struct('error_code', 1000 + k, 'msg', 'failed') end,
            'ts', unix_millis(cast(ts as timestamp))))"""
        return self.ev().selectExpr("event_id as log_id", f"{doc} as line").selectExpr(
            "log_id", "case when log_id % 97 = 0 then substr(line, 1, 20) else line end as line"
        )

    def vehicle(self) -> DataFrame:
        return self.ev().selectExpr(
            "event_id as id", "concat('V', cast(user_id as string)) as vehicleno",
            "100 + k * cast(0.01 as double) as lon", "20 + (event_id % 1000) * cast(0.001 as double) as lat",
            "date_format(ts, 'yyyyMMddHHmmss') as dateTime",
            "case when event_type = 'error' then 1 else 0 end as emergency_alarm", "k",
        )

    def vehicle_reports(self) -> DataFrame:
        """Vehicle messages as JSON: positions, and a registration for some ids."""
        doc = """case when id % 50 = 0
            then to_json(named_struct('vehicleno', vehicleno, 'upexgmsgregister', named_struct('platform', 'p1')))
            else to_json(named_struct('vehicleno', vehicleno, 'upexgmsgreallocation', named_struct(
                'lon', lon, 'lat', lat, 'dateTime', dateTime, 'direction', k,
                'vec1', case when k % 2 = 0 then k end, 'state', '0',
                'alarm', named_struct('emergencyAlarm', emergency_alarm)))) end"""
        return self.vehicle().selectExpr("id", f"{doc} as line")

    def vehicle_rules(self) -> DataFrame:
        """Rule 1: emergency flag. Rule 2: one plate of the watch list per row."""
        plates = self.table("nation").selectExpr("'2' as rule_type", "concat('V', cast(n_nationkey * 3 as string)) as vehicleno")
        flag = self.table("region").where("r_regionkey = 0").selectExpr("'1' as rule_type", "cast(null as string) as vehicleno")
        return plates.unionByName(flag)

    # ---- changes ---------------------------------------------------------------------
    def change_log(self) -> DataFrame:
        """One change topic for three tables, each record an envelope in JSON text."""
        def envelope(frame, table, db_row, key, ts):
            return frame.selectExpr(
                f"""to_json(named_struct(
                    'op', case {key} % 10 when 0 then 'd' when 1 then 'u' when 2 then 'u' when 3 then 'u'
                          when 4 then 'r' else 'c' end,
                    'ts_ms', {ts},
                    'source', named_struct('db', 'shop', 'table', '{table}',
                        'snapshot', case when {key} % 10 = 4 then 'true' else 'false' end),
                    'before', case when {key} % 10 in (0, 1, 2, 3) then {db_row} end,
                    'after', case when {key} % 10 <> 0 then {db_row} end)) as value"""
            )
        orders = envelope(
            self.table("orders"), "order_info",
            """named_struct('id', o_orderkey, 'user_id', o_custkey, 'status', o_orderstatus,
                'total_amount', cast(cast(o_totalprice as decimal(12,2)) as string))""",
            "o_orderkey", "unix_millis(cast(o_orderdate as timestamp)) + o_orderkey % 86400000")
        users = envelope(
            self.table("customer"), "user_info",
            """named_struct('id', c_custkey, 'name', c_name, 'user_level', c_custkey % 3 + 1,
                'birthday', c_custkey * 37 % 16000 - 3653, 'gender', case c_custkey % 3 when 0 then 'M' when 1 then 'F' end)""",
            "c_custkey", "1704067200000 + c_custkey * 1000")
        dims = envelope(
            self.table("nation"), "base_category3",
            "named_struct('id', n_nationkey, 'name', n_name, 'category2_id', n_regionkey)",
            "n_nationkey", "1704067200000 + n_nationkey * 1000L")
        return orders.unionAll(users).unionAll(dims)

    def routing_config(self) -> DataFrame:
        """Change records of the routing table: one row per region, two of them routed tables."""
        return self.table("region").selectExpr(
            "case r_regionkey when 0 then 'user_info' when 1 then 'base_category3' when 2 then 'user_info' "
            "when 3 then 'order_info' else 'order_info' end as source_table",
            "case r_regionkey when 0 then 'dim_user_old' when 1 then 'dim_category3' when 2 then 'dim_user' "
            "else 'dwd_order' end as sink_table",
            "'id' as sink_row_key", "'info' as sink_family",
            "case when r_regionkey = 4 then 'd' else 'c' end as op", "cast(r_regionkey as bigint) as ts_ms",
        )

    def code_names(self) -> DataFrame:
        """Code dictionary; appraise code 3 is left out on purpose."""
        return self.table("region").where("r_regionkey between 1 and 2").selectExpr(
            "cast(r_regionkey as string) as dic_code",
            "case r_regionkey when 1 then '好评' else '中评' end as dic_name")

    # ---- words -----------------------------------------------------------------------
    def block_words(self) -> DataFrame:
        """Words of documents labelled toxic that no document labelled clean contains.

        Up to ``LABEL_ROWS`` labels are sent to the documents, whose texts are then not shuffled.
        """
        labels = self.table("labels").select("doc_id", "toxic")
        if labels.count() <= LABEL_ROWS:
            labels = labels.hint("broadcast")
        tokens = self.table("documents").join(labels, "doc_id").selectExpr("toxic", "explode(array_distinct(split(lower(text), '[^a-z]+'))) as word").where("length(word) >= 6")
        return tokens.groupBy("word").agg({"toxic": "min"}).where("`min(toxic)` = 1").select("word")

    # ---- label job inputs ------------------------------------------------------------
    def label_categories(self) -> DataFrame:
        return self.table("nation").selectExpr(
            "n_nationkey as category3_id", "concat('word', cast(n_nationkey as string)) as category3_name",
            f"element_at({TOP_CATEGORIES}, n_nationkey % 7 + 1) as b1_name")

    def label_interests(self) -> DataFrame:
        return self.table("region").selectExpr(
            "r_regionkey as id", f"element_at({TOP_CATEGORIES}, r_regionkey + 1) as category_name",
            f"element_at({INTERESTS}, r_regionkey + 1) as search_category")

    def label_sku(self) -> DataFrame:
        return self.table("part").selectExpr(
            "p_partkey as sku_id", "p_name as sku_name", "cast(p_partkey % 25 as int) as category3_id",
            f"element_at({BRANDS}, cast(p_partkey % 7 as int) + 1) as tname")

    def label_orders(self) -> DataFrame:
        return self.ev().where("event_type = 'purchase'").selectExpr(
            "event_id as id", "user_id as uid", "concat('u', cast(user_id as string)) as consignee",
            "cast(value * 60 as decimal(12,2)) as total_amount", "ts as create_time",
            "unix_millis(cast(ts as timestamp)) as ts_ms")

    def label_details(self) -> DataFrame:
        """Lines written 0, 100 and 200 seconds after their order."""
        lines = self.ev().where("event_type = 'purchase'").selectExpr("*", "explode(sequence(0, cast(event_id % 3 as int))) as n")
        return lines.selectExpr(
            "event_id * 10 + n as id", "event_id as order_id", "(k + 7 * n) % 100 as sku_id", "event_id % 4 + 1 as sku_num",
            "cast(n * 5 as decimal(12,2)) as split_coupon_amount", "value as order_price",
            "unix_millis(cast(ts as timestamp)) + n * 100000 as ts_ms")

    def label_users(self) -> DataFrame:
        last = self.ev().groupBy("user_id").agg({"ts": "max"}).withColumnRenamed("max(ts)", "last_ts")
        return self.user_info().join(last.withColumnRenamed("user_id", "uid"), "uid").selectExpr(
            "uid", "uname", "user_level", "gender", "datediff(birthday, date '1970-01-01') as birthday",
            "unix_millis(cast(last_ts as timestamp)) as ts_ms")

    def label_bodies(self) -> DataFrame:
        """Body records written up to nine minutes after the user record."""
        return self.label_users().selectExpr(
            "uid", "cast(150 + uid % 40 as string) as height", "'cm' as unit_height",
            "cast(45 + uid % 50 as string) as weight", "'kg' as unit_weight", "ts_ms + (uid % 10) * 60000 as ts_ms")
