"""The shop's tables derived from the generic order, customer and event tables.

The SQL text is understood by Spark and by DuckDB, so both sides of a check
start from the same rows. Braces hold the name of a given table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillgrid.functions.codes import DIRECT_COURIER
from tillgrid.operators.ads import ads_clean

GIVEN = ["orders", "lineitem", "customer", "nation", "events"]

VIEWS = {
    "shipment": """
select o_orderkey as id, o_custkey as user_id,
  concat('ON', cast(cast(floor(o_orderkey / 2) as bigint) as string)) as order_number,
  case o_orderpriority when '1-URGENT' then 'SHIPPING' when '2-HIGH' then 'SHIPPING_COMPLETE'
    when '3-MEDIUM' then 'READY_SHIPMENT'
    when '4-NOT SPECIFIED' then case o_orderkey % 4 when 0 then 'PAYMENT'
      when 1 then 'CANCEL_REQUEST' when 2 then 'PENDING' else 'NOT_LISTED' end
    else case o_orderkey % 3 when 0 then 'DELETE' when 1 then 'CANCEL' else 'SHIPPING' end
    end as status,
  case when o_orderstatus = 'F' then '{courier}' else 'POST' end as courier,
  o_orderdate as order_dated_at,
  case when o_orderkey % 13 = 0 then null else cast((o_orderkey % 5) * 1000 as bigint) end
    as delivery_price
from {orders}""",
    "shipment_item": """
select l_orderkey as shipment_id,
  case when l_partkey % 31 = 0 then 'NOT_LISTED' when l_returnflag = 'R' then 'CANCEL'
    else 'ORDER' end as item_status,
  case l_linestatus when 'O' then 'TAX' else 'FREE' end as tax_type,
  cast(floor(5 * l_extendedprice / l_quantity) as bigint) as price,
  cast(floor(5 * l_extendedprice / l_quantity) as bigint) + (l_linenumber - 2) * 50
    as list_price,
  cast(l_quantity as bigint) as quantity,
  cast(floor(l_extendedprice) as bigint) as supply_price,
  case when l_partkey % 19 = 0 then null else cast(l_linenumber * 100 as bigint) end
    as coupon_discount_amount,
  case when l_partkey % 23 = 0 then null else cast((l_partkey % 10) * 100 as bigint) end
    as use_point,
  case when l_partkey % 17 = 0 then 1 else 0 end as is_deleted,
  case when l_partkey % 29 = 0 then null else l_shipdate end as entering_dated_at
from {lineitem}""",
    "user_account": """
select c.c_custkey as base_user_id, m.created_at,
  case c.c_custkey % 4 when 0 then concat('#A', cast(c.c_custkey as string))
    when 1 then concat('u', cast(c.c_custkey as string))
    when 2 then concat('u-', cast(c.c_custkey as string)) else null end as recommender_username,
  case when c.c_custkey % 10 = 0 then 'y' else 'n' end as deleted_yn,
  concat('CO', cast(cast(floor(c.c_custkey / 2) as bigint) as string)) as company_name
from (select c_custkey from {customer}
  union all select c_custkey from {customer} where c_custkey % 20 = 1) c
left join (
  select o_custkey, min(o_orderdate) as created_at from {orders} group by o_custkey) m
  on m.o_custkey = c.c_custkey""",
    "base_user": "select c_custkey as id from {customer}",
    "user_business_type_code": """
select c_custkey as base_user_id, cast(c_nationkey as bigint) as business_type_codes
from {customer}
union all
select c_custkey, cast((c_nationkey + 3) % 25 as bigint) from {customer}
where c_mktsegment = 'MACHINERY'""",
    "business_type": "select cast(n_nationkey as bigint) as id, n_name as name from {nation}",
    # The running sums are over one row per day. Two weeks have no snapshot, and
    # every seventeenth day has one without a count.
    "dashboard_user": """
select concat(cast(d as string), ' 00:00:00') as period_date, 'DAILY' as period_type, new_count,
  cast(sum(new_count) over (order by d) as bigint) as ok_total_count,
  case when day(d) = 17 then null else cast(sum(direct) over (order by d) as bigint) end
    as ok_direct_count,
  cast(sum(new_count - direct) over (order by d) as bigint) as ok_parcel_count
from (select cast(o_orderdate as date) as d, count(*) as new_count,
        cast(sum(case when o_orderstatus = 'F' then 1 else 0 end) as bigint) as direct
      from {orders} group by cast(o_orderdate as date)) x
where not d between date '1996-03-04' and date '1996-03-17'""",
    "direct_shipping": """
select ts as created_at, case when event_id % 4 = 0 then 1 else 0 end as is_deleted
from {events}""",
    "point": """
select user_id,
  case event_type when 'error' then 'USED' when 'view' then 'EXPIRED' else 'REWARD' end
    as event_type,
  case event_id % 12 when 0 then 'ORDER' when 1 then 'NONE' when 2 then 'ORDER_CANCEL'
    when 3 then 'DY' when 4 then 'NOT_LISTED'
    when 5 then case when day(ts) between 8 and 14 then 'EVENT' else 'JOINED' end
    when 6 then 'MAKE_UP' when 7 then 'EXPIRED' when 8 then 'FIRST_ORDER_EVENT' when 9 then 'REFERRAL_MEMBER'
    when 10 then 'FIRST_ORDER_REFERRED' else 'SHIPMENT_DATE_OPTIONS_EVENT' end as reason_type,
  cast(round(value * 100) as bigint) as amount, ts as created_at
from {events}""",
    "ad_raw": """
select cast(cast(ts as date) as string) as date,
  case when cast(min(event_id) as bigint) % 7 = 0 then '#VALUE!' when min(event_id) % 7 = 1 then ''
    else cast(sum(case when event_type = 'signup' then 1 else 0 end) as string)
    end as total_signups,
  concat('1,', substr(cast(1000 + count(*) as string), 2, 3)) as total_cost,
  cast(sum(case when event_type = 'purchase' then 1 else 0 end) as string) as total_conversions,
  concat(cast(cast(floor(sum(value)) as bigint) % 900 as string), '%') as total_roas
from {events} group by cast(ts as date)""",
}


def view_text(name: str) -> str:
    """SQL of a view, with braces left around the given tables alone."""
    return VIEWS[name].replace("{courier}", DIRECT_COURIER)


def given_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


class DemoTables(dict):
    """The views over a folder of given tables, each built when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__()
        self.spark, self._folder = spark, folder

    def __missing__(self, name: str) -> DataFrame:
        if name == "ads":
            self[name] = ads_clean(self["ad_raw"])
            return self[name]
        text = view_text(name)
        used = {
            table: given_table(self.spark, self._folder, table)
            for table in GIVEN
            if "{" + table + "}" in text
        }
        self[name] = self.spark.sql(text, **used)
        return self[name]


def duckdb_views(*names: str) -> str:
    """``name as (...)`` items for a WITH clause over the given tables."""
    plain = {table: table for table in GIVEN}
    return ",\n".join(f"{name} as ({view_text(name).format(**plain)})" for name in names)
