"""Motor-racing views over the landed TPC-H-style tables.

The lap log, weather log and qualifying sheet are derived from the given
tables so that every job's work grows with them:

  driver = supplier, team = the supplier's nation, round = quarter of the
  ship date, session = line number (1 Q, 2 FP1, 3 FP2, else R), lap time =
  extended price; weather samples are orders (time = order date).

Each view exists twice: as DataFrame code for Spark and as SQL text for the
DuckDB oracle. Both must produce identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.operators.rank import number_rows
from pitwall.sources.tables import read_table

LAP_PARTITION = ["year", "round", "session_type", "driver"]
_ORDER_HELPERS = ["ship", "ok", "ln", "pk", "qty", "price", "disc", "tax", "rf", "ls"]


def _days_into_quarter(ts) -> F.Column:
    day = F.to_date(ts)
    return F.datediff(day, F.trunc(day, "quarter"))


def lap_view(spark: SparkSession, sf_dir: str, number: bool = True) -> DataFrame:
    """One row per lap with lap_number numbered inside each driver-session (without
    it, and without a shuffle, if not ``number``)."""
    li = read_table(spark, sf_dir, "lineitem")
    su = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    ln = F.col("l_linenumber")
    price = F.col("l_extendedprice")
    base = li.join(su, li.l_suppkey == su.s_suppkey).select(
        F.year("l_shipdate").cast("int").alias("year"),
        F.quarter("l_shipdate").cast("int").alias("round"),
        F.when(ln == 1, "Q").when(ln == 2, "FP1").when(ln == 3, "FP2").otherwise("R").alias(
            "session_type"
        ),
        F.col("l_suppkey").alias("driver"),
        F.col("s_nationkey").alias("team"),
        price.alias("lap_time"),
        F.when(F.col("l_discount") > 0.095, F.lit(""))
        .otherwise(
            F.concat(
                F.floor(price / 60).cast("int").cast("string"),
                F.lit(":"),
                F.lpad((F.floor(price).cast("int") % 60).cast("string"), 2, "0"),
            )
        )
        .alias("lap_time_text"),
        F.when(F.col("l_tax") > 0.075, F.lit(None).cast("string"))
        .otherwise(F.col("l_returnflag"))
        .alias("compound"),
        F.when(F.col("l_quantity") > 45, F.lit(None).cast("double"))
        .otherwise(F.col("l_quantity"))
        .alias("position"),
        F.when(ln == 7, F.lit(None).cast("int")).otherwise((ln - 3).cast("int")).alias(
            "track_status"
        ),
        F.when(F.col("l_linestatus") == "O", 1).otherwise(0).alias("rainfall"),
        (F.col("l_tax") < 0.08).alias("is_accurate"),
        (_days_into_quarter("l_shipdate") * 86400).cast("double").alias("start_time"),
        F.col("l_shipdate").alias("ship"),
        F.col("l_orderkey").alias("ok"),
        ln.alias("ln"),
        F.col("l_partkey").alias("pk"),
        F.col("l_quantity").alias("qty"),
        price.alias("price"),
        F.col("l_discount").alias("disc"),
        F.col("l_tax").alias("tax"),
        F.col("l_returnflag").alias("rf"),
        F.col("l_linestatus").alias("ls"),
    )
    if not number:
        return base.drop(*_ORDER_HELPERS)
    # row_number per driver-session; a session holding more laps than one
    # task should window is numbered by the distributed path (rank.number_rows)
    numbered = number_rows(
        base, LAP_PARTITION, [F.col(c) for c in _ORDER_HELPERS], "lap_number", drop=tuple(_ORDER_HELPERS)
    )
    return numbered.withColumn("lap_number", F.col("lap_number").cast("int"))


def weather_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather samples per race session; one order is one sample."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.year("o_orderdate").cast("int").alias("year"),
        F.quarter("o_orderdate").cast("int").alias("round"),
        F.lit("R").alias("session_type"),
        (_days_into_quarter("o_orderdate") * 86400).cast("double").alias("time"),
        F.col("o_orderkey").alias("sample_id"),
        (F.col("o_totalprice") / 1000.0).alias("air_temp"),
        (F.col("o_totalprice") / 500.0).alias("track_temp"),
        (F.col("o_custkey") % 100).cast("double").alias("humidity"),
        ((F.col("o_orderkey") % 30).cast("double") / 2).alias("wind_speed"),
        (F.col("o_orderstatus") == "F").alias("rainfall"),
    )


def sheet_view(laps: DataFrame) -> DataFrame:
    """Qualifying sheets as a CSV would hold them: q1..q3 as lap-time text of
    the driver's first three Q laps, start_grid as text of the lap-1 position."""
    q = laps.filter(F.col("session_type") == "Q")
    lap = F.col("lap_number")
    return q.groupBy("year", "round", "driver").agg(
        F.max(F.when(lap == 1, F.col("lap_time_text"))).alias("q1"),
        F.max(F.when(lap == 2, F.col("lap_time_text"))).alias("q2"),
        F.max(F.when(lap == 3, F.col("lap_time_text"))).alias("q3"),
        F.max(F.when(lap == 1, F.col("position"))).cast("string").alias("start_grid"),
    )


# --------------------------------------------------------------------------
# The same views as DuckDB SQL (common table expressions for the oracle).
# --------------------------------------------------------------------------
LAPS_CTE = """laps as (
select t.* exclude (ship, ok, ln, pk, qty, price, disc, tax, rf, ls),
       cast(row_number() over (partition by year, round, session_type, driver
            order by ship, ok, ln, pk, qty, price, disc, tax, rf, ls) as int) as lap_number
from (
  select cast(year(l_shipdate) as int) as year, cast(quarter(l_shipdate) as int) as round,
         case l_linenumber when 1 then 'Q' when 2 then 'FP1' when 3 then 'FP2' else 'R' end as session_type,
         l_suppkey as driver, s_nationkey as team, l_extendedprice as lap_time,
         case when l_discount > 0.095 then ''
              else concat(cast(cast(floor(l_extendedprice / 60) as int) as varchar), ':',
                          lpad(cast(cast(floor(l_extendedprice) as int) % 60 as varchar), 2, '0')) end as lap_time_text,
         case when l_tax > 0.075 then null else l_returnflag end as compound,
         case when l_quantity > 45 then null else l_quantity end as position,
         case when l_linenumber = 7 then null else cast(l_linenumber - 3 as int) end as track_status,
         case when l_linestatus = 'O' then 1 else 0 end as rainfall,
         l_tax < 0.08 as is_accurate,
         cast(date_diff('day', date_trunc('quarter', cast(l_shipdate as date)), cast(l_shipdate as date)) * 86400 as double) as start_time,
         l_shipdate as ship, l_orderkey as ok, l_linenumber as ln, l_partkey as pk, l_quantity as qty,
         l_extendedprice as price, l_discount as disc, l_tax as tax, l_returnflag as rf, l_linestatus as ls
  from lineitem join supplier on l_suppkey = s_suppkey) t)"""

WEATHER_CTE = """weather as (
select cast(year(o_orderdate) as int) as year, cast(quarter(o_orderdate) as int) as round,
       'R' as session_type,
       cast(date_diff('day', date_trunc('quarter', cast(o_orderdate as date)), cast(o_orderdate as date)) * 86400 as double) as time,
       o_orderkey as sample_id,
       o_totalprice / 1000.0 as air_temp, o_totalprice / 500.0 as track_temp,
       cast(o_custkey % 100 as double) as humidity,
       cast(o_orderkey % 30 as double) / 2 as wind_speed,
       o_orderstatus = 'F' as rainfall
from orders)"""

SHEET_CTE = """sheet as (
select year, round, driver,
       max(case when lap_number = 1 then lap_time_text end) as q1,
       max(case when lap_number = 2 then lap_time_text end) as q2,
       max(case when lap_number = 3 then lap_time_text end) as q3,
       cast(max(case when lap_number = 1 then position end) as varchar) as start_grid
from laps where session_type = 'Q' group by year, round, driver)"""
