"""Queries on counts, shares, bins and components."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from panelweave.operators import summary
from panelweave.plans.analysis import frequency_tables
from panelweave.suite import fixtures as fx
from panelweave.suite.registry import query

_PANEL = fx.with_tables("panel")


@query("count_by_type", _PANEL + "SELECT type, count(*) AS n FROM panel GROUP BY 1")
def count_by_type(spark, folder):
    return summary.count_by(fx.panel(spark, folder), "type")


@query(
    "count_by_type_source", _PANEL + "SELECT type, source, count(*) AS n FROM panel GROUP BY 1, 2"
)
def count_by_type_source(spark, folder):
    return summary.count_by(fx.panel(spark, folder), "type", "source")


@query(
    "count_sorted",
    _PANEL + "SELECT type, count(*) AS n FROM panel GROUP BY 1 ORDER BY n DESC, type NULLS LAST",
)
def count_sorted(spark, folder):
    return summary.count_sorted(fx.panel(spark, folder), "type")


@query("count_year_type", _PANEL + "SELECT day, type, count(*) AS n FROM panel GROUP BY 1, 2")
def count_year_type(spark, folder):
    return summary.count_by(fx.panel(spark, folder), "day", "type")


@query(
    "share_of_total",
    _PANEL
    + """SELECT type, n, CAST(n AS DOUBLE) / (sum(n) OVER ())::DOUBLE * 100 AS prop
         FROM (SELECT type, count(*) AS n FROM panel WHERE type IS NOT NULL GROUP BY 1)""",
)
def share_of_total(spark, folder):
    known = fx.panel(spark, folder).filter(F.col("type").isNotNull())
    return summary.share_of_total(summary.count_by(known, "type"))


@query(
    "share_within_year",
    _PANEL
    + """SELECT day, type, n,
           CAST(n AS DOUBLE) / (sum(n) OVER (PARTITION BY day))::DOUBLE * 100 AS prop
         FROM (SELECT day, type, count(*) AS n FROM panel WHERE type IS NOT NULL GROUP BY 1, 2)""",
)
def share_within_year(spark, folder):
    known = fx.panel(spark, folder).filter(F.col("type").isNotNull())
    return summary.share_within(summary.count_by(known, "day", "type"), ["day"])


_PARTS = """SELECT l_orderkey, l_returnflag, CAST(year(l_shipdate) AS INTEGER) AS yr,
  CASE WHEN l_tax > 0 THEN l_quantity END AS percent FROM lineitem"""


def _parts(spark, folder):
    return fx.table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_returnflag",
        F.year("l_shipdate").alias("yr"),
        F.when(F.col("l_tax") > 0, F.col("l_quantity")).alias("percent"),
    )


_PART_KEY = ["l_orderkey", "yr", "l_returnflag"]


@query(
    "component_max",
    f"""SELECT l_orderkey, yr, l_returnflag, max(percent) AS component_max FROM ({_PARTS})
        GROUP BY ALL""",
)
def component_max(spark, folder):
    return summary.component_max(_parts(spark, folder), _PART_KEY, "percent")


@query(
    "component_sum",
    f"""SELECT l_orderkey, yr, l_returnflag, coalesce(sum(percent), 0) AS component_sum
        FROM ({_PARTS}) GROUP BY ALL""",
)
def component_sum(spark, folder):
    return summary.component_sum(_parts(spark, folder), _PART_KEY, "percent")


BREAKS = [1, 3, 6, 20, math.inf]
CLOSED_BREAKS = [1, 2, 4]
_OPEN_BIN = """CASE WHEN n >= 1 AND n < 3 THEN '1 to <3' WHEN n >= 3 AND n < 6 THEN '3 to <6'
    WHEN n >= 6 AND n < 20 THEN '6 to <20' WHEN n >= 20 THEN '20 or more' ELSE 'No Data' END"""
_CLOSED_BIN = """CASE WHEN n >= 1 AND n < 2 THEN '1 to <2' WHEN n >= 2 AND n <= 4 THEN '2 to 4'
    ELSE 'No Data' END"""
_SINCE = """SELECT o_custkey, count(*) AS n FROM orders
  WHERE o_orderdate >= TIMESTAMP '1999-01-01' AND o_orderstatus = 'F' GROUP BY 1"""


def _frequency(spark, folder, breaks):
    orders = fx.table(spark, folder, "orders").withColumnRenamed("o_custkey", "iso3")
    base = fx.table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    keep = (F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz")) & (
        F.col("o_orderstatus") == "F"
    )
    return frequency_tables(orders, base, keep, breaks, base_key="c_custkey")


@query(
    "entity_frequency_all",
    f"""SELECT c_custkey, c_mktsegment, n, {_OPEN_BIN} AS bin
        FROM customer LEFT JOIN ({_SINCE}) ON o_custkey = c_custkey""",
)
def entity_frequency_all(spark, folder):
    return _frequency(spark, folder, BREAKS)[0]


@query(
    "frequency_top10",
    f"SELECT o_custkey AS iso3, n FROM ({_SINCE}) ORDER BY n DESC, iso3 LIMIT 10",
)
def frequency_top10(spark, folder):
    return _frequency(spark, folder, BREAKS)[1]


@query(
    "bin_entity_counts",
    f"""SELECT bin, count(*) AS n_entities FROM (SELECT {_CLOSED_BIN} AS bin
          FROM customer LEFT JOIN ({_SINCE}) ON o_custkey = c_custkey) GROUP BY 1""",
)
def bin_entity_counts(spark, folder):
    binned, _ = _frequency(spark, folder, CLOSED_BREAKS)
    return binned.groupBy("bin").agg(F.count("*").alias("n_entities"))
