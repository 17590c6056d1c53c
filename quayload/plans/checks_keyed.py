"""Queries on published tables that are looked up by their keys, with their SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayload.plans.run import READERS, Run
from quayload.sinks.file_index import index_version, lookup_indexed
from quayload.sinks.publish import CURVE, Range, activate, lookup, publish_table, write_version
from quayload.spec import TableSpec

FIVE_KEYS = ("l_partkey", "l_orderkey", "l_suppkey", "l_shipdate", "l_returnflag")


def _asked(found: dict[str, DataFrame]) -> DataFrame:
    """The answers of several lookups, each with its name."""
    frames = [df.withColumn("looked_up", F.lit(name)) for name, df in found.items()]
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


def q_publish_keyed_curve(run: Run) -> DataFrame:
    """Lines with five keys along a curve: values and ranges of the first, the second, a time and a text."""
    keyed = TableSpec("sales", "lineitem", readers=READERS, keys=FIVE_KEYS)
    name = publish_table(run.table("lineitem"), keyed, run.area, layout=CURVE)
    spring = Range(datetime(1997, 3, 1), datetime(1997, 3, 20, 23, 59, 59, 999999))
    return _asked(
        {
            "part": lookup(run.spark, name, {"l_partkey": 77}),
            "order": lookup(run.spark, name, {"l_orderkey": 77}),
            "orders": lookup(run.spark, name, {"l_orderkey": Range(70, 99)}),
            "time": lookup(run.spark, name, {"l_shipdate": spring, "l_suppkey": Range(high=20)}),
            "flag": lookup(run.spark, name, {"l_returnflag": "R", "l_partkey": Range(10, 40)}),
        }
    )


def _indexed_lines(run: Run) -> str:
    keyed = TableSpec("sales", "lineitem", readers=READERS, keys=("l_partkey", "l_orderkey", "l_shipdate", "l_tax"))
    version = write_version(run.table("lineitem"), keyed, run.area)
    return activate(run.spark, index_version(run.spark, version))


def q_publish_file_index(run: Run) -> DataFrame:
    """Lines whose files are asked for in an index: by every key, by two, by a range, and for what isn't there."""
    name = _indexed_lines(run)
    return _asked(
        {
            "part": lookup_indexed(run.spark, name, {"l_partkey": 77}),
            "order": lookup_indexed(run.spark, name, {"l_orderkey": 77}),
            "both": lookup_indexed(run.spark, name, {"l_orderkey": Range(0, 400), "l_partkey": 77}),
            "day": lookup_indexed(run.spark, name, {"l_shipdate": datetime(1997, 3, 1)}),
            "tax": lookup_indexed(run.spark, name, {"l_tax": 0.02, "l_partkey": Range(high=5)}),
            "none": lookup_indexed(run.spark, name, {"l_orderkey": -1}),
        }
    )


def q_publish_keyed_lookup_time(run: Run) -> DataFrame:
    """Orders by a day and by a month, looked up by a session in another time zone."""
    keyed = TableSpec("sales", "orders", readers=READERS, keys=("o_orderdate", "o_custkey"))
    name = publish_table(run.table("orders"), keyed, run.area)
    abroad = run.spark.newSession()
    abroad.conf.set("spark.sql.session.timeZone", "Pacific/Auckland")
    month = Range(datetime(1997, 3, 1), datetime(1997, 3, 31, 23, 59, 59, 999999))
    return _asked(
        {
            "day": lookup(abroad, name, {"o_orderdate": datetime(1997, 5, 28)}),
            "month": lookup(abroad, name, {"O_ORDERDATE": month}),
            "later": lookup(abroad, name, {"o_orderdate": Range(low=datetime(2001, 7, 31)), "o_custkey": Range(0, 900)}),
        }
    )


CHECKS: dict[str, tuple[Callable[[Run], DataFrame], str]] = {
    "publish_keyed_curve": (
        q_publish_keyed_curve,
        """SELECT *, 'part' AS looked_up FROM lineitem WHERE l_partkey = 77
           UNION ALL SELECT *, 'order' FROM lineitem WHERE l_orderkey = 77
           UNION ALL SELECT *, 'orders' FROM lineitem WHERE l_orderkey BETWEEN 70 AND 99
           UNION ALL SELECT *, 'time' FROM lineitem
             WHERE l_shipdate >= TIMESTAMP '1997-03-01' AND l_shipdate < TIMESTAMP '1997-03-21' AND l_suppkey <= 20
           UNION ALL SELECT *, 'flag' FROM lineitem WHERE l_returnflag = 'R' AND l_partkey BETWEEN 10 AND 40""",
    ),
    "publish_file_index": (
        q_publish_file_index,
        """SELECT *, 'part' AS looked_up FROM lineitem WHERE l_partkey = 77
           UNION ALL SELECT *, 'order' FROM lineitem WHERE l_orderkey = 77
           UNION ALL SELECT *, 'both' FROM lineitem WHERE l_orderkey BETWEEN 0 AND 400 AND l_partkey = 77
           UNION ALL SELECT *, 'day' FROM lineitem WHERE l_shipdate = TIMESTAMP '1997-03-01'
           UNION ALL SELECT *, 'tax' FROM lineitem WHERE l_tax = 0.02::DOUBLE AND l_partkey <= 5
           UNION ALL SELECT *, 'none' FROM lineitem WHERE l_orderkey = -1""",
    ),
    "publish_keyed_lookup_time": (
        q_publish_keyed_lookup_time,
        """SELECT *, 'day' AS looked_up FROM orders WHERE o_orderdate = TIMESTAMP '1997-05-28'
           UNION ALL SELECT *, 'month' FROM orders
             WHERE o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1997-04-01'
           UNION ALL SELECT *, 'later' FROM orders
             WHERE o_orderdate >= TIMESTAMP '2001-07-31' AND o_custkey BETWEEN 0 AND 900""",
    ),
}
