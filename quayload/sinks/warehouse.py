"""Load a staged table into a warehouse mounted as a Spark catalog.

A relational warehouse is mounted with Spark's JDBC catalog, see
:func:`jdbc_catalog_conf`. Tasks of a JDBC write commit one by one, and a task
that ran twice may have written its rows twice. So the rows go into a side
table first; only if its row count is right does it take the table's name.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quayload.spec import LOADING, PREVIOUS, TableSpec, is_working_name, quote, working_name

#: Property of side tables in the session catalog.
MARK = "quayload.side_table"
JDBC_CATALOG = "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog"


class IncompleteLoad(RuntimeError):
    """The side table does not have the rows it should have."""


def jdbc_catalog_conf(
    catalog: str, url: str, driver: str, properties: Mapping[str, str]
) -> dict[str, str]:
    """Session settings that mount a relational database as ``catalog``.

    Keep credentials in ``properties``: Spark redacts ``password`` in its own
    listings, while a password inside the URL would be shown. Writes open a
    connection per partition: set ``numPartitions`` to what the database bears,
    and ``batchsize`` to a few thousand rows.
    """
    base = f"spark.sql.catalog.{catalog}"
    options = {"url": url, "driver": driver, **properties}
    return {base: JDBC_CATALOG, **{f"{base}.{name}": value for name, value in options.items()}}


def _name(spec: TableSpec, catalog: str | None, table: str | None = None) -> tuple[str, str]:
    """The full name with the catalog, and the name within it that renames use."""
    inner = f"{quote(spec.warehouse_schema)}.{quote(table or spec.table)}"
    return (f"{quote(catalog)}.{inner}" if catalog else inner), inner


def side_tables(spark: SparkSession, spec: TableSpec, catalog: str | None, kind: str) -> list[str]:
    """Side tables of this table, by the exact form of their names and, in the session catalog, by their mark."""
    schema = _name(spec, catalog)[0].rsplit(".", 1)[0]
    listed = spark.sql(f"SHOW TABLES IN {schema}").where("NOT isTemporary").collect()
    names = [row.tableName for row in listed if is_working_name(row.tableName, spec.table, kind)]
    if catalog:
        return names
    return [name for name in names if _marked(spark, _name(spec, None, name)[0])]


def _marked(spark: SparkSession, name: str) -> bool:
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    return any(row.key == MARK for row in rows)


def drop_leftovers(spark: SparkSession, spec: TableSpec, catalog: str | None = None) -> list[str]:
    """Drop side tables of loads that never finished; returns their names.

    A table moved aside is dropped only when there is one with its name again:
    until then it is the table. Call this only when no load of this table runs:
    a load in flight has such tables too.
    """
    names = side_tables(spark, spec, catalog, LOADING)
    if spark.catalog.tableExists(_name(spec, catalog)[0]):
        names += side_tables(spark, spec, catalog, PREVIOUS)
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {_name(spec, catalog, name)[0]}")
    return names


def _undo_swap(spark: SparkSession, spec: TableSpec, catalog: str | None) -> None:
    """Give the name back to the table that a load cut short has moved aside."""
    aside = side_tables(spark, spec, catalog, PREVIOUS)
    if len(aside) > 1:
        raise IncompleteLoad(f"{spec.table} is gone and there are several to restore: {', '.join(aside)}")
    for name in aside:
        spark.sql(f"ALTER TABLE {_name(spec, catalog, name)[0]} RENAME TO {_name(spec, catalog)[1]}")


def load_table(df: DataFrame, spec: TableSpec, catalog: str | None = None) -> str:
    """Replace the warehouse table with ``df``; returns its full name.

    The schema must exist; digit-only schema names are spelled out. Nothing but
    the table itself and this load's own side tables is touched. A swap cut
    short by a lost driver is undone by the next load: the previous table is
    kept until the new one has its name.
    """
    spark = df.sparkSession
    target, target_inner = _name(spec, catalog)
    # The names are new each time: a failed write may leave files at its place.
    loading, _ = _name(spec, catalog, working_name(spec.table, LOADING))
    previous, previous_inner = _name(spec, catalog, working_name(spec.table, PREVIOUS))
    if not spark.catalog.tableExists(target):
        _undo_swap(spark, spec, catalog)

    counted = Observation()
    writer = df.observe(counted, F.count(F.lit(1)).alias("rows")).writeTo(loading)
    if not catalog:  # databases take no properties of ours
        writer = writer.tableProperty(MARK, spec.table)
    try:
        writer.create()
        loaded, expected = spark.table(loading).count(), counted.get["rows"]
        if loaded != expected:
            raise IncompleteLoad(f"{target}: {loaded} rows loaded, {expected} expected")
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {loading}")
        raise

    replaces = spark.catalog.tableExists(target)
    if replaces:
        if not catalog:
            spark.sql(f"ALTER TABLE {target} SET TBLPROPERTIES ('{MARK}' = 'previous')")
        spark.sql(f"ALTER TABLE {target} RENAME TO {previous_inner}")
    spark.sql(f"ALTER TABLE {loading} RENAME TO {target_inner}")
    if replaces:
        spark.sql(f"DROP TABLE IF EXISTS {previous}")
    return target
