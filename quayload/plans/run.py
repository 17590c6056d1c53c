"""What the queries of the registry share: a folder of their own, the given tables, and addresses made of them."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayload.functions.text import point_wkt
from quayload.operators.enrich import AddressLookup, prepare_lookup
from quayload.sinks.publish import ServingArea
from quayload.spec import TableSpec, quote
from quayload.staging import read_staged, stage_table
from quayload.workspace import new_area

READERS = ("reader_a", "reader_b")


@dataclass(frozen=True)
class Run:
    """A query's own folder and database prefix, so that runs never meet."""

    spark: SparkSession
    sf_dir: str
    root: str
    mark: str

    @classmethod
    def start(cls, spark: SparkSession, sf_dir: str, label: str) -> Run:
        return cls(spark, sf_dir, new_area(spark, label), f"q{uuid.uuid4().hex[:12]}")

    @property
    def area(self) -> ServingArea:
        return ServingArea(f"{self.root}/served", f"{self.mark}_")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def mount(self, schema: str, name: str) -> TableSpec:
        """Make a given table visible as ``gis_<schema>.<name>`` in the session catalog."""
        spec = TableSpec(f"{schema}_{self.mark}", name, readers=READERS)
        database = quote(spec.source_schema)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{self.root}/mounted'")
        self.spark.catalog.createTable(
            f"{database}.{quote(name)}", path=f"{self.sf_dir}/{name}.parquet", source="parquet"
        )
        return spec

    def round_trip(self, name: str) -> DataFrame:
        spec = TableSpec("given", name)
        stage_table(self.table(name), spec, self.root)
        return read_staged(self.spark, spec, self.root)

    def addresses(self) -> DataFrame:
        """Customers with a messy street address; one market segment has none."""
        house = F.floor(F.col("c_acctbal") / 1000).cast("string")
        street = F.concat(
            F.lit("  "), house, F.lit(",  "), F.lower("n_name"), F.lit(" -- st. ")
        )
        nation = self.table("nation").select("n_nationkey", "n_name")
        return (
            self.table("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .withColumn("street_address", F.when(F.col("c_mktsegment") != "MACHINERY", street))
            .drop("n_nationkey", "n_name")
        )

    def lookup(self) -> AddressLookup:
        """Suppliers as an address reference; several share an address."""
        nation = self.table("nation").select("n_nationkey", "n_name")
        lat, lon = F.col("s_acctbal") / 1000, -F.col("s_acctbal") / 2000
        reference = (
            self.table("supplier")
            .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.floor(F.col("s_acctbal") / 1000).cast("string").alias("house"),
                F.concat("n_name", F.lit(" ST")).alias("street"),
                F.col("s_suppkey").alias("address_id"),
                lat.alias("lat"),
                lon.alias("lon"),
                point_wkt(lon, lat).alias("shape"),
            )
        )
        fields = ("lat", "lon", "shape")
        path = f"{self.root}/lookup"
        return prepare_lookup(reference, ["house", "street"], fields, "address_id", path)
