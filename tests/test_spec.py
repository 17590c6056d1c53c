from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quayload.functions.text import compose_query_key, point_wkt, spell_digits
from quayload.spec import TEST, TableSpec, load_specs, spec_from_config, spell_schema_name
from quayload.workspace import new_area, workspace_root


@pytest.mark.parametrize(
    ("source", "environment"),
    [("latest", "production"), ("contest_db", "production"), ("app-test", "test"), ("test_app", "test"), ("app_Test", "test")],
)
def test_the_environment_is_a_whole_word(source, environment):
    assert spec_from_config("s", "t", {"knack_conn_id": source}).environment == environment


def test_names_and_paths():
    spec = TableSpec("schema", "table")
    assert spec.staging_path == "staging/schema/table.csv"
    assert spec.sidecar_path == "schemas/schema/table.json"
    assert spec.source_schema == "gis_schema"
    assert spec.warehouse_schema == "schema"


def test_digit_schema_is_spelled_only_in_the_warehouse():
    spec = TableSpec("311", "table")
    assert spec.warehouse_schema == "threeoneone"
    assert spec.staging_path == "staging/311/table.csv"
    assert spec.sidecar_path == "schemas/311/table.json"
    with pytest.raises(ValueError):
        spell_schema_name("10")


def test_test_environment_is_kept_apart():
    spec = TableSpec("ppr", "days", environment=TEST)
    assert spec.target_schema == "ppr_test"
    assert spec.staging_path == "staging/ppr_test/days.csv"
    assert spec.source_schema == "gis_ppr"
    with pytest.raises(ValueError):
        TableSpec("ppr", "days", environment="staging")
    with pytest.raises(ValueError):
        TableSpec("", "days")


def test_configs_become_specs(tmp_path):
    relational = tmp_path / "relational" / "311"
    records = tmp_path / "records" / "first" / "ppr"
    relational.mkdir(parents=True)
    records.mkdir(parents=True)
    (relational / "cases.yml").write_text(
        "schedule_interval: 15 6 * * *\nupload_to_carto: true\nupload_to_ago:\n"
        "carto_users:\n  - reader\n  - tiles\nindexes:\n  - status\n  - opened\n"
    )
    (relational / "zones.yml").write_text(
        "schedule_interval: false # manual\nupload_to_carto: false\ncarto_users:\n  - reader\n"
    )
    (records / "days.yml").write_text(
        "upload_to_carto: true\ncarto_users:\n  - reader\nknack_object_id: 25\n"
        "knack_conn_id: knack_test\ncarto_conn_id: first"
    )
    cases, zones = load_specs(tmp_path / "relational")
    assert cases == TableSpec("311", "cases", True, ("reader", "tiles"), ("status", "opened"))
    assert zones == TableSpec("311", "zones", False, ("reader",))
    (days,) = load_specs(tmp_path / "records")
    assert days == TableSpec("ppr", "days", True, ("reader",), environment=TEST, object_id=25, target="first")


def test_spell_digits_column(spark):
    names = ["311", "10", "0", "lni", "3a", "", None, "12\n", "٣"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    spelled = dict(df.select("name", spell_digits(F.col("name"))).collect())
    assert spelled == {
        "311": "threeoneone", "10": None, "0": None, "lni": "lni", "3a": "3a", "": "",
        None: None, "12\n": "12\n", "٣": "٣",
    }


def test_compose_query_key(spark):
    rows = [
        ("1234 Market St.", None, "1234 MARKET ST"),
        ("  1234  market-st", "#5", "1234 MARKET ST 5"),
        (None, "x", "X"),
        ("--", " ", None),
        (None, None, None),
    ]
    df = spark.createDataFrame(rows, "a string, `b.c` string, expected string")
    for row in df.withColumn("key", compose_query_key(["a", "b.c"])).collect():
        assert row.key == row.expected
    with pytest.raises(ValueError):
        compose_query_key([])


def test_point_wkt(spark):
    df = spark.createDataFrame([(-75.1635262, 39.9527237), (None, 1.0)], "lon double, lat double")
    points = [row[0] for row in df.select(point_wkt(F.col("lon"), F.col("lat"))).collect()]
    assert points == ["POINT (-75.163526 39.952724)", None]


def test_workspace_is_the_shared_folder(spark):
    assert workspace_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_area(spark, "a") != new_area(spark, "a")
    assert new_area(spark, "a").startswith(workspace_root(spark))


class Conf:
    def __init__(self, **values):
        self.conf = self
        self.values = {key.replace("_", "."): value for key, value in values.items()}

    def get(self, key, default=None):
        return self.values.get(key, default)


def test_workspace_on_a_cluster_must_be_named():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace_root(Conf(spark_master="yarn"))
    assert workspace_root(Conf(spark_master="local[2]")) == workspace_root(Conf(spark_master="local"))
