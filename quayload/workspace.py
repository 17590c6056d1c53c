"""Where a run keeps its files: the shared folder the cluster names."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


@functools.cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="quayload-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def workspace_root(spark: SparkSession) -> str:
    """The shared folder from ``spark.checkpoint.dir``.

    Only a local session may do without the setting; it gets a new temporary
    folder, because there the driver and the executors share one machine.
    """
    shared = spark.conf.get(CHECKPOINT_DIR, None)
    if shared:
        return shared.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
    return _local_folder()


def _file_system(spark: SparkSession, path: str):
    """Hadoop's path object and the file system it is on."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(context._jsc.hadoopConfiguration())


def write_small_file(spark: SparkSession, path: str, text: str) -> None:
    """Write one object, replacing what is there."""
    delete_path(spark, path)
    place, system = _file_system(spark, path)
    out = system.create(place, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def path_exists(spark: SparkSession, path: str) -> bool:
    place, system = _file_system(spark, path)
    return system.exists(place)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a file, or a folder with all in it; says whether there was one."""
    place, system = _file_system(spark, path)
    return system.delete(place, True)


def new_area(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{workspace_root(spark)}/quayload/{label}-{uuid.uuid4().hex}"
