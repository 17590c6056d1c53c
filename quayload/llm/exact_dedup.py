"""Exact dedup by an extendible-hash index on shared files.

Texts are equal when they are identical after white space is deleted. Each
text's key is a 64-bit hash. The index's directory has 2**depth cells, by the
key's first bits; while a cell holds more bytes than a bucket may, the directory
doubles, and cells that fit together are one bucket again (each bucket has its
own, smaller depth). Consecutive buckets form the key range of one owner task.
An owner chains its entries by key and compares the bytes of those that collide.
One key with very many rows can't be split by doubling: its rows are aggregated
before they are shuffled.

DataFrame operations only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayload.llm.common import SPACES, Files, documents, heavy_limit, look_up, only, partition_bytes, text_of

#: The directory never has more than 2**MAX_DEPTH cells.
MAX_DEPTH = 20


class HashCollision(Exception):
    """Two different texts share both hashes, so that rows can't be told apart by them."""


@dataclass(frozen=True)
class DedupIndex:
    """``entries``: a row per document (doc_id, key, text_sha256, n_chars, n_bytes).

    ``groups``: a row per different text (key, text_sha256, bucket, keep_id,
    group_size). Both are files in the shared folder.
    """

    entries: DataFrame
    groups: DataFrame
    rows: int
    depth: int
    owners: int


def normalised(column: str = "text") -> Column:
    return F.translate(text_of(column), SPACES, "")


def _cell(depth: int) -> Column:
    """The first ``depth`` bits of the key."""
    return F.shiftrightunsigned("key", 64 - depth) if depth else F.lit(0).cast("long")


def _best() -> Column:
    """Most code points first, then the smallest doc_id; a missing doc_id comes last."""
    return F.min(F.struct(-F.col("n_chars"), F.col("doc_id").isNull(), "doc_id"))


def _directory(light: DataFrame, total: int, bucket_bytes: int, max_depth: int) -> tuple[DataFrame, int]:
    """Cells of the directory with their bucket, and the directory's depth."""
    depth = min(max_depth, max(0, (total // max(bucket_bytes, 1)).bit_length()))
    while True:
        cells = light.groupBy(_cell(depth).alias("cell")).agg(F.sum("n_bytes").alias("bytes"))
        if depth >= max_depth or not cells.where(F.col("bytes") > bucket_bytes).take(1):
            break
        depth += 1
    levels = cells.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(depth))))
    prefix = F.expr(f"shiftright(cell, {depth} - level)")
    whole = Window.partitionBy("level", prefix)
    fits = levels.withColumn("held", F.sum("bytes").over(whole)).where(
        (F.col("held") <= bucket_bytes) | (F.col("level") == depth)
    )
    buckets = fits.groupBy("cell", "bytes").agg(F.min("level").alias("level"))
    first_cell = F.expr(f"shiftleft(shiftright(cell, {depth} - level), {depth} - level)")
    return buckets.select("cell", "bytes", first_cell.alias("bucket")), depth


def build_index(
    docs: DataFrame,
    files: Files,
    bucket_bytes: int | None = None,
    max_depth: int = MAX_DEPTH,
) -> DedupIndex:
    """Index ``docs`` (doc_id, text) by whole text; see ``exact_dedup`` for the cases.

    ``bucket_bytes``: the text a bucket may hold before it is split, half of
    what an owner gets; from the session's file partition size if not given.
    """
    bucket_bytes = bucket_bytes or max(1, partition_bytes(docs.sparkSession) // 2)
    owner_bytes = 2 * bucket_bytes
    texts = only(docs, "doc_id", "text").select(
        "doc_id", F.length(text_of()).alias("n_chars"), normalised().alias("norm")
    )
    key = F.xxhash64("norm").alias("key")
    entries = files.write(
        texts.select(
            "doc_id",
            key,
            F.sha2("norm", 256).alias("text_sha256"),
            "n_chars",
            F.octet_length("norm").alias("n_bytes"),
        ),
        "entries",
    )
    rows, total = entries.agg(F.count("*"), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    limit = heavy_limit(rows)
    hot = files.write(
        entries.groupBy("key").count().where(F.col("count") > limit).select("key", F.lit(True).alias("hot")),
        "hot_keys",
    )
    light = entries.join(F.broadcast(hot), "key", "left_anti")
    cells, depth = _directory(light, total, bucket_bytes, max_depth)
    #: At most 2**depth rows pass through this window.
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.groupBy("bucket").agg(F.sum("bytes").alias("bytes"))
    starts = starts.withColumn(
        "owner",
        F.floor(F.coalesce(F.sum("bytes").over(before.orderBy("bucket")), F.lit(0)) / owner_bytes).cast("int"),
    )
    directory = files.write(
        cells.select("cell", "bucket").join(starts.select("bucket", "owner"), "bucket"), "directory"
    )
    owners = (directory.agg(F.max("owner")).first()[0] or 0) + 1

    marked = texts.select("doc_id", "n_chars", "norm", key).join(F.broadcast(hot), "key", "left")
    chained = (
        marked.where("hot")
        .groupBy("key", "norm")
        .agg(_best().alias("best"), F.count("*").alias("group_size"))
        .withColumn("bucket", F.lit(None).cast("long"))
    )
    owned = (
        marked.where("hot IS NULL")
        .withColumn("cell", _cell(depth))
        .join(F.broadcast(directory), "cell")
        .repartitionById(owners, F.col("owner"))
        .groupBy("owner", "bucket", "key", "norm")
        .agg(_best().alias("best"), F.count("*").alias("group_size"))
    )
    columns = ["key", F.sha2("norm", 256).alias("text_sha256"), "bucket", F.col("best.doc_id").alias("keep_id"), "group_size"]
    groups = files.write(owned.select(*columns).unionByName(chained.select(*columns)), "groups")
    if groups.groupBy("key", "text_sha256").count().where("count > 1").take(1):
        raise HashCollision("two texts share their 64-bit and 256-bit hashes")
    return DedupIndex(entries, groups, rows, depth, owners)


def exact_dedup(docs: DataFrame, files: Files, **sizes: int) -> DataFrame:
    """A row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, n_chars.

    Null texts count as empty, and empty texts (or texts of white space) are
    equal to each other. Of equal texts the one with the most code points stays,
    then the smallest doc_id; a null doc_id comes after all others. Repeated
    rows of one doc_id and text share one result, so they stay or go together;
    ``drop_copies`` keeps one of them. An empty table gives an empty result.
    Other columns are ignored, whatever their names.
    """
    index = build_index(docs, files, **sizes)
    shared = index.groups.where("group_size > 1").select(
        F.struct("key", "text_sha256").alias("text_key"), "keep_id", "group_size"
    )
    rows = index.entries.withColumn("text_key", F.struct("key", "text_sha256"))
    found = look_up(rows, shared, "text_key", "group_size", index.rows)
    in_group = F.col("group_size").isNotNull()
    return found.select(
        "doc_id",
        F.when(in_group, F.col("keep_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.when(in_group, F.col("keep_id").eqNullSafe(F.col("doc_id"))).otherwise(True).alias("kept"),
        "text_sha256",
        "n_chars",
    )


def drop_copies(docs: DataFrame, files: Files, **sizes: int) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, one row per text.

    Rows that share a doc_id but not a text are judged apart. Of repeated rows
    one is kept.
    """
    kept = exact_dedup(docs, files, **sizes).where("kept").select("doc_id", "text_sha256").distinct()
    kept = files.write(kept.toDF("_kept_id", "_kept_sha"), "kept")
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.col("doc_id").alias("_id"),
        F.sha2(normalised(), 256).alias("_sha"),
        F.length(text_of()).alias("_length"),
    )
    found = rows.join(kept, rows["_id"].eqNullSafe(kept["_kept_id"]) & (rows["_sha"] == kept["_kept_sha"]))
    again = Window.partitionBy("_kept_id", "_kept_sha").orderBy(F.col("_length").desc())
    return found.withColumn("_nth", F.row_number().over(again)).where("_nth = 1").select("row.*")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir), Files(spark, "exact_dedup"))


SQL = r"""
WITH norm AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
best AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256, n_chars FROM best
"""
