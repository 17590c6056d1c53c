"""Resharding by minimum-cost flow.

From the rows each old shard has and the rows each new shard may hold, a flow
of least cost says how many rows go from where to where: what stays costs
nothing, a moved row costs the mean bytes of its shard's movable rows. The rows
that go are the smallest of their shard, so few bytes move. Only files of
shards that gain or lose rows are rewritten.

The flow has one node per shard and is solved in the driver; rows are ranked
and dealt by Spark. No shard's rows are sorted in one task: a rank is a cell's
offset plus the rank within the cell. Cells are classes of sizes, cut by hash;
the class in which the rows that go end is cut by exact size first.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quayload.llm.common import Files, crc, documents, shuffles_dropped, text_of
from quayload.workspace import delete_path

#: Bytes a row takes besides its text.
ROW_BYTES = 16
#: Cells of one size class, by hash.
HASH_CELLS = 64
#: Size classes per doubling of the size.
CLASSES = 8


@dataclass(frozen=True)
class Transfer:
    """``rows`` consecutive ranks of ``old``, from ``start`` on, become slots of ``new`` from ``slot`` on."""

    old: int
    new: int
    start: int
    rows: int
    slot: int


def minimum_cost_flow(supply: Sequence[int], room: Sequence[int], cost: Sequence[Sequence[int]]) -> list[list[int]]:
    """Amounts from each supply to each room so that all is sent at least cost.

    Successive cheapest paths in the residual graph; sums must be equal.
    """
    if sum(supply) != sum(room):
        raise ValueError("supply and room differ")
    n, m = len(supply), len(room)
    flow = [[0] * m for _ in range(n)]
    left, free = list(supply), list(room)
    while any(left):
        # Bellman-Ford over supplies (0..n-1) and rooms (n..n+m-1)
        far = [0 if left[i] else None for i in range(n)] + [None] * m
        via: list[int | None] = [None] * (n + m)
        changed = True
        while changed:
            changed = False
            for i in range(n):
                for j in range(m):
                    if far[i] is not None and (far[n + j] is None or far[i] + cost[i][j] < far[n + j]):
                        far[n + j], via[n + j], changed = far[i] + cost[i][j], i, True
                    if flow[i][j] and far[n + j] is not None and (far[i] is None or far[n + j] - cost[i][j] < far[i]):
                        far[i], via[i], changed = far[n + j] - cost[i][j], n + j, True
        end = min((j for j in range(m) if free[j] and far[n + j] is not None), key=lambda j: far[n + j])
        path, at = [], n + end
        while via[at] is not None:
            path.append((via[at], at))
            at = via[at]
        amount = min([left[at], free[end], *[flow[b][a - n] for a, b in path if a >= n]])
        for a, b in path:
            if a < n:
                flow[a][b - n] += amount
            else:
                flow[b][a - n] -= amount
        left[at] -= amount
        free[end] -= amount
    return flow


def even_capacities(rows: int, shards: int) -> list[int]:
    """Rows for each shard, at most one apart."""
    return [rows // shards + (i < rows % shards) for i in range(shards)]


def transfers(old_rows: Sequence[int], room: Sequence[int], old_bytes: Sequence[int]) -> list[Transfer]:
    """Blocks of ranks; each old shard's largest rows, at the end of its ranks, stay."""
    weight = [max(1, b // max(r, 1)) for b, r in zip(old_bytes, old_rows, strict=True)]
    cost = [[0 if i == j else weight[i] for j in range(len(room))] for i in range(len(old_rows))]
    flow = minimum_cost_flow(old_rows, room, cost)
    used, out = [0] * len(room), []
    for i in range(len(old_rows)):
        start = 0
        for j in sorted(range(len(room)), key=lambda j: (j == i, j)):
            if flow[i][j]:
                out.append(Transfer(i, j, start, flow[i][j], used[j]))
                start += flow[i][j]
                used[j] += flow[i][j]
    return out


def size_of() -> Column:
    return (F.octet_length(text_of()) + ROW_BYTES).cast("long")


def _size_class(size: Column) -> Column:
    """Grows with the size; at least one row in 1 + 1/CLASSES of the size apart is in another class."""
    return F.floor(F.log2(F.greatest(size, F.lit(1)).cast("double")) * CLASSES).cast("int")


def _cut_classes(by_class: Sequence, blocks: Sequence[Transfer]) -> list[tuple[int, int]]:
    """Each old shard that keeps some rows and not others, and the size class in which the ones that go end."""
    goes, out = defaultdict(int), []
    for b in blocks:
        goes[b.old] += b.rows if b.old != b.new else 0
    for old, size_class, n in sorted(map(tuple, by_class)):
        if 0 < goes[old] < n:
            out.append((old, size_class))
        goes[old] -= n
    return out


def reshard(docs: DataFrame, old_shard: Column, old_shards: int, shards: int, files: Files) -> tuple[DataFrame, list[Transfer]]:
    """New shard and slot of each row of ``docs`` (doc_id, text), counts at most one apart.

    ``old_shard`` gives the shard a row is in now, 0 to ``old_shards`` - 1; null
    counts as 0. Returns a row per row (doc_id, size, text_crc32, old_shard,
    shard, slot, moved, row) and the blocks. Slots of each shard are 0, 1, 2, ...
    without gaps. Null texts have no bytes; their CRC is that of the empty
    text. An empty table gives no rows and no blocks. ``row`` holds all columns
    of the row itself, from a copy in ``files``: null and repeated doc_ids are
    rows of their own, told apart by a number that the copy gives them.
    """
    text, size = text_of(), size_of()
    numbered = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), "doc_id", "text", old_shard.alias("was"))
    # The number is in the hash as well, so that a frequent doc_id is no one cell.
    hashed = F.xxhash64(F.col("doc_id"), F.col("rid"), F.lit(7))
    rows = files.write(
        numbered.withColumn("rid", F.monotonically_increasing_id()).select(
            "rid",
            "row",
            "doc_id",
            size.alias("size"),
            crc(text).alias("text_crc32"),
            F.coalesce("was", F.lit(0)).cast("int").alias("old_shard"),
            (_size_class(size) * HASH_CELLS + F.pmod(hashed, F.lit(HASH_CELLS))).cast("int").alias("cell"),
        ),
        "rows",
    )
    cells = files.write(rows.groupBy("old_shard", "cell").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")), "cells")
    by_class = cells.groupBy("old_shard", F.expr(f"cell div {HASH_CELLS}").alias("class")).agg(F.sum("n").alias("n")).collect()
    held = {r["old_shard"]: r for r in cells.groupBy("old_shard").agg(F.sum("n").alias("n"), F.sum("bytes").alias("b")).collect()}
    if any(not 0 <= i < old_shards for i in held):
        raise ValueError("a row is in no old shard")
    old_rows = [held[i]["n"] if i in held else 0 for i in range(old_shards)]
    old_bytes = [held[i]["b"] if i in held else 0 for i in range(old_shards)]
    blocks = transfers(old_rows, even_capacities(sum(old_rows), shards), old_bytes)

    # The class in which a shard's last leaving rows are, at most one a shard, is ranked by exact size.
    spark = docs.sparkSession
    cut = spark.createDataFrame(_cut_classes(by_class, blocks), "old_shard int, cut int")
    exact = F.expr(f"cell div {HASH_CELLS}") == F.col("cut")
    rows = rows.join(F.broadcast(cut), "old_shard", "left").withColumns(
        {
            "class": F.expr(f"cell div {HASH_CELLS}"),
            "fine": F.when(exact, F.col("size")).otherwise(0),
            "tie": F.expr(f"cell % {HASH_CELLS}"),
        }
    )
    parts = ["class", "fine", "tie"]
    counts = rows.groupBy("old_shard", *parts).agg(F.count("*").alias("n"))
    before = Window.partitionBy("old_shard").orderBy(*parts).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("old_shard", *parts, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("old_shard", *parts).orderBy("size", F.col("doc_id").asc_nulls_last(), "text_crc32", "rid")
    ranked = rows.withColumn("place", F.row_number().over(inside) - 1).join(offsets, ["old_shard", *parts])
    ranked = ranked.withColumn("rank", F.col("place") + F.col("offset"))
    # One row per block: at most old_shards + shards of them.
    plan = spark.createDataFrame(
        [(b.old, b.start, b.start + b.rows, b.new, b.slot) for b in blocks],
        "b_old int, b_start long, b_end long, shard int, b_slot long",
    )
    found = ranked.join(
        F.broadcast(plan),
        (F.col("old_shard") == F.col("b_old")) & (F.col("rank") >= F.col("b_start")) & (F.col("rank") < F.col("b_end")),
    )
    return (
        found.select(
            "doc_id",
            "size",
            "text_crc32",
            "old_shard",
            "shard",
            (F.col("b_slot") + F.col("rank") - F.col("b_start")).alias("slot"),
            (F.col("shard") != F.col("old_shard")).alias("moved"),
            "row",
        ),
        blocks,
    )


def rewrite_shards(
    docs: DataFrame, placed: DataFrame, blocks: Sequence[Transfer], target: str, slot: str | None = None
) -> list[int]:
    """Write the rows of changed shards to ``target/shard=<n>`` and leave the others' files.

    ``target`` is the folder whose sub-folders hold the old shards, or will
    hold the new ones. ``docs`` names the columns; the rows are those ``placed``
    carries, so each is written once whatever its doc_id, and ``docs`` may be
    read from ``target`` itself. Folders of changed shards that no row is in any
    more are deleted, after the others are written: a run cut short is done
    again with the same ``placed``. ``slot`` names a column to write the slots
    to. Returns the numbers of the changed shards.
    """
    changed = sorted({n for b in blocks if b.old != b.new for n in (b.old, b.new)})
    columns = [F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() != "shard"]
    columns += [F.col("slot").alias(slot)] if slot else []
    rows = placed.where(F.col("shard").isin(changed)).select(*columns, "shard")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(target)
    for n in sorted(set(changed) - {b.new for b in blocks}):
        delete_path(placed.sparkSession, f"{target}/shard={n}")
    return changed


#: Production parameters of the query: from the 32 shards that doc_id's hash deals to 40.
OLD_SHARDS, SHARDS = 32, 40


def op6_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rewrites the changed shards in its working area; their rows are told from those files, the others' from the plan."""
    docs, files = documents(spark, sf_dir), Files(spark, "reshard")
    law = F.pmod(crc(F.col("doc_id")), F.lit(OLD_SHARDS)).cast("int")
    placed, blocks = reshard(docs, law, OLD_SHARDS, SHARDS, files)
    target = f"{files.root}/shards"
    with shuffles_dropped(spark):
        changed = rewrite_shards(docs, placed, blocks, target, slot="slot")
    schema = T.StructType([*docs.schema.fields, T.StructField("slot", T.LongType()), T.StructField("shard", T.IntegerType())])
    written = spark.read.schema(schema).parquet(target)
    names = ["doc_id", "size", "text_crc32", "shard", "slot", "old_shard", "moved"]
    read_back = written.withColumns(
        {"size": size_of(), "text_crc32": crc(text_of()), "old_shard": law, "moved": F.col("shard") != law}
    )
    rows = read_back.select(*names).unionByName(placed.where(~F.col("shard").isin(changed)).select(*names))
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "old_shard",
        "moved",
    )
