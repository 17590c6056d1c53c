"""Tables from record pages that were fetched one after the other while the records moved.

A page says where in the list its first record was, how many there were, and when
it was fetched. Records that are added or removed meanwhile shift the others, so
pages overlap, and a record can be on two of them in two states. Pages are first
checked to cover the whole list; then the newest copy of each record is kept.

The check cuts the list into slices and each page to those it touches. Inside a
slice, the pages' stretches are islands, and what is between them is missing. No
task sees more than one slice's pages.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayload.functions.columns import column, resolve
from quayload.sources.records import RECORDS, IncompletePages
from quayload.spec import quote
from quayload.staging import TIME_OPTIONS
from quayload.workspace import new_area

#: Places of the list in one slice, and missing stretches that an error tells.
SLICE, MOST_TOLD = 1_000_000, 10
PART = "_quayload_part"


@dataclass(frozen=True)
class PageForm:
    """What a page calls its parts.

    ``first`` is the place of its first record, from 0. Pages that are numbered
    instead, from 1, have their number there, and ``page_rows`` records each but
    the last.
    """

    first: str = "offset"
    total: str = "total_records"
    fetched: str = "fetched_at"
    page_rows: int | None = None

    def schema(self, record: T.StructType) -> T.StructType:
        parts = ((self.first, T.LongType()), (self.total, T.LongType()), (self.fetched, T.TimestampType()))
        return T.StructType([*(T.StructField(name, kind) for name, kind in parts), T.StructField(RECORDS, T.ArrayType(record))])


def read_pages(spark: SparkSession, pages: str, record: T.StructType, form: PageForm, page_per_file: bool) -> DataFrame:
    """A row per page: first, total, fetched, records. A page without one of them, or with a null record, fails."""
    reader = spark.read.options(mode="FAILFAST", multiLine=page_per_file, **TIME_OPTIONS)
    read = reader.schema(form.schema(record)).json(pages)
    first, listed = column(form.first), column(RECORDS)
    if form.page_rows:
        first = (first - 1) * form.page_rows
    has_all = first.isNotNull() & (first >= 0) & column(form.total).isNotNull() & column(form.fetched).isNotNull() & listed.isNotNull()
    whole = F.when(has_all & ~F.exists(listed, lambda r: r.isNull()), listed)
    failure = F.raise_error(F.lit(f"{pages}: a page lacks its place, total, time or records, or has a record that is null"))
    checked = F.coalesce(whole, failure.cast(read.schema[RECORDS].dataType))
    return read.select(first.alias("first"), column(form.total).alias("total"), column(form.fetched).alias("fetched"), checked.alias(RECORDS))


def missing_stretches(stretches: DataFrame, total: int, slice_rows: int = SLICE) -> DataFrame:
    """Places (low, to below high) of 0 to ``total`` that no stretch (low, high) covers.

    A stretch that is missing across the border of two slices is told in two.
    """
    spark = stretches.sparkSession
    slices = spark.range(-(-total // slice_rows)).select(
        F.col("id").alias("slice"),
        (F.col("id") * slice_rows).alias("begin"),
        F.least((F.col("id") + 1) * slice_rows, F.lit(total)).alias("end"),
    )
    # every slice has an empty stretch at its begin, so one without pages is missing whole
    empty = slices.select("slice", F.col("begin").alias("low"), F.col("begin").alias("high"))
    touched = F.sequence(F.call_function("div", F.col("low"), F.lit(slice_rows)), F.call_function("div", F.col("high") - 1, F.lit(slice_rows)))
    cut = stretches.where("low < high").select(F.explode(touched).alias("slice"), "low", "high")
    longest = cut.unionByName(empty).groupBy("slice", "low").agg(F.max("high").alias("high"))
    in_order = Window.partitionBy("slice").orderBy("low")
    reached = F.max("high").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    chain = longest.select("slice", reached.alias("reached"), F.lead("low").over(in_order).alias("next"))
    gaps = chain.join(slices, "slice").select(
        F.greatest("reached", "begin").alias("low"), F.least(F.coalesce("next", "end"), "end").alias("high")
    )
    return gaps.where("low < high")


def extract_records_paged(
    spark: SparkSession,
    pages: str,
    record: T.StructType,
    record_id: list[str],
    form: PageForm = PageForm(),
    page_per_file: bool = False,
) -> DataFrame:
    """One row per record of all landed pages, each in the state of the page that was fetched last.

    Of copies on pages of one time, that on the page with the larger place, then
    at the larger place in it, is taken. The list is as long as the page that
    was fetched last says; if a place before that is on no page, the read fails
    and tells which. So it does if there are fewer different records than that:
    some then moved from a page not yet fetched to one already fetched.
    Records are told apart by ``record_id``, in which null is a value like
    others. No pages at all is an error, a list of length 0 an empty table.

    Pages are parsed once, into a typed copy. Of that only the ids of all
    records are shuffled, and no record.
    """
    own = resolve(spark.createDataFrame([], record), record_id, "record id")
    root = new_area(spark, "pages")
    read = read_pages(spark, pages, record, form, page_per_file).withColumn("page", F.monotonically_increasing_id())
    read.write.parquet(f"{root}/copy")
    copy = spark.read.schema(read.schema).parquet(f"{root}/copy")
    newest = copy.agg(F.max(F.struct("fetched", "total")).alias("last")).first().last
    if newest is None:
        raise IncompletePages(f"{pages}: there are no pages")
    total = newest.total
    stretches = copy.select(F.col("first").alias("low"), (F.col("first") + F.size(RECORDS)).alias("high"))
    gaps = missing_stretches(stretches, total).orderBy("low").limit(MOST_TOLD).collect()
    if gaps:
        told = ", ".join(f"{gap.low} to {gap.high - 1}" for gap in gaps)
        raise IncompletePages(f"{pages}: no page has the records {told} of {total}")
    names = [f"i{i}" for i in range(len(own))]
    ids = F.transform(column(RECORDS), lambda r: F.struct(*[r.getField(name).alias(i) for i, name in zip(names, own)]))
    entries = copy.select("fetched", "first", "page", F.posexplode(ids).alias("at", "id"))
    # a page that landed twice has two numbers
    order = F.struct("fetched", "first", "at", "page")
    copies = entries.select("fetched", "first", "at", "page", "id.*").groupBy(*names).agg(F.max(order).alias("last"), F.count(F.lit(1)).alias("copies"))
    different = Observation()
    several = copies.observe(different, F.count(F.lit(1)).alias("n")).where("copies > 1").drop("copies")
    several.write.parquet(f"{root}/several")
    if different.get["n"] < total:
        raise IncompletePages(f"{pages}: {different.get['n']} different records of {total}; some moved and were missed")
    kept = spark.read.schema(several.schema).parquet(f"{root}/several")
    rows = copy.select("fetched", "first", "page", F.posexplode(column(RECORDS)).alias("at", "record"))
    same = [F.col(f"record.{name}").eqNullSafe(F.col(f"i{i}")) for i, name in enumerate(map(quote, own))]
    found = rows.join(kept, same, "left")
    return found.where(F.col("last").isNull() | (F.col("last") == order)).select("record.*")


def number_rows(df: DataFrame, order: list[str], name: str, path: str) -> DataFrame:
    """``df`` with each row's place in the given order, from 0 without gaps; written to ``path``.

    Rows are range-partitioned and sorted; only the partitions' row counts
    come to the driver.
    """
    spark, keys = df.sparkSession, [column(n) for n in resolve(df, order, "order")]
    at = F.monotonically_increasing_id()  # the partition's number, and the place in it in the lower 33 bits
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    numbered = ranged.withColumns({PART: F.shiftright(at, 33), name: at.bitwiseAND((1 << 33) - 1)})
    numbered.write.parquet(path)
    rows = spark.read.schema(numbered.schema).parquet(path)
    before, offsets = 0, []
    for part, count in sorted(rows.groupBy(PART).count().collect()):
        offsets.append((part, before))
        before += count
    begins = spark.createDataFrame(offsets, f"{PART} long, begin long")  # one row for each partition
    return rows.join(F.broadcast(begins), PART).withColumn(name, column(name) + F.col("begin")).drop(PART, "begin")


def land_paged(
    df: DataFrame,
    pages: str,
    place: str,
    page_rows: int,
    overlap: int,
    form: PageForm = PageForm(),
    stamp: str | None = None,
) -> None:
    """Write ``df`` the way a client lands pages of a list that moves: each page repeats the last ``overlap`` records.

    ``place`` is a column with each row's place in the list, from 0 without
    gaps. Later pages are fetched a second later each. With ``stamp`` records
    get a field of that name with the number of the page they are on.
    """
    total = df.count()
    step = page_rows - overlap
    number = F.call_function("div", column(place), F.lit(step))
    # the page that begins at or before a row, and those before it that reach the row
    earlier = F.greatest(number - F.lit(-(-page_rows // step)), F.lit(0).cast("long"))
    on = F.filter(F.sequence(earlier, number), lambda n: column(place) < n * step + page_rows)
    fields = [column(name) for name in df.columns if name != place]
    dealt = df.withColumn(PART, F.explode(on))
    record = F.struct(*fields, *([column(PART).alias(stamp)] if stamp else []))
    dealt = dealt.select(column(PART).alias("page"), column(place).alias("place"), record.alias("record"))
    by_place = F.array_sort(  # records may have maps, which have no order
        F.collect_list(F.struct("place", "record")),
        lambda a, b: F.when(a.place < b.place, -1).when(a.place > b.place, 1).otherwise(0),
    )
    listed = F.transform(by_place, lambda r: r.record)
    paged = dealt.groupBy("page").agg(listed.alias(RECORDS))
    first = F.col("page") + 1 if form.page_rows else F.col("page") * step
    page = F.struct(
        first.alias(form.first),
        F.lit(total).cast("long").alias(form.total),
        F.timestamp_seconds(F.lit(1_577_836_800) + F.col("page")).alias(form.fetched),
        F.col(RECORDS),
    )
    text = paged.select(F.to_json(page, {**TIME_OPTIONS, "ignoreNullFields": "false"}).alias("value"))
    text.write.mode("errorifexists").text(pages)
