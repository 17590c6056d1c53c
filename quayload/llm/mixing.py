"""Mixing sources to target weights by hierarchical budgeting.

The budget goes down a tree (domain, language, source). At each node it is
divided among the children by their weights, but none gets more than the leaves
below it can give; what one lacks its siblings take over, and only what they
cannot take was already given to the siblings of an ancestor. Each leaf then
fills its budget from epochs: in each epoch it is ordered anew by a seeded hash,
and the last epoch is a prefix by tokens.

All arithmetic is on whole numbers, so that results do not depend on the order
of summation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayload.llm.common import Files, documents, text_of

#: Documents of an epoch are dealt to 16**SLICE_DIGITS slices of the order, so that no leaf is sorted in one task.
SLICE_DIGITS = 3
WORDS = r"[^\x20\x09-\x0D]+"
WIDE = "decimal(38,0)"


@dataclass(frozen=True)
class Mix:
    """What is wanted.

    ``levels``: columns from the root's children to the leaves. ``weights``: by
    level, from a value to a whole number; values not named weigh ``other``.
    ``budget_parts``: the budget, in thousandths of the tokens there are.
    ``epochs``: how often a document may be taken at most.
    """

    levels: Sequence[str]
    weights: Mapping[str, Mapping[str, int]] = field(default_factory=dict)
    other: int = 1
    budget_parts: int = 1000
    epochs: int = 1
    seed: int = 17


def n_tokens() -> Column:
    return F.regexp_count(text_of(), F.lit(WORDS)).cast("long")


def _weight(mix: Mix, column: str, level: str) -> Column:
    named = mix.weights.get(level, {})
    if not named:
        return F.lit(mix.other).cast("long")
    pairs = [F.lit(x) for pair in named.items() for x in pair]
    return F.coalesce(F.create_map(*pairs)[F.col(column)], F.lit(mix.other)).cast("long")


def _divide(children: DataFrame) -> DataFrame:
    """Water filling: ``share`` of the parent's ``budget`` for each child with ``weight`` and ``most``.

    Children are taken by what they can give per unit of weight. Those that
    can't give their part give all they have; the others divide the rest by
    weight, rounded down.
    """
    window = Window.partitionBy("parent").orderBy(F.col("most") / F.col("weight"), "path")
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    onward = window.rowsBetween(0, Window.unboundedFollowing)
    sums = children.withColumns(
        {
            "taken": F.coalesce(F.sum("most").over(before), F.lit(0)).cast(WIDE),
            "weights": F.sum("weight").over(onward).cast("long"),
            "place": F.row_number().over(window),
        }
    )
    left = F.col("budget").cast("decimal(19,0)") - F.col("taken").cast("decimal(19,0)")
    enough = F.col("most").cast("decimal(19,0)") * F.col("weights") >= left * F.col("weight")
    first = F.min(F.when(enough, F.struct("place", "taken", "weights"))).over(Window.partitionBy("parent"))
    part = F.expr("((budget - first.taken) * weight) div first.weights")
    return sums.withColumn("first", first).withColumn(
        "share",
        F.when(F.col("first").isNull() | (F.col("place") < F.col("first.place")), F.col("most"))
        .otherwise(F.least(part, F.col("most")))
        .cast("long"),
    )


def leaf_budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """``leaves``: the path of each as a struct ``leaf`` of the levels, and ``tokens``. Adds its ``share``.

    Equal structs may hold nulls, so a null is a value like others.
    """
    most = leaves.withColumn("most", F.col("tokens") * mix.epochs)
    budget = F.expr(f"(coalesce(sum(tokens), 0) * {mix.budget_parts}) div 1000")
    parents = most.agg(budget.alias("budget")).withColumn("parent", F.struct(F.lit(0).alias("root")))
    for depth, level in enumerate(mix.levels, 1):
        path = [F.col(f"leaf.{c}") for c in mix.levels[:depth]]
        above = F.struct(*path[:-1]) if depth > 1 else F.struct(F.lit(0).alias("root"))
        nodes = most.groupBy(F.struct(*path).alias("path"), above.alias("parent")).agg(F.sum("most").cast("long").alias("most"))
        nodes = nodes.withColumn("weight", _weight(mix, f"path.{level}", level)).where("weight > 0")
        shared = _divide(nodes.join(parents, "parent"))
        parents = shared.select(F.col("path").alias("parent"), F.col("share").alias("budget"))
    return parents.toDF("leaf", "share")


def _leaf(mix: Mix, levels: Mapping[str, Column] | None) -> Column:
    made = levels or {}
    return F.struct(*[(made[c] if c in made else F.col(c)).cast("string").alias(c) for c in mix.levels])


def _order(mix: Mix) -> Column:
    """The place of a row in the epoch after its leaf's full ones."""
    parts = [F.lit(str(mix.seed)), F.col("full").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))]
    return F.md5(F.concat_ws(":", *parts))


def _slice(order: str) -> Column:
    return F.substring(order, 1, SLICE_DIGITS)


def plan_mix(rows: DataFrame, mix: Mix, files: Files) -> DataFrame:
    """A row per leaf of ``rows`` (doc_id, leaf, n_tokens) with its budget and where its last epoch ends.

    leaf, tokens, share, ``full`` epochs, ``rest`` tokens of one more, the
    slice ``cut`` of the order in which the rest ends, and the tokens before it.
    """
    leaves = files.write(rows.groupBy("leaf").agg(F.sum("n_tokens").alias("tokens")), "leaves")
    budgets = files.write(leaf_budgets(leaves, mix), "budgets")
    plan = leaves.join(budgets, "leaf", "left").withColumn("share", F.coalesce("share", F.lit(0).cast("long")))
    some = F.col("tokens") > 0
    plan = files.write(
        plan.withColumns(
            {
                "full": F.when(some, F.expr("share div tokens")).otherwise(0),
                "rest": F.when(some, F.col("share") % F.col("tokens")).otherwise(0),
            }
        ),
        "shares",
    )
    keyed = rows.join(plan.select("leaf", "full"), "leaf").withColumn("slice", _slice(_order(mix)))
    slices = keyed.groupBy("leaf", "slice").agg(F.sum("n_tokens").alias("held"))
    running = Window.partitionBy("leaf").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("before", F.coalesce(F.sum("held").over(running), F.lit(0)))
    cuts = slices.join(plan.select("leaf", "rest"), "leaf").where("before < rest AND rest <= before + held")
    cuts = cuts.groupBy("leaf").agg(F.min(F.struct("slice", "before")).alias("cut"))
    ends = plan.join(cuts, "leaf", "left")
    return files.write(ends.select(*plan.columns, F.col("cut.slice").alias("cut"), F.col("cut.before").alias("before")), "plan")


def _with_taken(rows: DataFrame, plan: DataFrame, mix: Mix) -> DataFrame:
    """``rows`` (doc_id, leaf, n_tokens and more) with their leaf's plan and ``taken``.

    Only the rows of the slice in which a leaf's rest ends are sorted.
    """
    keyed = rows.join(plan, "leaf").withColumn("order", _order(mix))
    edge = F.coalesce(_slice("order") == F.col("cut"), F.lit(False))
    inside = keyed.where(~edge).withColumn("extra", F.coalesce(_slice("order") < F.col("cut"), F.lit(False)))
    within = Window.partitionBy("leaf").orderBy("order", F.col("doc_id").asc_nulls_last(), "n_tokens")
    begun = F.coalesce(F.sum("n_tokens").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = keyed.where(edge).withColumn("extra", F.col("before") + begun < F.col("rest"))
    extra = (F.col("extra") & (F.col("n_tokens") > 0)).cast("int")
    return inside.unionByName(cut).withColumn("taken", F.col("full").cast("int") + extra)


def mix_sources(docs: DataFrame, mix: Mix, files: Files, levels: Mapping[str, Column] | None = None) -> DataFrame:
    """How often each row of ``docs`` (doc_id, text and the levels) is taken.

    ``levels``: expressions for those levels that are not columns of ``docs``.

    Returns a row per row: doc_id, the levels, n_tokens (words), leaf_tokens,
    leaf_budget and taken. A leaf whose budget is e times its tokens and r more
    takes every document e times; one more time those documents that begin
    before token r in the order of the next epoch, which is by
    ``md5(seed:epoch:doc_id)``, then doc_id. So a leaf exceeds its budget by
    less than one document. Documents without words are taken in full epochs
    only. Null values of a level are a value of their own, of weight
    ``other``; null texts have no words; a null doc_id is hashed as empty.
    Values of weight 0 get nothing. Rows with the same order key are counted
    in the order of their tokens. An empty table gives an empty result.
    Other columns are ignored.
    """
    rows = files.write(docs.select("doc_id", _leaf(mix, levels).alias("leaf"), n_tokens().alias("n_tokens")), "rows")
    return _with_taken(rows, plan_mix(rows, mix, files), mix).select(
        "doc_id",
        *[F.col(f"leaf.{c}").alias(c) for c in mix.levels],
        "n_tokens",
        F.col("tokens").alias("leaf_tokens"),
        F.col("share").alias("leaf_budget"),
        "taken",
    )


def take_mix(docs: DataFrame, mix: Mix, files: Files, levels: Mapping[str, Column] | None = None) -> DataFrame:
    """The rows of ``docs``, each as often as ``mix_sources`` takes it, with the columns of ``docs``."""
    rows = files.write(docs.select("doc_id", _leaf(mix, levels).alias("leaf"), n_tokens().alias("n_tokens")), "rows")
    plan = plan_mix(rows, mix, files)
    whole = docs.select("doc_id", _leaf(mix, levels).alias("leaf"), n_tokens().alias("n_tokens"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    taken = _with_taken(whole, plan, mix).where("taken > 0")
    return taken.select(F.explode(F.array_repeat("row", F.col("taken"))).alias("row")).select("row.*")


def domain() -> Column:
    """The given tables have no domain; sources are put into three by their number."""
    number = F.expr("try_cast(regexp_extract(source, '([0-9]+)$', 1) AS bigint)")
    return F.when(number % 3 == 0, "web").when(number % 3 == 1, "books").when(number % 3 == 2, "code")


#: Production parameters of the query.
QUERY_MIX = Mix(
    levels=("domain", "lang", "source"),
    weights={"domain": {"web": 5, "books": 3, "code": 2}, "lang": {"en": 6, "de": 2, "fr": 2}, "source": {"src0": 2}},
    budget_parts=1100,
    epochs=3,
)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir), QUERY_MIX, Files(spark, "mix_sources"), {"domain": domain()})


def _level_sql(name: str, below: str, path: list[str], parents: list[str], weight: str) -> str:
    """One level of the division, as ``_divide`` does it."""
    on = " AND ".join(f"n.{c} IS NOT DISTINCT FROM p.{c}" for c in parents) or "true"
    part = ", ".join(parents) or "1"
    cols = ", ".join(path)
    tail = ", ".join(f"{c} NULLS FIRST" for c in path)
    ncols = ", ".join(f"n.{c}" for c in path)
    return f"""
{name}_n AS (SELECT {cols}, sum(most)::HUGEINT AS most, {weight} AS weight FROM most GROUP BY {cols}),
{name}_s AS (
  SELECT {ncols}, n.most, n.weight, p.budget,
         coalesce(sum(n.most) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS taken,
         sum(n.weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::HUGEINT AS weights,
         row_number() OVER w AS place
  FROM {name}_n n JOIN {below} p ON {on} WHERE n.weight > 0
  WINDOW w AS (PARTITION BY {", ".join(f"n.{c}" for c in parents) or "1"} ORDER BY n.most::DOUBLE / n.weight, {", ".join(f"n.{c} NULLS FIRST" for c in path)})),
{name}_f AS (
  SELECT *, min(CASE WHEN most * weights >= (budget - taken) * weight THEN place END) OVER (PARTITION BY {part}) AS cut
  FROM {name}_s),
{name}_c AS (SELECT {(", ".join(parents) + ",") if parents else ""} taken AS cut_taken, weights AS cut_weights FROM {name}_f WHERE place = cut),
{name} AS (
  SELECT {", ".join(f"f.{c}" for c in path)},
         (CASE WHEN cut IS NULL OR place < cut THEN most
               ELSE least(((budget - cut_taken) * weight) // cut_weights, most) END)::HUGEINT AS budget
  FROM {name}_f f LEFT JOIN {name}_c c ON {" AND ".join(f"f.{c} IS NOT DISTINCT FROM c.{c}" for c in parents) or "true"})"""


def _sql() -> str:
    weights = {
        level: "CASE " + level + "".join(f" WHEN '{k}' THEN {v}" for k, v in QUERY_MIX.weights[level].items()) + f" ELSE {QUERY_MIX.other} END"
        for level in QUERY_MIX.levels
    }
    return rf"""
WITH rows AS (
  SELECT doc_id, lang, source,
         CASE TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) % 3
           WHEN 0 THEN 'web' WHEN 1 THEN 'books' WHEN 2 THEN 'code' END AS domain,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens
  FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS tokens FROM rows GROUP BY ALL),
most AS (SELECT *, tokens * {QUERY_MIX.epochs} AS most FROM leaves),
top AS (SELECT ((sum(tokens) * {QUERY_MIX.budget_parts}) // 1000)::HUGEINT AS budget FROM leaves),
{_level_sql("d", "top", ["domain"], [], weights["domain"])},
{_level_sql("l", "d", ["domain", "lang"], ["domain"], weights["lang"])},
{_level_sql("s", "l", ["domain", "lang", "source"], ["domain", "lang"], weights["source"])},
plan AS (
  SELECT v.*, coalesce(s.budget, 0) AS share,
         CASE WHEN tokens > 0 THEN coalesce(s.budget, 0) // tokens ELSE 0 END AS whole,
         CASE WHEN tokens > 0 THEN coalesce(s.budget, 0) % tokens ELSE 0 END AS rest
  FROM leaves v LEFT JOIN s ON v.domain IS NOT DISTINCT FROM s.domain AND v.lang IS NOT DISTINCT FROM s.lang
       AND v.source IS NOT DISTINCT FROM s.source),
placed AS (
  SELECT r.*, p.tokens, p.share, p.whole, p.rest,
         coalesce(sum(r.n_tokens) OVER (
           PARTITION BY r.domain, r.lang, r.source
           ORDER BY md5('{QUERY_MIX.seed}:' || p.whole || ':' || coalesce(r.doc_id::VARCHAR, '')), r.doc_id NULLS LAST, r.n_tokens
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM rows r JOIN plan p ON r.domain IS NOT DISTINCT FROM p.domain AND r.lang IS NOT DISTINCT FROM p.lang
       AND r.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, domain, lang, source, n_tokens::BIGINT AS n_tokens, tokens::BIGINT AS leaf_tokens,
       share::BIGINT AS leaf_budget,
       (whole + CASE WHEN start < rest AND n_tokens > 0 THEN 1 ELSE 0 END)::INTEGER AS taken
FROM placed
"""


SQL = _sql()
