"""Mixing sources to target weights by hierarchical budgeting.

Documents hang in a tree, here domain - language - source. A token budget goes
from the root to the leaves: each node's budget is divided among its children
by their weights, and no child gets more than its subtree can give (its tokens
times ``max_epochs``). What a short child cannot take is divided among its
siblings by their weights; only when all of them are full does it show as a
smaller capacity of the parent, whose siblings take it then. Each leaf repeats
whole epochs while its budget lasts and takes a prefix of one more epoch, whose
order is a seeded hash of (epoch, doc_id).

The division is a closed form over windows of siblings (sorted by capacity per
weight, the full children are a prefix). The prefix needs no sort of a leaf:
tokens are summed per hash bucket, only the bucket in which the budget ends is
sorted. Documents are joined with one row per leaf, so they are not shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from abtest_spark.llm.common import cut, packed, unpacked

BROADCAST_LEAVES = 200_000  # leaf tables up to this many rows (counted) are broadcast
BUCKET_DIGITS = 3  # hex digits of the order hash: 4096 buckets per leaf

#: A token is a run without white space (U+0020, U+0009..000D).
TOKEN = "[^\\x09-\\x0D\\x20]+"


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("long")


def divide(children: DataFrame, parent: list[str]) -> DataFrame:
    """Adds ``share`` to ``children(.., weight long, cap long, budget double)``: the parent's budget divided.

    ``budget`` is the parent's, equal for all its children and at most the sum
    of their capacities. Children of weight 0 get nothing.
    """
    usable = F.when(F.col("weight") > 0, F.col("cap")).otherwise(F.lit(0).cast("long"))
    among = Window.partitionBy(*parent)
    names = [c for c in children.columns if c not in {"weight", "cap", "budget"}]
    order = among.orderBy(
        F.when(F.col("weight") > 0, usable / F.col("weight")).otherwise(F.lit(-1.0)), *[F.col(c) for c in names]
    )
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("budget") - F.coalesce(F.sum(usable).over(before), F.lit(0))) / F.sum("weight").over(onward)
    marked = (
        children.withColumn("__level", F.when(F.col("weight") > 0, level))
        .withColumn("__full", (F.col("weight") == 0) | (usable <= F.col("weight") * F.col("__level")))
        .withColumn("__place", F.row_number().over(order))
    )
    first = F.min(F.when(~F.col("__full"), F.struct("__place", "__level"))).over(among)
    share = F.when(F.col("__full"), usable.cast("double")).otherwise(F.col("weight") * first["__level"])
    return marked.withColumn("share", share).drop("__level", "__full", "__place")


def leaf_budgets(
    leaves: DataFrame, levels: list[str], weights: Mapping[tuple, int], fraction: float, max_epochs: int
) -> DataFrame:
    """``leaves(*levels, tokens long)`` with each leaf's ``budget`` (whole tokens).

    ``weights`` maps a path of level values to its weight among its siblings (a
    whole number; 1 where none is given). The root's budget is ``fraction`` of
    all tokens, at most what the tree can give.
    """
    spark = leaves.sparkSession
    table = spark.createDataFrame(
        [("\x1f".join(path), int(w)) for path, w in weights.items()], "__path string, __given long"
    )
    nodes = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    # capacities from the leaves up: a node of weight 0 gives nothing
    levels_up = {}
    for d in range(len(levels), 0, -1):
        path = F.concat_ws("\x1f", *levels[:d])
        nodes = (
            nodes.groupBy(*levels[:d])
            .agg(F.sum("cap").alias("cap"))
            .withColumn("__path", path)
            .join(F.broadcast(table), "__path", "left")  # as large as the caller's parameter
            .withColumn("weight", F.coalesce("__given", F.lit(1).cast("long")))
            .drop("__path", "__given")
            .withColumn("cap", F.when(F.col("weight") > 0, F.col("cap")).otherwise(F.lit(0).cast("long")))
        )
        levels_up[d] = nodes
    root = leaves.agg(F.floor(F.coalesce(F.sum("tokens"), F.lit(0)) * F.lit(fraction)).alias("wanted"))
    top = levels_up[1].crossJoin(F.broadcast(root))  # one row
    given = top.withColumn(
        "budget", F.least(F.col("wanted").cast("double"), F.sum("cap").over(Window.partitionBy()).cast("double"))
    ).drop("wanted")
    given = divide(given, []).drop("budget").withColumnRenamed("share", "budget")
    for d in range(2, len(levels) + 1):
        children = levels_up[d].join(given.select(*levels[: d - 1], "budget"), levels[: d - 1])
        given = divide(children, levels[: d - 1]).drop("budget").withColumnRenamed("share", "budget")
    return leaves.join(given.select(*levels, F.floor("budget").alias("budget")), levels)


def mix(
    docs: DataFrame,
    path: Mapping[str, Column],
    weights: Mapping[tuple, int],
    fraction: float = 0.5,
    max_epochs: int = 2,
    seed: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with each chosen row once per epoch it is chosen in, plus __epoch, __tokens and __path.

    A null path value is a node of its own (named empty); null and empty texts
    have no tokens: they come with whole epochs and with a prefix that reaches
    their place. Rows of equal id (null ids too) stand next to each other in
    the epoch's order, fewer tokens first. Input columns of the added names are
    replaced. An empty table gives no rows.
    """
    levels = [f"level_{k}" for k in path]
    base = docs.select(
        packed(docs).alias("__row"),
        token_count(F.col(text_col)).alias("__tokens"),
        F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("__id"),
        *[F.coalesce(c.cast("string"), F.lit("")).alias(f"level_{k}") for k, c in path.items()],
    )
    leaves = cut(base.groupBy(*levels).agg(F.sum("__tokens").alias("tokens")))
    plan = leaf_budgets(leaves, levels, weights, fraction, max_epochs).select(
        *levels,
        F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).alias("__whole"),
        F.when(F.col("tokens") > 0, F.col("budget") % F.col("tokens")).otherwise(0).alias("__rest"),
    )
    plan = cut(plan)
    n_leaves = plan.count()

    def with_plan(rows: DataFrame, table: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(table) if n_leaves <= BROADCAST_LEAVES else table, levels)

    key = F.md5(F.concat_ws(":", F.lit(str(seed)), (F.col("__whole") + 1).cast("string"), "__id"))
    bucket = F.conv(F.substring("__key", 1, BUCKET_DIGITS), 16, 10).cast("int")
    sums = (
        with_plan(base.drop("__row"), plan)
        .where("__rest > 0")
        .withColumn("__key", key)
        .withColumn("__bucket", bucket)
        .groupBy(*levels, "__bucket", "__rest")
        .agg(F.sum("__tokens").alias("__sum"))
    )
    upto = Window.partitionBy(*levels).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, 0)
    edges = (
        sums.withColumn("__upto", F.sum("__sum").over(upto))
        .where("__upto > __rest")
        .groupBy(*levels)
        .agg(F.min(F.struct("__bucket", (F.col("__upto") - F.col("__sum")).alias("before"))).alias("e"))
        .select(*levels, F.col("e.__bucket").alias("__edge"), F.col("e.before").alias("__before"))
    )
    plan = cut(plan.join(edges, levels, "left"))
    rows = with_plan(base, plan).withColumn("__key", key).withColumn("__bucket", bucket)
    last = F.when(
        (F.col("__rest") > 0) & (F.col("__edge").isNull() | (F.col("__bucket") < F.col("__edge"))), F.col("__whole") + 1
    ).otherwise(F.col("__whole"))
    internal = ["__whole", "__rest", "__edge", "__before", "__key", "__bucket"]
    whole = (
        rows.withColumn("__last", last)
        .where("__last > 0")
        .withColumn("__epoch", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__last").cast("long"))))
        .drop("__last", *internal)
    )
    order = Window.partitionBy(*levels).orderBy("__key", "__tokens").rowsBetween(Window.unboundedPreceding, 0)
    edge = (
        rows.where("__bucket = __edge")
        .withColumn("__sum", F.sum("__tokens").over(order) + F.col("__before"))
        .where("__sum <= __rest")
        .withColumn("__epoch", (F.col("__whole") + 1).cast("long"))
        .drop("__sum", *internal)
    )
    added = {"__epoch": F.col("__epoch"), "__tokens": F.col("__tokens"), "__path": F.array(*levels)}
    return whole.unionByName(edge).select(*unpacked(docs, "__row", {}, added))
