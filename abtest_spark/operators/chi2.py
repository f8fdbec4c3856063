"""Chi-square test of conversion per (experiment, day), all groups at once.

Contingency per group: one row per variant with (purchases, users -
purchases). A group is skipped when any row total or column total is zero;
a NULL variant matches no rows in a per-variant equality lookup, so it
makes a zero row and skips its day. Rows without a day are excluded.

Statistic: sum over cells of (|O - E| - c)^2 / E with E = row total x column
total / grand total and the continuity correction c = min(0.5, |O - E|)
applied only when dof = 1. dof = variants - 1; dof 0 gives statistic 0 and
p-value 1.

The plan is one shuffle: the window totals partition by (experiment, day)
and the final aggregate reuses that partitioning. The p-value is a Column
expression (regularized incomplete gamma), evaluated on the
one-row-per-group result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from abtest_spark import schema as S
from abtest_spark.functions.mathfn import chi2_sf
from abtest_spark.operators.conversion import multi_variant

GROUP = ["experiment_name", "day"]


def contingency(gold: DataFrame) -> DataFrame:
    """(experiment, day, variant) -> conversions, non_conversions, plus the
    group totals and the skip decision."""
    w = Window.partitionBy(*GROUP)
    cells = multi_variant(gold).where(F.col("day").isNotNull())
    return (
        cells.select(
            "experiment_name",
            "day",
            "variant_id",
            F.col("purchases").alias("conversions"),
            (F.col("users") - F.col("purchases")).alias("non_conversions"),
        )
        .withColumn("row_total", F.col("conversions") + F.col("non_conversions"))
        .withColumn("conversions_total", F.sum("conversions").over(w))
        .withColumn("non_conversions_total", F.sum("non_conversions").over(w))
        .withColumn("n_variants", F.count(F.lit(1)).over(w))
        .withColumn(
            "_zero_row",
            F.max((F.col("row_total") == 0) | F.col("variant_id").isNull()).over(w),
        )
        .withColumn(
            "testable",
            ~F.col("_zero_row") & (F.col("conversions_total") > 0) & (F.col("non_conversions_total") > 0),
        )
        .drop("_zero_row")
    )


def chi2_expected(gold: DataFrame, yates: bool = True) -> DataFrame:
    """Observed and expected counts of the two cells of each variant in
    testable groups, with each cell's contribution to the statistic."""
    c = contingency(gold).where("testable")
    grand = F.col("conversions_total") + F.col("non_conversions_total")
    dof = F.col("n_variants") - 1
    cells = c.select(
        *GROUP,
        "variant_id",
        dof.alias("dof"),
        F.explode(
            F.array(
                F.struct(
                    F.lit("purchases").alias("cell"),
                    F.col("conversions").cast("double").alias("observed"),
                    (F.col("row_total") * F.col("conversions_total") / grand).alias("expected"),
                ),
                F.struct(
                    F.lit("non_purchases").alias("cell"),
                    F.col("non_conversions").cast("double").alias("observed"),
                    (F.col("row_total") * F.col("non_conversions_total") / grand).alias("expected"),
                ),
            )
        ).alias("_c"),
    ).select(*GROUP, "variant_id", "dof", "_c.*")
    dev = F.abs(F.col("observed") - F.col("expected"))
    corr = F.least(F.lit(0.5), dev) if yates else F.lit(0.0)
    corrected = F.when(F.col("dof") == 1, dev - corr).otherwise(dev)
    return cells.withColumn("contribution", F.pow(corrected, 2) / F.col("expected"))


def chi2_statistic(gold: DataFrame, yates: bool = True) -> DataFrame:
    """(experiment, day) -> chi2_statistic, dof for testable groups."""
    return (
        chi2_expected(gold, yates)
        .groupBy(*GROUP)
        .agg(
            F.sum(F.when(F.col("dof") > 0, F.col("contribution")).otherwise(F.lit(0.0))).alias("chi2_statistic"),
            F.first("dof").cast("int").alias("dof"),
        )
    )


def chi2_test(gold: DataFrame, alpha: float = S.SIGNIFICANCE_LEVEL, yates: bool = True) -> DataFrame:
    """Per testable (experiment, day): statistic, dof, p-value, decision and
    the conclusion texts, ordered by day and experiment."""
    stat = chi2_statistic(gold, yates)
    p = F.when(F.col("dof") == 0, F.lit(1.0)).otherwise(chi2_sf(F.col("chi2_statistic"), F.col("dof")))
    accept = F.col("p_value") >= F.lit(alpha)
    return (
        stat.withColumn("p_value", p)
        .withColumn("reject_h0", ~accept)
        .withColumn("conclusion", F.when(accept, F.lit(S.CHI2_ACCEPT_CONCLUSION)).otherwise(F.lit(S.CHI2_REJECT_CONCLUSION)))
        .withColumn("description", F.when(accept, F.lit(S.CHI2_ACCEPT_DESCRIPTION)).otherwise(F.lit(S.CHI2_REJECT_DESCRIPTION)))
        .select(
            "day",
            "experiment_name",
            "chi2_statistic",
            "dof",
            "p_value",
            "reject_h0",
            "conclusion",
            "description",
        )
        .orderBy("day", "experiment_name")
    )


def chi2_skipped(gold: DataFrame) -> DataFrame:
    """Groups that cannot be tested, with the reason (the warning rows)."""
    c = contingency(gold).where(~F.col("testable"))
    return (
        c.groupBy(*GROUP)
        .agg(
            F.max(F.col("variant_id").isNull()).alias("_null_variant"),
            F.max(F.col("row_total") == 0).alias("_zero_row"),
            F.first("conversions_total").alias("conversions_total"),
            F.first("non_conversions_total").alias("non_conversions_total"),
        )
        .select(
            "day",
            "experiment_name",
            F.when(F.col("_null_variant"), F.lit("null variant"))
            .when(F.col("_zero_row"), F.lit("zero row total"))
            .otherwise(F.lit("zero column total"))
            .alias("reason"),
        )
    )
