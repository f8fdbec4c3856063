"""Per-(experiment, day) result documents and their lookup.

A result names the day's participants, the winning variant (most
purchases; ties go to the smallest variant id, whole numbers by value) and the variant list. Lookups
take the experiment slug (``/`` written as ``|``) and a ``YYYY-MM-DD`` day;
a request without data gets the not-found detail text instead of a result.

Rows without a day or without a variant id cannot be addressed by a lookup
and are not part of any result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abtest_spark import schema as S
from abtest_spark.functions.columns import experiment_slug


def _addressable(gold: DataFrame) -> DataFrame:
    return gold.where(F.col("day").isNotNull() & F.col("variant_id").isNotNull())


def _id_order(col: str = "variant_id") -> F.Column:
    """Sort key of variant ids: whole numbers by value, then the others as text."""
    number = F.col(col).try_cast("decimal(38,0)")
    plain = F.when(number.cast("string") == F.col(col), number)
    return F.struct(plain.isNull().alias("text"), plain.alias("number"), F.col(col).alias("id"))


def experiment_results(gold: DataFrame) -> DataFrame:
    """One row per (experiment, day): the nested result document.

    ``variants`` is an array of structs ordered by id (whole numbers by value);
    its length is the number of variants of one experiment (small), so the
    collect is bounded.
    """
    return (
        _addressable(gold)
        .groupBy("experiment_name", "day")
        .agg(
            F.sum("users").cast("long").alias("number_of_participants"),
            F.min(F.struct((-F.col("purchases")).alias("p"), _id_order().alias("o"))).alias("_best"),
            F.array_sort(F.collect_list(F.struct(_id_order().alias("o"), F.col("purchases").alias("n")))).alias("_v"),
        )
        .select(
            experiment_slug("experiment_name").alias("exp_name"),
            "day",
            "number_of_participants",
            F.col("_best.o.id").alias("winner"),
            F.transform(
                "_v", lambda v: F.struct(v["o"]["id"].alias("id"), v["n"].alias("number_of_purchases"))
            ).alias("variants"),
        )
    )


def experiment_results_flat(gold: DataFrame) -> DataFrame:
    """The document without its list: exp_name, day, participants, winner,
    number of variants."""
    return experiment_results(gold).select(
        "exp_name", "day", "number_of_participants", "winner", F.size("variants").cast("long").alias("n_variants")
    )


def experiment_result_variants(gold: DataFrame) -> DataFrame:
    """The variant lists, one row per (experiment, day, variant)."""
    return _addressable(gold).select(
        experiment_slug("experiment_name").alias("exp_name"),
        "day",
        F.col("variant_id").alias("id"),
        F.col("purchases").alias("number_of_purchases"),
    )


def winners(gold: DataFrame) -> DataFrame:
    """(experiment, day) -> winning variant and its purchases."""
    return (
        _addressable(gold)
        .groupBy("experiment_name", "day")
        .agg(F.min(F.struct((-F.col("purchases")).alias("p"), _id_order().alias("o"))).alias("_best"))
        .select(
            "experiment_name",
            "day",
            F.col("_best.o.id").alias("winner"),
            (-F.col("_best.p")).alias("winner_purchases"),
        )
    )


def _body(exp_name: F.Column, day: F.Column) -> F.Column:
    """``{"results": {...}}`` as JSON. Ids are numbers if all of the document's are whole numbers."""

    def document(cast: str) -> F.Column:
        variants = F.transform(
            "variants", lambda v: F.struct(v["id"].try_cast(cast).alias("id"), v["number_of_purchases"])
        )
        winner = F.col("winner").try_cast(cast).alias("winner")
        inner = F.struct(
            exp_name.alias("exp_name"), day.alias("day"), "number_of_participants", winner, variants.alias("variants")
        )
        return F.to_json(F.struct(inner.alias("results")))

    whole = F.forall("variants", lambda v: F.coalesce(v["id"].try_cast("long").cast("string") == v["id"], F.lit(False)))
    return F.when(whole, document("long")).otherwise(document("string"))


def result_json(results: DataFrame) -> DataFrame:
    """exp_name, day, and the response body ``{"results": {...}}`` as JSON."""
    return results.select("exp_name", "day", _body(F.col("exp_name"), F.date_format("day", "yyyy-MM-dd")).alias("json"))


def lookup_results(results: DataFrame, requests: DataFrame) -> DataFrame:
    """Answer ``requests(exp_name, day)`` (day as ``YYYY-MM-DD`` text).

    Left join on (slug, day): found requests carry the result, the others a
    ``detail`` message. ``status`` and ``response`` are the answer as served:
    200 with ``{"results": {...}}``, or 404 with ``{"detail": "..."}``.
    ``results`` is the output of ``experiment_results`` (with the variant
    lists). Requests are few; AQE broadcasts them when small.
    """
    req = requests.select(
        F.col("exp_name").alias("_req_exp"),
        F.col("day").cast("string").alias("_req_day"),
    )
    res = results.withColumn("_res_day", F.date_format("day", "yyyy-MM-dd"))
    joined = req.join(
        res,
        (req["_req_exp"] == res["exp_name"]) & (req["_req_day"] == res["_res_day"]),
        "left",
    )
    detail = F.format_string(
        S.NOT_FOUND_TEMPLATE.replace("{exp}", "%s").replace("{day}", "%s"), F.col("_req_exp"), F.col("_req_day")
    )
    found = F.col("_res_day").isNotNull()
    body = _body(F.col("_req_exp"), F.col("_res_day"))
    missing = F.to_json(F.struct(detail.alias("detail")))
    return joined.select(
        F.col("_req_exp").alias("exp_name"),
        F.col("_req_day").alias("day"),
        found.alias("found"),
        "number_of_participants",
        "winner",
        F.when(found, F.lit(None).cast("string")).otherwise(detail).alias("detail"),
        F.when(found, F.lit(200)).otherwise(F.lit(404)).alias("status"),
        F.when(found, body).otherwise(missing).alias("response"),
    )


def calendar_requests(gold: DataFrame) -> DataFrame:
    """Requests for every experiment and every calendar day from its first
    day to one day after its last (the last one finds nothing). Generated
    per experiment with a sequence, so the size is experiments x days."""
    span = (
        _addressable(gold)
        .groupBy("experiment_name")
        .agg(F.min("day").alias("_d0"), F.max("day").alias("_d1"))
    )
    days = span.select(
        experiment_slug("experiment_name").alias("exp_name"),
        F.explode(F.sequence(F.col("_d0"), F.date_add(F.col("_d1"), 1), F.expr("interval 1 day"))).alias("_day"),
    )
    return days.select("exp_name", F.date_format("_day", "yyyy-MM-dd").alias("day"))
