"""Declared schemas, keys and fixed values of the data model."""

from pyspark.sql import types as T

# Raw clickstream as read from CSV. ``timestamp`` stays a string so that
# unparseable values remain visible to the quality checks.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("event_name", T.StringType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("site", T.StringType()),
        T.StructField("experiments", T.StringType()),
    ]
)

RAW_COLUMNS = [f.name for f in RAW_SCHEMA.fields]

# A duplicate is a repeat of all six raw columns (null equals null).
EVENT_KEY = list(RAW_COLUMNS)

# Columns whose nulls are profiled.
NULL_PROFILE_COLUMNS = ["user_id", "event_name", "timestamp", "experiments"]

SILVER_COLUMNS = [
    "user_id",
    "timestamp",
    "event_name",
    "item_id",
    "site",
    "experiment_name",
    "variant_id",
    "flag_purchase",
]

GOLD_KEY = ["day", "experiment_name", "variant_id"]
TUNNEL_KEY = ["day", "event_name", "experiment_name", "variant_id"]

# Declared schemas of the stored layers: an empty layer reads back typed, and
# the partition column keeps its place.
RAW_DDL = "user_id long, timestamp string, event_name string, item_id long, site string, experiments string"
LAYER_SCHEMAS = {
    "bronze": RAW_DDL,
    "silver": "user_id long, timestamp timestamp_ntz, event_name string, item_id long, site string, "
    "experiment_name string, variant_id string, flag_purchase boolean",
    "gold_aggregated": "day date, experiment_name string, variant_id string, users long, purchases long",
    "gold_tunnel": "day date, event_name string, experiment_name string, variant_id string, users long, purchases long",
    "quality_report": "check string, n long",
    "bronze_stream": f"{RAW_DDL}, _day date",
    "user_stats": "user_id long, last_buy_ts timestamp_ntz, any_buy boolean, epoch long",
    "user_days": "user_id long, _day date",
}

LAYERS = ("bronze", "silver", "gold_aggregated", "gold_tunnel")

# ---------------------------------------------------------------------------
# Fixed values (texts, patterns, constants) that results must reproduce exactly.
# ---------------------------------------------------------------------------
BUY_EVENT = "BUY"
# Braces stripped from the experiments string, then split on comma+space,
# then each part split on "=" into name and variant.
EXPERIMENT_BRACES = "[{}]"
EXPERIMENT_SEPARATOR = ", "
VARIANT_SEPARATOR = "="
# An experiments value is well formed when some substring matches this.
EXPERIMENT_PATTERN = r"(\w+=\w+)"
# Lookup slug: "/" in experiment names is replaced by "|".
SLUG_FROM = "/"
SLUG_TO = "|"
SIGNIFICANCE_LEVEL = 0.05
CHI2_ACCEPT_CONCLUSION = "Se acepta H₀: No hay diferencias significativas."
CHI2_REJECT_CONCLUSION = "Se rechaza H₀: Hay diferencias significativas."
CHI2_ACCEPT_DESCRIPTION = "Las variantes parecen comportarse de manera similar."
CHI2_REJECT_DESCRIPTION = "Hay evidencia de que al menos una variante tiene un comportamiento diferente."
COMPARISON_SIGNIFICANT = "La variante %s tiene diferencias significativas respecto al control."
COMPARISON_NOT_SIGNIFICANT = "La variante %s no tiene diferencias significativas respecto al control."
NOT_FOUND_TEMPLATE = "No data found for experiment '{exp}' on day '{day}'"
# Bayesian model: alpha, beta ~ Exponential(rate 1/3); 5,000 posterior draws;
# 95 % highest-density intervals.
PRIOR_RATE = 1.0 / 3.0
POSTERIOR_SAMPLES = 5000
HDI_PROB = 0.95
POSTERIOR_CLASS = "binary"
