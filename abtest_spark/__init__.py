"""Spark-native A/B-experiment analytics.

Raw clickstream -> bronze (validated, deduplicated) -> silver (purchase
attribution, one row per event x experiment) -> gold (daily distinct and
converting users per variant, and per funnel step) -> conversion rates,
chi-square tests, a Bayesian beta-binomial comparison and per-day results.

Every public function takes and returns DataFrames; nothing is collected to
the driver.
"""

from abtest_spark.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
