from abtest_spark.functions.columns import (
    experiment_name,
    experiment_parts,
    experiment_slug,
    is_buy,
    is_invalid_ts,
    is_malformed_experiments,
    parsed_ts,
    variant_id,
)
from abtest_spark.functions.mathfn import chi2_sf, chi2_sf_numpy, gamma_q, ln_beta, ln_gamma

__all__ = [
    "experiment_name",
    "experiment_parts",
    "experiment_slug",
    "is_buy",
    "is_invalid_ts",
    "is_malformed_experiments",
    "parsed_ts",
    "variant_id",
    "chi2_sf",
    "chi2_sf_numpy",
    "gamma_q",
    "ln_beta",
    "ln_gamma",
]
