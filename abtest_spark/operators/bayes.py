"""Hierarchical beta-binomial comparison of variants, as Spark jobs.

Model (per experiment): alpha, beta ~ Exponential(rate 1/3); theta_v ~
Beta(alpha, beta) for each variant; every gold row (day) is
Binomial(users, theta_v). Days pool, so each variant is summarised by
s_v = sum of purchases and n_v = sum of users.

Instead of a single-machine MCMC sampler the posterior is integrated on a grid
in u = ln(alpha / beta) and v = ln(alpha + beta): given (alpha, beta) the thetas
are conjugate, so

  log w(u, v) = -rate (a + b) + ln a + ln b
                + sum_v [lnB(a + s_v, b + n_v - s_v) - lnB(a, b)]

(ln a + ln b is the Jacobian), and posterior moments of theta_v are w-weighted
averages of the Beta(a + s_v, b + n_v - s_v) moments. The first grid's ends
follow from the prior and the data (how fast the weight falls off beyond the
variants' own log-odds); few variants are resolved by it at once. Where its
step is too wide, the next grid is centred on the weighted mean and spans
GRID_SPAN standard deviations to either side, until every experiment is resolved.

From the grid each variant's posterior follows as a curve: the density of
x = logit(theta) at CURVE nodes is the weighted sum of the conditional Beta
densities, its integral a sum over the nodes with derivative corrections, and
between nodes the cumulative distribution is the cubic through values and
slopes. Quantiles, highest-density intervals, bin masses and draws are read off
that curve, so none of them is sampled; a draw is the quantile of a uniform
number that a hash of (seed, experiment, variant, draw) gives.

Every step is a DataFrame operation. Cells are dealt out by (experiment,
variant) and summed per grid point before the shuffle, so an experiment with
many variants is spread; a normalised grid and a curve have a fixed size. Work
is experiments x variants x grid points: it grows with the experiments, not
with events.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from abtest_spark import schema as S
from abtest_spark.functions.mathfn import beta_cdf, ln_beta_text
from abtest_spark.operators.conversion import multi_variant
from abtest_spark.session import checkpoint_dir

GRID_POINTS = 96  # per axis
GRID_ROUNDS = 8  # grids at most; one or two is usual
GRID_SPAN = 22.0  # standard deviations to either side of the mean, from the second grid on
GRID_STEP = 0.52  # standard deviations that a step of a resolved grid has at most
FALL_OFF = 24.0  # nats by which the weight has fallen at the first grid's ends
SUM_PER_VARIANT = 60.0  # its largest alpha + beta, per variant and one more: the prior leaves e^-20 per variant beyond
LEAST_WEIGHT = 1e-11  # grid points below this share of the weight are left out of moments and curves

CURVE = 512  # panels of a posterior curve
CURVE_SPAN = 12.0  # standard deviations of the log-odds that it covers to either side
CURVE_END = 40.0  # largest log-odds of a curve
FINE = 16  # positions between two nodes at which the ends of an interval are tried
NEWTON_STEPS = 8


def variant_totals(gold: DataFrame, multi_only: bool = True, null_variants: bool = False) -> DataFrame:
    """(experiment, variant) -> s = purchases, n = users summed over days
    (the undated day included). NULL variants are left out, unless
    ``null_variants``: then their rows form one more group with its own theta
    (they still inform alpha and beta), as in the original model."""
    src = multi_variant(gold) if multi_only else gold
    if not null_variants:
        src = src.where(F.col("variant_id").isNotNull())
    return (
        src.groupBy("experiment_name", "variant_id")
        .agg(F.sum("purchases").cast("long").alias("purchases"), F.sum("users").cast("long").alias("users"))
    )


def variant_code(gold: DataFrame) -> DataFrame:
    """Sorted dense code of each variant within its experiment (0-based).

    Display only; every join in this module keys on ``variant_id``.
    """
    w = Window.partitionBy("experiment_name").orderBy("variant_id")
    return (
        gold.where(F.col("variant_id").isNotNull())
        .select("experiment_name", "variant_id")
        .distinct()
        .withColumn("variant_code", (F.dense_rank().over(w) - 1).cast("int"))
    )


# ---------------------------------------------------------------------------
# Grid
# ---------------------------------------------------------------------------


def _cut(df: DataFrame) -> DataFrame:
    """Small tables read several times: reliable checkpoint in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def _spread(totals: DataFrame) -> DataFrame:
    """Totals dealt out by variant over as many tasks as the cluster has cores.

    An explicit count: the rows are tiny but each one is a variant's grid, so
    adaptive execution must not coalesce them into one task.
    """
    spark = totals.sparkSession
    limit = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        cores = spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - no context handle (Spark Connect)
        cores = limit
    return totals.repartition(max(1, min(limit, cores)), "experiment_name", "variant_id")


def _first_box(totals: DataFrame) -> DataFrame:
    """(experiment, first grid's ends and steps).

    Beyond the variants' own log-odds every variant with conversions (without
    them, on the other side) takes a nat off per unit of u, the Jacobian
    one more; toward small alpha + beta every variant with both does.
    """
    s, n = F.col("purchases"), F.col("users")
    odds = F.log((s + F.lit(0.5)) / (n - s + F.lit(0.5)))
    per = totals.groupBy("experiment_name").agg(
        F.min(odds).alias("_lo"),
        F.max(odds).alias("_hi"),
        F.count_if(s > 0).alias("_some"),
        F.count_if(s < n).alias("_rest"),
        F.count_if((s > 0) & (s < n)).alias("_both"),
        F.count(F.lit(1)).alias("_k"),
    )
    u0 = F.col("_lo") - 2 - F.lit(FALL_OFF) / (F.col("_some") + 1)
    u1 = F.col("_hi") + 2 + F.lit(FALL_OFF) / (F.col("_rest") + 1)
    v0 = F.lit(-3.0) - F.lit(FALL_OFF) / (F.col("_both") + 2)
    v1 = F.log((F.col("_k") + 1) * F.lit(SUM_PER_VARIANT))
    return per.select(
        "experiment_name",
        u0.alias("_u0"),
        ((u1 - u0) / F.lit(GRID_POINTS - 1)).alias("_du"),
        v0.alias("_v0"),
        ((v1 - v0) / F.lit(GRID_POINTS - 1)).alias("_dv"),
    )


def _points(totals: DataFrame, box: DataFrame, prior_rate: float) -> DataFrame:
    """One row per (experiment, grid point) with its normalised weight."""
    p = GRID_POINTS
    cells = _spread(totals.join(box, "experiment_name")).selectExpr("*", f"explode(sequence(0, {p * p - 1})) AS grid_id")
    cells = cells.selectExpr(
        "experiment_name", "grid_id", "_du", "_dv", "purchases", "users",
        f"_u0 + (grid_id div {p}) * _du AS _u", f"_v0 + (grid_id % {p}) * _dv AS _v",
    )
    cells = cells.selectExpr("*", "exp(_v) * exp(_u) / (exp(_u) + 1D) AS alpha", "exp(_v) / (exp(_u) + 1D) AS beta")
    cells = cells.selectExpr("*", "alpha + purchases AS _a", "beta + (users - purchases) AS _b")
    points = cells.groupBy("experiment_name", "grid_id").agg(
        *[F.first(c).alias(c) for c in ("_u", "_v", "_du", "_dv", "alpha", "beta")],
        F.sum(F.expr(ln_beta_text("_a", "_b"))).alias("_l"),
        F.count(F.lit(1)).alias("_k"),
    )
    log_weight = f"_l - _k * {ln_beta_text('alpha', 'beta')} - {prior_rate!r}D * (alpha + beta) + ln(alpha) + ln(beta)"
    points = points.selectExpr("experiment_name", "grid_id", "_u", "_v", "_du", "_dv", "alpha", "beta", f"{log_weight} AS _lw")
    w = Window.partitionBy("experiment_name")  # one experiment's grid: a fixed number of rows
    points = points.withColumn("_w", F.exp(F.col("_lw") - F.max("_lw").over(w)))
    return points.withColumn("weight", F.col("_w") / F.sum("_w").over(w)).drop("_lw", "_w")


def _fit(totals: DataFrame, prior_rate: float) -> tuple[DataFrame, DataFrame]:
    """(totals, grid points with weights), both cut; the grid is refined until every experiment is resolved."""
    totals = _cut(_spread(totals))
    box = _first_box(totals)
    for _ in range(GRID_ROUNDS):
        points = _cut(_points(totals, box, prior_rate))
        moments = points.groupBy("experiment_name").agg(
            *[F.sum(F.col("weight") * F.col(c)).alias(f"_m{c}") for c in ("_u", "_v")],
            *[F.sum(F.col("weight") * F.col(c) * F.col(c)).alias(f"_s{c}") for c in ("_u", "_v")],
            *[F.first(c).alias(c) for c in ("_du", "_dv")],
            *[F.min(c).alias(f"_0{c}") for c in ("_u", "_v")],
        )
        for c in ("_u", "_v"):
            square = F.col(f"_s{c}") - F.col(f"_m{c}") * F.col(f"_m{c}")
            moments = moments.withColumn(f"_sd{c}", F.sqrt(F.greatest(square, F.lit(0.0))))
        resolved = (F.col("_du") <= F.lit(GRID_STEP) * F.col("_sd_u")) & (F.col("_dv") <= F.lit(GRID_STEP) * F.col("_sd_v"))
        moments = moments.withColumn("_done", resolved)
        if moments.where(~F.col("_done")).isEmpty():
            break

        def half(c: str) -> Column:
            return F.lit(GRID_SPAN) * F.greatest(F.col(f"_sd{c}"), F.col(f"_d{c[1]}") / 4)

        box = moments.select(
            "experiment_name",
            *[
                x
                for c in ("_u", "_v")
                for x in (
                    F.when(F.col("_done"), F.col(f"_0{c}")).otherwise(F.col(f"_m{c}") - half(c)).alias(f"{c}0"),
                    F.when(F.col("_done"), F.col(f"_d{c[1]}")).otherwise(2 * half(c) / F.lit(GRID_POINTS - 1)).alias(f"_d{c[1]}"),
                )
            ],
        )
    return totals, points


def posterior_weights(totals: DataFrame, prior_rate: float = S.PRIOR_RATE) -> DataFrame:
    """(experiment, grid_id) -> alpha, beta, normalised posterior weight, and
    whether the point is on the grid's outer ring (where next to no weight may be)."""
    _, points = _fit(totals, prior_rate)
    row, column = F.floor(F.col("grid_id") / GRID_POINTS), F.pmod(F.col("grid_id"), F.lit(GRID_POINTS))
    edge = row.isin(0, GRID_POINTS - 1) | column.isin(0, GRID_POINTS - 1)
    return points.select("experiment_name", "grid_id", "alpha", "beta", "weight", edge.alias("on_edge"))


def _cells(totals: DataFrame, points: DataFrame) -> DataFrame:
    """Each variant with the grid points that count, and its conditional Beta(_a, _b) at each."""
    kept = points.where(F.col("weight") >= F.lit(LEAST_WEIGHT)).select("experiment_name", "weight", "alpha", "beta")
    s, n = F.col("purchases").cast("double"), F.col("users").cast("double")
    return totals.join(kept, "experiment_name").select(
        "experiment_name",
        "variant_id",
        s.alias("_s"),
        (n - s).alias("_r"),
        "weight",
        "alpha",
        "beta",
        (F.col("alpha") + s).alias("_a"),
        (F.col("beta") + n - s).alias("_b"),
    )


def _moments(totals: DataFrame, points: DataFrame) -> DataFrame:
    """Mean and sd of theta per (experiment, variant)."""
    a, t, w = F.col("_a"), F.col("_a") + F.col("_b"), F.col("weight")
    mom = _cells(totals, points).groupBy("experiment_name", "variant_id").agg(
        (F.sum(w * a / t) / F.sum(w)).alias("_e1"),
        (F.sum(w * a * (a + F.lit(1.0)) / (t * (t + F.lit(1.0)))) / F.sum(w)).alias("_e2"),
    )
    sd = F.sqrt(F.greatest(F.col("_e2") - F.col("_e1") * F.col("_e1"), F.lit(0.0)))
    return mom.select(
        "experiment_name", "variant_id", F.col("_e1").alias("mean"), sd.alias("sd"), F.lit(S.POSTERIOR_CLASS).alias("class")
    )


def bayes_summary(gold: DataFrame, prior_rate: float = S.PRIOR_RATE, null_variants: bool = False) -> DataFrame:
    """Posterior mean and sd of each variant's conversion probability."""
    return _moments(*_fit(variant_totals(gold, null_variants=null_variants), prior_rate))


# ---------------------------------------------------------------------------
# Posterior curve: density and cumulative distribution of logit(theta)
# ---------------------------------------------------------------------------


def _curves(totals: DataFrame, points: DataFrame) -> DataFrame:
    """One row per (experiment, variant): x0 and step of the nodes, and at each node the
    density of x, its slope and the cumulative probability (arrays of CURVE + 1 values)."""
    cells = _cells(totals, points)
    ends = cells.groupBy("experiment_name", "variant_id").agg(
        *[F.first(c).alias(c) for c in ("_s", "_r")],
        (F.sum(F.col("weight") * F.col("_a")) / F.sum("weight")).alias("_ea"),
        (F.sum(F.col("weight") * F.col("_b")) / F.sum("weight")).alias("_eb"),
    )
    centre, sd = F.log(F.col("_ea") / F.col("_eb")), F.sqrt(1 / F.col("_ea") + 1 / F.col("_eb"))
    reach = {c: F.greatest(F.lit(CURVE_SPAN) * sd, F.lit(32.0) / (F.col(c) + F.lit(0.5))) for c in ("_s", "_r")}
    low = F.greatest(centre - reach["_s"], F.lit(-CURVE_END))
    high = F.least(centre + reach["_r"], F.lit(CURVE_END))
    ends = ends.select(
        F.col("experiment_name").alias("_e"), F.col("variant_id").alias("_i"), low.alias("x0"), ((high - low) / CURVE).alias("step")
    )
    same = (F.col("experiment_name") == F.col("_e")) & F.col("variant_id").eqNullSafe(F.col("_i"))
    # Every variant's cells are expanded over the nodes in the task that has the variant.
    nodes = _spread(cells.join(ends, same).select("experiment_name", "variant_id", "x0", "step", "weight", "_a", "_b"))
    nodes = nodes.selectExpr(
        "experiment_name", "variant_id", "x0", "step", "_a", "_b", f"ln(weight) - {ln_beta_text('_a', '_b')} AS _c"
    )
    nodes = nodes.selectExpr("*", f"explode(sequence(0, {CURVE})) AS node")
    nodes = nodes.selectExpr("*", "x0 + node * step AS _x").selectExpr("*", "log1p(exp(-abs(_x))) AS _p")
    nodes = nodes.selectExpr(
        "*", "exp(_c - _a * (greatest(-_x, 0D) + _p) - _b * (greatest(_x, 0D) + _p)) AS _f", "1D / (1D + exp(-_x)) AS _t"
    )
    f = nodes.groupBy("experiment_name", "variant_id", "node").agg(
        F.first("x0").alias("x0"),
        F.first("step").alias("step"),
        F.sum("_f").alias("f"),
        F.expr("sum(_f * (_a - (_a + _b) * _t))").alias("d"),
        # what lies below the first node: there the density goes like exp(a x)
        F.expr("sum(CASE WHEN node = 0 THEN _f / _a ELSE 0D END)").alias("_tail"),
    )
    w = Window.partitionBy("experiment_name", "variant_id").orderBy("node")  # one variant's curve: CURVE + 1 rows
    h = F.col("step")
    before = F.lag("f").over(w)
    slope = F.lag("d").over(w)
    panel = h / 2 * (before + F.col("f")) - h * h / 12 * (F.col("d") - slope)
    f = f.withColumn("_panel", F.when(before.isNull(), F.col("_tail")).otherwise(F.greatest(panel, F.lit(0.0))))
    f = f.withColumn("p", F.sum("_panel").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    rows = f.groupBy("experiment_name", "variant_id").agg(
        F.first("x0").alias("x0"), F.first("step").alias("step"), F.array_sort(F.collect_list(F.struct("node", "f", "d", "p"))).alias("_n")
    )
    return rows.select(
        "experiment_name", "variant_id", "x0", "step", *[F.col("_n")[c].alias(c) for c in ("f", "d", "p")]
    )


# Expressions on a curve's row, as SQL text: they are long, and text is parsed at once.

_names = itertools.count()


def _let(value: str, use: Callable[[str], str]) -> str:
    """``use(name)`` with ``name`` bound to the value, which is computed once."""
    name = f"_b{next(_names)}"
    return f"element_at(transform(array({value}), {name} -> {use(name)}), 1)"


def _between(low: str, x: str, high: str) -> str:
    return f"least(greatest({x}, {low}), {high})"


def _cubic(y0: str, y1: str, m0: str, m1: str, t: str) -> tuple[str, str]:
    """Value and slope at t in [0, 1] of the cubic with these end values and slopes."""
    c2 = f"(3D * ({y1} - {y0}) - 2D * {m0} - {m1})"
    c3 = f"(2D * ({y0} - {y1}) + {m0} + {m1})"
    return f"({y0} + {t} * ({m0} + {t} * ({c2} + {t} * {c3})))", f"({m0} + {t} * (2D * {c2} + 3D * {t} * {c3}))"


def _panel_ends(j: str) -> tuple[str, str, str, str]:
    """Cumulative probabilities and their slopes at both ends of panel j."""
    return f"p[{j}]", f"p[{j} + 1]", f"(step * f[{j}])", f"(step * f[{j} + 1])"


def _panel_of(q: str) -> str:
    """The panel (0-based) whose cumulative probabilities enclose q, by bisection of the node array."""
    middle = "shiftright(a.lo + a.hi, 1)"
    halve = f"(a, i) -> if(p[{middle}] <= {q}, struct({middle} AS lo, a.hi AS hi), struct(a.lo AS lo, {middle} AS hi))"
    steps = CURVE.bit_length() - 1
    return f"least(aggregate(sequence(1, {steps}), struct(0 AS lo, {CURVE} AS hi), {halve}).lo, {CURVE - 1})"


def _quantile(q: str) -> str:
    """Place on the nodes (panel + fraction) at which a curve's cumulative probability is q."""

    def inside(j: str) -> str:
        ends = _panel_ends(j)
        y0, y1 = ends[:2]
        first = f"if({y1} > {y0}, ({q} - {y0}) / ({y1} - {y0}), 0.5D)"
        y, m = _cubic(*ends, "t")
        newton = f"(t, i) -> {_between('0D', f't - ({y} - {q}) / greatest({m}, 1e-300D)', '1D')}"
        return f"({j} + aggregate(sequence(1, {NEWTON_STEPS}), {_between('0D', first, '1D')}, {newton}))"

    return _let(_panel_of(q), inside)


def _cumulative(place: str) -> str:
    """Cumulative probability at a place on the nodes; 0 and 1 beyond the ends."""
    inside = _let(
        _between("0", f"cast(floor({place}) AS int)", str(CURVE - 1)), lambda j: _cubic(*_panel_ends(j), f"({place} - {j})")[0]
    )
    return f"CASE WHEN {place} <= 0 THEN 0D WHEN {place} >= {CURVE} THEN 1D ELSE {inside} END"


def _theta(place: str) -> str:
    return f"(1D / (1D + exp(-(x0 + {place} * step))))"


def _place(theta: str) -> str:
    return f"((ln({theta} / (1D - {theta})) - x0) / step)"


def _intervals(curves: DataFrame, prob: float) -> DataFrame:
    """Shortest interval of probability ``prob`` per curve.

    The width as a function of the lower end is tried at every node, then at
    FINE places to the node around the best one, and its minimum taken by the
    parabola through the last three. Intervals that begin at 0 or end at 1
    (no conversions, or nothing but conversions) are candidates as well.
    """
    p = f"{prob!r}D"

    def width(place: str) -> str:
        # a lower end with less than prob above it is no candidate
        return _let(
            f"{_cumulative(place)} + {p}",
            lambda q: f"if({q} >= 1D, 2D, {_let(_quantile(q), lambda to: f'{_theta(to)} - {_theta(place)}')})",
        )

    tried = f"transform(sequence(1, {CURVE - 1}), i -> {_let('cast(i AS double)', width)})"
    first = "cast(array_position({w}, array_min({w})) AS {kind})"
    near = f"transform(sequence(0, {2 * FINE}), k -> _i - 1D + k / {float(FINE)!r}D)"
    best = (
        curves.selectExpr("*", f"{tried} AS _w")
        .selectExpr("experiment_name", "variant_id", "x0", "step", "f", "p", f"{first.format(w='_w', kind='double')} AS _i")
        .selectExpr("*", f"{near} AS _at")
        .selectExpr("*", f"transform(_at, a -> {width('a')}) AS _w")
        .selectExpr("*", f"{_between('2', first.format(w='_w', kind='int'), str(2 * FINE))} AS _k")
        .selectExpr("*", "_w[_k - 2] AS _l", "_w[_k - 1] AS _m", "_w[_k] AS _r")
    )
    bend = "(_l - 2D * _m + _r)"
    shift = f"if({bend} > 0 AND _l < 2 AND _r < 2, {_between('-1D', f'(_l - _r) / (2D * {bend})', '1D')}, 0D)"
    best = best.selectExpr("*", f"_at[_k - 1] + {shift} / {float(FINE)!r}D AS _low").selectExpr("*", f"{_cumulative('_low')} + {p} AS _q")
    inner = f"struct(if(_q >= 1D, 2D, {_theta('_to')} - {_theta('_low')}) AS width, {_theta('_low')} AS low, {_theta('_to')} AS high)"
    bottom = "struct(_bottom AS width, 0D AS low, _bottom AS high)"
    top = "struct(1D - _top AS width, _top AS low, 1D AS high)"
    found = best.selectExpr("*", f"{_quantile('_q')} AS _to", f"{_quantile(p)} AS _b", f"{_quantile(f'(1D - {p})')} AS _t")
    found = found.selectExpr("*", f"{_theta('_b')} AS _bottom", f"{_theta('_t')} AS _top")
    found = found.selectExpr("experiment_name", "variant_id", f"array_min(array({inner}, {bottom}, {top})) AS _h")
    return found.select("experiment_name", "variant_id", F.col("_h.low").alias("hdi_low"), F.col("_h.high").alias("hdi_high"))


def bayes_hdi(gold: DataFrame, prob: float = S.HDI_PROB, prior_rate: float = S.PRIOR_RATE, null_variants: bool = False) -> DataFrame:
    """Exact highest-density interval of each variant's conversion probability."""
    return _intervals(_cut(_curves(*_fit(variant_totals(gold, null_variants=null_variants), prior_rate))), prob)


def interval_mass(gold: DataFrame, intervals: DataFrame, prior_rate: float = S.PRIOR_RATE, null_variants: bool = False) -> DataFrame:
    """(experiment, variant, mass): posterior probability inside each interval (hdi_low, hdi_high), by
    incomplete beta functions of the conditional posteriors; independent of the curves."""
    cells = _cells(*_fit(variant_totals(gold, null_variants=null_variants), prior_rate))
    ends = intervals.select(F.col("experiment_name").alias("_e"), F.col("variant_id").alias("_i"), "hdi_low", "hdi_high")
    same = (F.col("experiment_name") == F.col("_e")) & F.col("variant_id").eqNullSafe(F.col("_i"))
    # A cell is two continued fractions: the cells of a variant are spread as well.
    cells = cells.join(ends, same).repartition(int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    inside = beta_cdf(F.col("hdi_high"), F.col("_a"), F.col("_b")) - beta_cdf(F.col("hdi_low"), F.col("_a"), F.col("_b"))
    return cells.groupBy("experiment_name", "variant_id").agg(
        (F.sum(F.col("weight") * inside) / F.sum("weight")).alias("mass")
    )


def posterior_bins(
    gold: DataFrame,
    bins: int = 30,
    outside: float = 1e-4,
    prior_rate: float = S.PRIOR_RATE,
    null_variants: bool = False,
) -> DataFrame:
    """Posterior probability of ``bins`` equal-width bins per variant (the data behind the posterior plot).

    The bins span the ``outside`` and 1 - ``outside`` quantiles; the first and
    the last one also hold what lies beyond.
    """
    curves = _cut(_curves(*_fit(variant_totals(gold, null_variants=null_variants), prior_rate)))
    curves = curves.selectExpr("*", f"{_quantile(f'{outside!r}D')} AS _a", f"{_quantile(f'{1.0 - outside!r}D')} AS _b")
    curves = curves.selectExpr("*", f"{_theta('_a')} AS _lo", f"{_theta('_b')} AS _hi", f"explode(sequence(1, {bins})) AS bin")
    wide = f"((_hi - _lo) / {bins})"
    curves = curves.selectExpr("*", f"_lo + (bin - 1) * {wide} AS bin_low", f"_lo + bin * {wide} AS bin_high")
    curves = curves.selectExpr("*", f"{_place('bin_low')} AS _l", f"{_place('bin_high')} AS _h")
    mass = f"if(bin = {bins}, 1D, {_cumulative('_h')}) - if(bin = 1, 0D, {_cumulative('_l')}) AS mass"
    return curves.selectExpr("experiment_name", "variant_id", "bin", "bin_low", "bin_high", mass)


def uniform(seed: int, *counter: str) -> Column:
    """Number in (0, 1) from the first 52 bits of MD5 of ``seed`` and the counter's columns (null as ``null``)."""
    parts = [F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in counter]]
    digits = F.substring(F.md5(F.concat_ws("\t", *parts).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def posterior_draws(
    gold: DataFrame,
    n: int = S.POSTERIOR_SAMPLES,
    seed: int = 0,
    prior_rate: float = S.PRIOR_RATE,
    null_variants: bool = False,
) -> DataFrame:
    """``n`` posterior draws of theta per (experiment, variant): quantiles of hashed counters.

    The same seed gives the same draws on any cluster and in any retry; more
    draws only add to fewer.
    """
    curves = _spread(_cut(_curves(*_fit(variant_totals(gold, null_variants=null_variants), prior_rate))))
    draws = curves.withColumn("draw", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))
    draws = draws.withColumn("_u", uniform(seed, "experiment_name", "variant_id", "draw"))
    draws = draws.selectExpr("*", f"{_quantile('_u')} AS _x")
    return draws.selectExpr("experiment_name", "variant_id", "draw", f"{_theta('_x')} AS theta")


# ---------------------------------------------------------------------------
# Intervals and histograms of given draws, comparison
# ---------------------------------------------------------------------------

def hdi(draws: DataFrame, prob: float = S.HDI_PROB, value: str = "theta") -> DataFrame:
    """Shortest interval holding ``floor(prob * n) + 1`` sorted draws.

    Sorted draws x_0..x_{n-1}, k = floor(prob n): the minimum of
    x_{i+k} - x_i, first minimum on ties. One aggregate per variant: the
    sorted draws of one variant form one array (its length is the number of
    draws, a parameter), and the widths are array expressions on it.
    """
    key = ["experiment_name", "variant_id"]
    per = draws.groupBy(*key).agg(F.array_sort(F.collect_list(value)).alias("_x"))
    n = F.size("_x")
    k = F.least(F.floor(n * F.lit(prob)).cast("int"), n - F.lit(1))
    per = per.withColumn("_k", k)
    widths = F.transform(
        F.sequence(F.lit(0), n - F.col("_k") - F.lit(1)),
        lambda i: F.element_at("_x", i + F.col("_k") + F.lit(1)) - F.element_at("_x", i + F.lit(1)),
    )
    per = per.withColumn("_w", widths)
    first = F.array_position("_w", F.array_min("_w")).cast("int")
    return per.select(
        *key,
        F.element_at("_x", first).alias("hdi_low"),
        F.element_at("_x", first + F.col("_k")).alias("hdi_high"),
    )


def posterior_histogram(draws: DataFrame, bins: int = 30) -> DataFrame:
    """Counts of draws in ``bins`` equal-width bins per variant (the data
    behind the posterior plot). Bin edges come from the variant's min/max
    (a window over one variant's draws)."""
    key = ["experiment_name", "variant_id"]
    w = Window.partitionBy(*key)
    ranged = draws.withColumn("_lo", F.min("theta").over(w)).withColumn("_hi", F.max("theta").over(w))
    # width_bucket puts the maximum in bin bins + 1; fold it into the last bin.
    bucket = F.least(F.width_bucket(F.col("theta"), F.col("_lo"), F.col("_hi"), F.lit(bins)), F.lit(bins))
    return (
        ranged.withColumn("bin", F.when(F.col("_hi") > F.col("_lo"), bucket).otherwise(F.lit(1)).cast("int"))
        .groupBy(*key, "bin")
        .agg(F.count(F.lit(1)).alias("draws"), F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"))
        .withColumn("bin_low", F.col("_lo") + (F.col("bin") - 1) * (F.col("_hi") - F.col("_lo")) / bins)
        .withColumn("bin_high", F.col("_lo") + F.col("bin") * (F.col("_hi") - F.col("_lo")) / bins)
        .drop("_lo", "_hi")
    )


def smallest_id(col: str, over) -> Column:
    """Smallest id of a window: as numbers if all of them are whole numbers, else as text."""
    number = F.col(col).try_cast("decimal(38,0)")
    whole = F.min(F.coalesce(number.cast("string") == F.col(col), F.col(col).isNull())).over(over)
    return F.when(whole, F.min(number).over(over).cast("string")).otherwise(F.min(col).over(over))


def intervals_disjoint(c_lo: Column, c_hi: Column, t_lo: Column, t_hi: Column) -> Column:
    """Significant = the two intervals do not intersect (touching ends
    intersect)."""
    return ~((c_hi >= t_lo) & (c_lo <= t_hi))


def bayes_comparison(summary: DataFrame, control: dict | None = None) -> DataFrame:
    """Each non-control variant against its experiment's control.

    ``summary`` has experiment_name, variant_id, mean, hdi_low, hdi_high.
    Control: ``control[experiment]`` when given and among its variants, else
    the smallest variant_id (``control_found`` is false if the given one is
    missing). The control's values reach the other variants through a window
    over the experiment's variants (a partition of one experiment's variants),
    so the summary is read once.
    """
    w = Window.partitionBy("experiment_name")
    base = summary.withColumn("_given", F.lit(None).cast("string"))
    if control:
        ctl = summary.sparkSession.createDataFrame(list(control.items()), "experiment_name string, _given string")
        # The control table has one row per given experiment: its size is the
        # caller's dict.
        base = summary.join(F.broadcast(ctl), "experiment_name", "left")
    there = F.max(F.col("variant_id") == F.col("_given")).over(w)
    base = base.withColumn("control_found", F.col("_given").isNull() | F.coalesce(there, F.lit(False)))
    base = base.withColumn(
        "_control",
        F.when(F.col("control_found") & F.col("_given").isNotNull(), F.col("_given")).otherwise(smallest_id("variant_id", w)),
    )
    is_ctl = F.col("variant_id") == F.col("_control")

    def ctl_value(c):
        return F.max(F.when(is_ctl, F.col(c))).over(w)

    pairs = (
        base.withColumn("_has_control", F.max(is_ctl).over(w))
        .withColumn("control_mean", ctl_value("mean"))
        .withColumn("control_hdi_low", ctl_value("hdi_low"))
        .withColumn("control_hdi_high", ctl_value("hdi_high"))
        .where(F.col("_has_control") & ~is_ctl)
    )
    sig = intervals_disjoint(
        F.col("control_hdi_low"), F.col("control_hdi_high"), F.col("hdi_low"), F.col("hdi_high")
    )
    return pairs.select(
        "experiment_name",
        F.col("variant_id").alias("variant"),
        F.col("_control").alias("control"),
        "control_mean",
        "control_hdi_low",
        "control_hdi_high",
        F.col("mean").alias("test_mean"),
        F.col("hdi_low").alias("test_hdi_low"),
        F.col("hdi_high").alias("test_hdi_high"),
        "control_found",
        sig.alias("significant"),
        F.when(
            sig,
            F.format_string(S.COMPARISON_SIGNIFICANT, F.col("variant_id")),
        )
        .otherwise(
            F.format_string(S.COMPARISON_NOT_SIGNIFICANT, F.col("variant_id"))
        )
        .alias("conclusion"),
    )


def bayes_report(
    gold: DataFrame,
    prob: float = S.HDI_PROB,
    prior_rate: float = S.PRIOR_RATE,
    null_variants: bool = False,
) -> DataFrame:
    """Mean, sd and highest-density interval of every variant, from one fit of the grid."""
    fit = _fit(variant_totals(gold, null_variants=null_variants), prior_rate)
    intervals = _intervals(_cut(_curves(*fit)), prob).select(
        F.col("experiment_name").alias("_e"), F.col("variant_id").alias("_v"), "hdi_low", "hdi_high"
    )
    cond = (F.col("experiment_name") == F.col("_e")) & F.col("variant_id").eqNullSafe(F.col("_v"))
    return _moments(*fit).join(intervals, cond).drop("_e", "_v")
