"""Least squares with one regressor and an intercept, as mergeable aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.student import slope_p_value

MIN_PAIRS = 6  # fixed value: fewer complete pairs give no fit, only the count


def _moments(x: str, y: str, name: str) -> list[Column]:
    return [
        F.regr_count(y, x).alias(f"{name}_n"),
        F.regr_slope(y, x).alias(f"{name}_slope"),
        F.regr_r2(y, x).alias(f"{name}_fit"),
        F.regr_syy(y, x).alias(f"{name}_spread"),
    ]


def ols(
    df: DataFrame,
    x: str,
    responses: Mapping[str, str],
    by: Sequence[str] = (),
    extra: Sequence[Column] = (),
    min_pairs: int = MIN_PAIRS,
) -> DataFrame:
    """Fit every response on ``x`` in one pass, per group or overall.

    ``responses`` maps a name to its column; output columns are ``by``, ``extra`` and per name
    ``{name}_n``, ``_beta``, ``_r2``, ``_pvalue``. Pairs with a null are skipped. Fewer than
    ``min_pairs`` pairs or a constant regressor give null statistics; a constant response has
    slope 0 and no R^2 or p.
    """
    names = list(responses)
    aggs = [agg for name, y in responses.items() for agg in _moments(x, y, name)]
    sums = df.groupBy(*by).agg(*extra, *aggs)
    kept = [c for c in sums.columns if not any(c.startswith(f"{n}_") for n in names)]

    def gated(name: str, value: Column) -> Column:
        return F.when(F.col(f"{name}_n") >= min_pairs, value)

    fitted = sums.select(
        *kept,
        *[
            col
            for n in names
            for col in (
                F.col(f"{n}_n"),
                gated(n, F.col(f"{n}_slope")).alias(f"{n}_beta"),
                gated(n, F.when(F.col(f"{n}_spread") > 0, F.col(f"{n}_fit"))).alias(f"{n}_r2"),
            )
        ],
    )
    return fitted.select(
        *kept,
        *[
            col
            for n in names
            for col in (
                F.col(f"{n}_n"),
                F.col(f"{n}_beta"),
                F.col(f"{n}_r2"),
                slope_p_value(f"{n}_n", f"{n}_r2").alias(f"{n}_pvalue"),
            )
        ],
    )


def ols_long(fits: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Wide fits to one row per response: keep, response, n, beta, r_squared, p_value."""
    cells = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(n).alias("response"),
                    F.col(f"{n}_n").alias("n"),
                    F.col(f"{n}_beta").alias("beta"),
                    F.col(f"{n}_r2").alias("r_squared"),
                    F.col(f"{n}_pvalue").alias("p_value"),
                )
                for n in names
            ]
        )
    ).alias("_fit")
    return fits.select(cells, *keep).select("_fit.*", *keep)


def with_trend_line(df: DataFrame, x: str, y: str, out: str = "trend") -> DataFrame:
    """Complete pairs with the fitted value of one line over all of them.

    Slope and intercept come back as one scalar subquery, so the points are not joined.
    """
    points = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    line = points.agg(
        F.struct(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))
    ).scalar()
    return (
        points.withColumn("_line", line)
        .withColumn(out, F.col("_line.intercept") + F.col("_line.slope") * F.col(x))
        .drop("_line")
    )
