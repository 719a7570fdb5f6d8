"""Scalar expressions over one bar.  All stay inside code generation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# RSI limits, and half a candle's width as a share of the bar length.
OVERBOUGHT = 70.0
OVERSOLD = 30.0
CANDLE_HALF_WIDTH = 0.4


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def typical_price(high="high", low="low", close="close") -> Column:
    return (col(high) + col(low) + col(close)) / F.lit(3.0)


def repaired_high(open="open", high="high", close="close") -> Column:
    """Raise the high to the larger end of the body when it lies below it."""
    return F.greatest(col(high), col(open), col(close))


def repaired_low(open="open", low="low", close="close") -> Column:
    return F.least(col(low), col(open), col(close))


def path_from_returns(start: str | Column, returns: str | Column) -> Column:
    """Prices reached by compounding an array of returns from ``start``."""
    first = F.array(col(start))
    grown = F.aggregate(
        col(returns),
        first,
        lambda acc, r: F.concat(acc, F.array(F.element_at(acc, -1) * (F.lit(1.0) + r))),
    )
    return F.slice(grown, F.lit(2), F.greatest(F.size(grown) - 1, F.lit(0)))


def path_high(open: str | Column, path: str | Column, close: str | Column) -> Column:
    return F.array_max(F.concat(F.array(col(open)), col(path), F.array(col(close))))


def path_low(open: str | Column, path: str | Column, close: str | Column) -> Column:
    return F.array_min(F.concat(F.array(col(open)), col(path), F.array(col(close))))


def candle_color(open="open", close="close") -> Column:
    return F.when(col(close) >= col(open), F.lit("green")).otherwise(F.lit("red"))


def body_height(open="open", close="close") -> Column:
    return F.abs(col(close) - col(open))


def body_base(open="open", close="close") -> Column:
    return F.least(col(open), col(close))


def scaled_level(value: Column, low: Column, high: Column, levels: int) -> Column:
    """Min-max scale to an integer level 0..levels, truncating; a flat series is 0."""
    share = F.try_divide(value - low, high - low)
    return F.coalesce(F.floor(share * F.lit(float(levels))), F.lit(0)).cast("bigint")


def is_overbought(rsi="rsi") -> Column:
    return col(rsi) > F.lit(OVERBOUGHT)


def is_oversold(rsi="rsi") -> Column:
    return col(rsi) < F.lit(OVERSOLD)


# The bar rules by name, in the order they are reported.
def bar_rules() -> dict[str, Column]:
    o, h, l, c, v = (F.col(n) for n in ("open", "high", "low", "close", "volume"))
    zero = F.lit(0)
    return {
        "high_ge_open": h >= o,
        "high_ge_close": h >= c,
        "high_ge_low": h >= l,
        "low_le_open": l <= o,
        "low_le_close": l <= c,
        "open_positive": o > zero,
        "high_positive": h > zero,
        "low_positive": l > zero,
        "close_positive": c > zero,
        "volume_non_negative": v >= zero,
    }


def polynomial(x: str, coefficients: Sequence[float]) -> str:
    """Horner form as SQL; coefficients run from the highest power down."""
    acc = f"{coefficients[0]!r}D"
    for c in coefficients[1:]:
        acc = f"({acc} * {x} + {c!r}D)"
    return acc


# Wichura, Algorithm AS 241 (PPND16), Applied Statistics 37 (1988).
# Highest power first: numerator and denominator of the centre, the near tail
# and the far tail.
NORMAL_CENTRE = (
    (2.5090809287301226727e3, 3.3430575583588128105e4, 6.7265770927008700853e4,
     4.5921953931549871457e4, 1.3731693765509461125e4, 1.9715909503065514427e3,
     1.3314166789178437745e2, 3.3871328727963666080e0),
    (5.2264952788528545610e3, 2.8729085735721942674e4, 3.9307895800092710610e4,
     2.1213794301586595867e4, 5.3941960214247511077e3, 6.8718700749205790830e2,
     4.2313330701600911252e1, 1.0),
)
NORMAL_NEAR = (
    (7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1,
     1.27045825245236838258e0, 3.64784832476320460504e0, 5.76949722146069140550e0,
     4.63033784615654529590e0, 1.42343711074968357734e0),
    (1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2,
     1.48103976427480074590e-1, 6.89767334985100004550e-1, 1.67638483018380384940e0,
     2.05319162663775882187e0, 1.0),
)
NORMAL_FAR = (
    (2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3,
     2.65321895265761230930e-2, 2.96560571828504891230e-1, 1.78482653991729133580e0,
     5.46378491116411436990e0, 6.65790464350110377720e0),
    (2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5,
     7.86869131145613259100e-4, 1.48753612908506148525e-2, 1.36929880922735805310e-1,
     5.99832206555887937690e-1, 1.0),
)


def with_normal_quantile(df: DataFrame, p: str, name: str) -> DataFrame:
    """Add the inverse of the standard normal distribution function of 0 < p < 1.

    The steps are separate columns: each is used by several polynomials, and one
    nested expression would outgrow generated code.
    """

    def ratio(x: str, pair) -> str:
        return f"{polynomial(x, pair[0])} / {polynomial(x, pair[1])}"

    size = f"IF(_r <= 5.0D, {ratio('_near', NORMAL_NEAR)}, {ratio('_far', NORMAL_FAR)})"
    return (
        df.selectExpr("*", f"`{p}` - 0.5D AS _q")
        .selectExpr(
            "*",
            f"sqrt(-ln(IF(_q <= 0, `{p}`, 1.0D - `{p}`))) AS _r",
            "0.180625D - _q * _q AS _centre",
        )
        .selectExpr("*", "_r - 1.6D AS _near", "_r - 5.0D AS _far")
        .selectExpr(
            "*",
            f"CASE WHEN abs(_q) <= 0.425D THEN _q * {ratio('_centre', NORMAL_CENTRE)}"
            f" WHEN _q < 0 THEN -({size}) ELSE {size} END AS `{name}`",
        )
        .drop("_q", "_r", "_centre", "_near", "_far")
    )
