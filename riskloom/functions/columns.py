"""Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def div(a, b):
    """a / b with null for a zero divisor, also where the session raises errors for it."""
    if isinstance(b, Column):
        return F.try_divide(a if isinstance(a, Column) else F.lit(a), b)
    return a / b


def corr(x, y) -> Column:
    """Correlation over the complete pairs; null where a side does not vary."""
    x = x if isinstance(x, Column) else F.col(x)
    y = y if isinstance(y, Column) else F.col(y)
    return div(F.covar_pop(x, y), F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y)))


def screen(c: Column, fill: float | None = None) -> Column:
    """NaN and infinities to null, or to ``fill``."""
    c = c.cast("double")
    ok = F.when(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), c)
    return ok if fill is None else F.coalesce(ok, F.lit(float(fill)))


def symmetric_clip(c: Column, upper: float = 1000.0) -> Column:
    """Clip ln(1 + x) - 1 to plus or minus ln(1 + upper) - 1 and map back."""
    b = F.log1p(F.lit(float(upper))) - 1
    return F.exp(F.greatest(-b, F.least(b, F.log1p(c) - 1)) + 1) - 1


def round_half_away(c: Column, dp: int) -> Column:
    """Values under 10/10^dp become zero, the rest round half away from zero."""
    p = float(10**dp)
    small = F.lit(10.0 / p)
    x = F.when(F.abs(c) < small, F.lit(0.0)).otherwise(F.signum(c) * F.floor(F.abs(c) * p + 0.5) / p)
    return F.when(F.abs(x) < small, F.lit(0.0)).otherwise(x)


def is_cash(c: Column, prefix: str = "CSH_") -> Column:
    """Cash ids carry a fixed prefix."""
    return c.startswith(prefix)


def lifecycle_weight(dt: Column, full_dt: Column, fade_dt: Column, fade_days: int = 60, ramp_days: int = 30, cap_days: int = 480) -> Column:
    """Weight of a market: halving while it fades out, doubling up to its full date, else 1.

    A date between both milestones follows the nearer one.
    """
    to_full, since_fade = F.datediff(full_dt, dt), F.datediff(dt, fade_dt)
    into = F.pow(F.lit(2.0), -F.least(to_full, F.lit(cap_days)) / float(ramp_days))
    out = F.pow(F.lit(2.0), -since_fade / float(fade_days))
    ramping = (to_full > 0) & (to_full <= F.abs(since_fade))
    fading = (since_fade >= 0) & (F.abs(to_full) > since_fade)
    return F.when(ramping, into).when(fading, out).otherwise(F.lit(1.0))


def level_log(x: Column, a: float) -> Column:
    """x/a below a and 1 + ln(x/a) above, times a: linear near zero, logarithmic beyond."""
    r = x / F.lit(float(a))
    return F.when(x < a, r).otherwise(1 + F.log(r)) * F.lit(float(a))


def clip(c: Column, lo, hi) -> Column:
    """Clip to bounds; a null value stays null."""
    lo = lo if isinstance(lo, Column) else F.lit(lo)
    hi = hi if isinstance(hi, Column) else F.lit(hi)
    return F.when(c.isNotNull(), F.greatest(lo, F.least(hi, c)))
