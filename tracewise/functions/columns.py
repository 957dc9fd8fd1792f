"""Null-safe column expressions shared by every operator.

All of these are built-in Spark expressions, so they stay inside
whole-stage codegen.  ANSI mode is on in Spark 4: a plain ``x / 0`` throws,
so every ratio goes through ``try_divide`` (NULL on a zero denominator).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's behaviour).
MIN_STD = 1e-6          # std floor used by the baseline z-score
SIGMA_K = 3.0           # three-sigma rule
IQR_K = 3.0             # IQR fence multiplier
CORR_THRESHOLD = 0.7    # correlation graph / chain pruning threshold


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num, den) -> Column:
    """``num / den``; NULL when ``den`` is 0 or NULL."""
    return F.try_divide(col(num), col(den))


def floor_std(s, floor: float = MIN_STD) -> Column:
    """``clip(lower=floor)`` that keeps an undefined (NULL) std undefined.

    Plain ``greatest`` skips NULL and would turn an undefined std into the
    floor value.
    """
    s = col(s)
    return F.when(s.isNotNull(), F.greatest(s, F.lit(floor)))


def nan_to_null(c) -> Column:
    c = col(c)
    return F.when(~F.isnan(c), c)


def weekday_mon0(ts) -> Column:
    """Day of week with Monday = 0 (pandas ``dt.dayofweek``)."""
    return F.weekday(col(ts))


def pearson(x, y) -> Column:
    """Population Pearson correlation as an aggregate; NULL for a constant side.

    ``F.corr`` raises DIVIDE_BY_ZERO under ANSI for a constant column, so the
    formula is spelled out with ``try_divide``.
    """
    x, y = col(x), col(y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def pearson_from_sums(n, sx, sy, sxx, syy, sxy, tolerance: float = 1e-12) -> Column:
    """Pearson r from the power sums of standardised series, within [-1, 1];
    NULL when either side has no variance beyond rounding."""
    n, sx, sy, sxx, syy, sxy = map(col, (n, sx, sy, sxx, syy, sxy))
    vx = n * sxx - sx * sx
    vy = n * syy - sy * sy
    least = F.lit(tolerance) * n * n
    r = (n * sxy - sx * sy) / F.sqrt(vx * vy)
    return F.when((vx > least) & (vy > least), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))


def _session_tz() -> str:
    from pyspark.sql import SparkSession
    s = SparkSession.getActiveSession()
    return s.conf.get("spark.sql.session.timeZone") if s is not None else "UTC"


def as_utc_instant(c) -> Column:
    """``timestamp_ntz`` wall-clock -> the instant with that UTC wall-clock,
    whatever the session time zone (watermarks and epoch arithmetic need an
    instant; the data's timestamps are naive UTC)."""
    return F.from_utc_timestamp(col(c).cast("timestamp"), _session_tz())


def to_naive(c) -> Column:
    """Inverse of ``as_utc_instant``: instant -> UTC wall-clock ``timestamp_ntz``."""
    return F.to_utc_timestamp(col(c), _session_tz()).cast("timestamp_ntz")


def epoch_seconds(c) -> Column:
    """Epoch seconds of a naive UTC timestamp (session-zone independent)."""
    return F.unix_seconds(as_utc_instant(c))


def seconds_between(later, earlier) -> Column:
    """Exact seconds between two naive timestamps as double."""
    return (F.unix_micros(as_utc_instant(later)) - F.unix_micros(as_utc_instant(earlier))) / F.lit(1e6)


def round_doubles(df, places: int = 4):
    """Round every double column (used when comparing with an oracle).

    Two steps, 8 then ``places`` decimals, so that last-bit differences
    between engines (31.868749999 vs 31.86875) round the same way."""
    out = []
    for f in df.schema.fields:
        c = F.col("`" + f.name.replace("`", "``") + "`")
        if f.dataType.typeName() in ("double", "float"):
            out.append(F.round(F.round(c, 8), places).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)
