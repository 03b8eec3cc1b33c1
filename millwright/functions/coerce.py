"""Null-safe column helpers.

Spark 4 runs with ANSI semantics: a bad cast, a division by zero or an
unparseable timestamp raises.  The source system coerces all of these to
missing values, so every helper here uses the ``try_*`` family and converts
NaN to null so that only one notion of "missing" exists inside the engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col_or(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    c = col_or(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def finite_or_null(c) -> Column:
    """NaN and +/-inf become null."""
    c = col_or(c)
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(c)


def to_double(c) -> Column:
    """String/number -> double; anything unparseable becomes null (never NaN)."""
    return nan_to_null(col_or(c).try_cast("double"))


def to_timestamp(c) -> Column:
    """Any ISO-8601 shape -> timestamp, unparseable -> null."""
    return col_or(c).try_cast("timestamp")


def clip(c, lo: float | None = None, hi: float | None = None) -> Column:
    """Null-preserving clamp.

    ``greatest``/``least`` skip nulls (a null input would come back as the
    bound), so the null branch is explicit.
    """
    c = col_or(c)
    out = c
    if hi is not None:
        out = F.least(F.lit(float(hi)), out)
    if lo is not None:
        out = F.greatest(F.lit(float(lo)), out)
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(out)


def clip01(c) -> Column:
    return clip(c, 0.0, 1.0)


def clamp01(c) -> Column:
    """Clamp of a column that can't be null (a null would come back as 0): ``clip01`` names its input twice."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), col_or(c)))


def safe_div(num, den) -> Column:
    """Division that yields null on a zero or null denominator."""
    return F.try_divide(col_or(num).cast("double"), col_or(den).cast("double"))


def with_absent(df, defaults: dict, dtype: T.DataType | None = None):
    """Add columns that are missing from ``df`` with a literal default."""
    missing = {k: (F.lit(v).cast(dtype) if dtype is not None else F.lit(v))
               for k, v in defaults.items() if k not in df.columns}
    return df.withColumns(missing) if missing else df


def with_defaults(df, defaults: dict):
    """Absent columns get the default; present null values get it too."""
    out = with_absent(df, defaults)
    return out.withColumns({k: F.coalesce(F.col(k), F.lit(v)) for k, v in defaults.items()})


def identity_struct(df) -> Column:
    """Row identity of a record: entity id, machine/line/station, timestamp.

    Absent columns come back as null so every rule shares one layout.
    """
    def pick(name, cast="string"):
        return F.col(name).cast(cast) if name in df.columns else F.lit(None).cast(cast)

    return [
        pick("id").alias("entity_id"),
        pick("machine_id").alias("machine_id"),
        pick("line_id").alias("line_id"),
        pick("station_id").alias("station_id"),
        pick("timestamp", "timestamp").alias("timestamp"),
    ]


def round_doubles(df, places: int = 6):
    """Round every double column for comparison with an oracle.

    Written as ``round(x * 10^p) / 10^p`` -- the arithmetic form most SQL
    engines use for doubles -- so exact decimal halves round the same way.
    """
    exprs = []
    scale = float(10 ** places)
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            exprs.append((F.round(F.col(f.name) * scale, 0) / scale).alias(f.name))
        elif isinstance(f.dataType, T.TimestampType):
            exprs.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            exprs.append(F.col(f.name))
    return df.select(*exprs)
