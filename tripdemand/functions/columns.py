"""Column helpers whose results must be bit-identical to the SQL definitions.

All of these are plain Spark SQL expressions (codegen'd, no Python at run time).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _of_day(unit: str, ts: Column) -> Column:
    """Whole ``unit``s elapsed since midnight (fraction dropped)."""
    if unit == "second":
        return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    if unit == "minute":
        return F.hour(ts) * 60 + F.minute(ts)
    raise ValueError(f"unsupported unit {unit!r}")


_PER_DAY = {"second": 86_400, "minute": 1_440}


def boundary_diff(unit: str, start: Column, end: Column) -> Column:
    """Number of ``unit`` boundaries crossed between ``start`` and ``end``.

    This is SQL ``DATEDIFF(unit, start, end)`` on timestamps: 00:00:00.9 ->
    00:01:00.1 is 60 seconds although only 59.2 s elapse. Computed from the
    calendar fields of the zone-less values (day difference plus
    units-of-day), so neither the session time zone nor daylight-saving
    changes can move it.
    """
    days = F.datediff(F.to_date(end), F.to_date(start)).cast("long")
    return days * _PER_DAY[unit] + (_of_day(unit, end) - _of_day(unit, start))


def round_half_away(col: Column, places: int) -> Column:
    """SQL ``ROUND(double, n)``: scale, round half away from zero, unscale.

    ``F.round(x, n)`` rounds the decimal text of x instead (1.005 -> 1.01),
    scaling first reproduces the binary behaviour (1.005 -> 1.0).
    """
    scale = float(10 ** places)
    return F.round(col * F.lit(scale), 0) / F.lit(scale)


def round_half_even(col: Column, places: int) -> Column:
    """NumPy/pandas ``.round(n)``: scale, round half to even, unscale."""
    scale = float(10 ** places)
    return F.rint(col * F.lit(scale)) / F.lit(scale)


def day_of_week_sun0(ts: Column) -> Column:
    """Day of week with 0 = Sunday ... 6 = Saturday."""
    return (F.dayofweek(ts) - 1).cast("int")


def month_start(ts: Column) -> Column:
    """First instant of the month of a zone-less timestamp, as timestamp_ntz."""
    return F.trunc(F.to_date(ts), "month").cast("timestamp_ntz")


def _sql_literal(value, dtype: T.DataType) -> str:
    if value is None:
        return "NULL"
    if isinstance(dtype, T.StringType):
        return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        value = float(value)
        return repr(value) + "D" if math.isfinite(value) else f"CAST('{value}' AS DOUBLE)"
    return str(value)


def literal_frame(spark, rows, schema):
    """A small literal table as one ``VALUES`` relation (planned in the JVM).

    ``schema`` is a ``StructType`` or a DDL string ``"a int, b string"``;
    ``rows`` are tuples in field order.
    """
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    fields = schema.fields
    values = ", ".join("(" + ", ".join(_sql_literal(v, f.dataType) for v, f in zip(row, fields)) + ")"
                       for row in rows)
    names = ", ".join(f"c{i}" for i in range(len(fields)))
    cols = ", ".join(f"CAST(c{i} AS {f.dataType.simpleString()}) AS `{f.name}`"
                     for i, f in enumerate(fields))
    return spark.sql(f"SELECT {cols} FROM VALUES {values} AS t({names})")


def scaled_sum(col: Column, places: int) -> Column:
    """Exact sum of decimal quantities with at most ``places`` decimals.

    Floating-point sums depend on the order rows meet in a distributed
    aggregate, so a mean of rounded money values could land on either side of
    a rounding boundary from run to run. Summing integer units (cents,
    tenths) is exact and order-free; the result is a double.
    """
    scale = 10 ** places
    return F.sum(F.round(col * F.lit(float(scale)), 0).cast("long")) / F.lit(float(scale))


def exact_mean(col: Column, places: int) -> Column:
    """Mean of decimal quantities (at most ``places`` decimals), nulls skipped.

    One IEEE division of the exact integer sum by ``count * 10^places``, so
    the value is the correctly rounded mean and identical on every engine.
    """
    scale = 10 ** places
    units = F.sum(F.round(col * F.lit(float(scale)), 0).cast("long"))
    return units / (F.count(col) * F.lit(scale))
