"""Data-quality and profiling reports."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripdemand.functions import literal_frame, round_half_away

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)
QUARTILES = (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))
# mean and standard deviation are floating sums whose last bits depend on the
# order partial results merge in; they are reported at this many decimals
MOMENT_PLACES = 6
#: A sketch's ranks are off by a share of 1 / ACCURACY of the rows at most.
ACCURACY = 2000
#: The most different values of a bracket that one task may see.
FETCH = 1_000_000


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def profile(df: DataFrame, columns: Sequence[str] | None = None, fetch: int = FETCH) -> DataFrame:
    """Per numeric column: count, mean, std, min, quartiles, max (like ``describe``).

    Quartiles are exact: NumPy's linear interpolation between order statistics. No pass sorts
    or shuffles the values of a column:

    1. One wide aggregate gives moments and a mergeable quantile sketch a column. For each
       quartile two sketched values, a few sketch errors apart, bracket its order statistics.
    2. Where a bracket may hold over ``fetch`` values, values below and between its ends are
       counted and the inside is sketched again, which narrows it by hundreds.
    3. One pass counts, per bracket, the rows below it and each different value in it; a
       running count over those finds the order statistics. Equal values are combined before
       the shuffle, and a bracket's different values are bounded by ``fetch``.
    """
    cols = list(columns or numeric_columns(df))
    values = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    moments = values.agg(*[a for i in range(len(cols)) for a in _moments(F.col(f"x{i}"), i)]).first()
    brackets = _narrowed(values, [b for i in range(len(cols)) for b in _first_brackets(moments, i)], fetch)
    quartiles = _order_statistics(values, brackets)
    summary = literal_frame(df.sparkSession, [
        (i, c, moments[f"count{i}"], *(moments[f"{m}{i}"] for m in ("mean", "std", "min", "max"))) for i, c in enumerate(cols)],
        "place int, column string, count bigint, mean double, std double, min double, max double")
    return (summary.join(quartiles, "place", "left")
            .select("column", "count",
                    round_half_away(F.col("mean"), MOMENT_PLACES).alias("mean"),
                    round_half_away(F.col("std"), MOMENT_PLACES).alias("std"),
                    "min", *[n for n, _ in QUARTILES], "max"))


class Bracket(NamedTuple):
    """Column ``x<place>``: the order statistics at ``rank`` and the next lie in [low, high]."""

    place: int
    name: str
    rank: int
    fraction: float
    low: float
    high: float
    #: the most rows that can lie strictly between low and high
    inside: int


def _moments(x: Column, i: int) -> list[Column]:
    ends = [p for _, q in QUARTILES for p in (max(0.0, q - 3 / ACCURACY), min(1.0, q + 3 / ACCURACY))]
    return [F.count(x).alias(f"count{i}"), F.avg(x).alias(f"mean{i}"), F.stddev_samp(x).alias(f"std{i}"), F.min(x).alias(f"min{i}"),
            F.max(x).alias(f"max{i}"), F.percentile_approx(x, ends, ACCURACY).alias(f"ends{i}")]


def _first_brackets(moments: Row, i: int) -> list[Bracket]:
    n = moments[f"count{i}"]
    out = []
    for k, (name, q) in enumerate(QUARTILES):
        if n:
            rank = math.floor((n - 1) * q)
            # of few rows the sketch keeps all, but its margin may be less than one row
            low, high = (moments[f"min{i}"], moments[f"max{i}"]) if n < ACCURACY else moments[f"ends{i}"][2 * k : 2 * k + 2]
            out.append(Bracket(i, name, rank, (n - 1) * q - rank, low, high, n if n < ACCURACY else 8 * n // ACCURACY))
    return out


def _narrowed(values: DataFrame, brackets: list[Bracket], fetch: int) -> list[Bracket]:
    """The brackets, sketched again from the inside until each holds at most ``fetch`` rows."""
    while wide := [k for k, b in enumerate(brackets) if b.inside > fetch]:
        x = [F.col(f"x{brackets[k].place}") for k in wide]
        low, high = [F.lit(brackets[k].low) for k in wide], [F.lit(brackets[k].high) for k in wide]
        counts = values.agg(*[c for j in range(len(wide)) for c in (
            F.count_if(x[j] <= low[j]).alias(f"low{j}"), F.count_if((x[j] > low[j]) & (x[j] < high[j])).alias(f"in{j}"))]).first()
        ends, again = [], []
        for j, k in enumerate(wide):
            b, n = brackets[k], counts[f"in{j}"]
            first, last = b.rank - counts[f"low{j}"], b.rank + 1 - counts[f"low{j}"]  # among the inside, from 0
            brackets[k] = b._replace(inside=n)
            if n > fetch:
                again.append((j, k, first > 4 * n / ACCURACY, last < n - 4 * n / ACCURACY, n))
                p = [min(1.0, max(0.0, first / n - 3 / ACCURACY)), min(1.0, max(0.0, last / n + 3 / ACCURACY))]
                ends.append(F.percentile_approx(F.when((x[j] > low[j]) & (x[j] < high[j]), x[j]), p, ACCURACY).alias(f"ends{j}"))
        if not again:
            continue
        sketched = values.agg(*ends).first()
        for j, k, above, below, n in again:
            # an end moves only where both order statistics are surely beyond it
            low_end, high_end = sketched[f"ends{j}"]
            b = brackets[k]
            brackets[k] = b._replace(low=low_end if above else b.low, high=high_end if below else b.high, inside=12 * n // ACCURACY)
    return brackets


def _order_statistics(values: DataFrame, brackets: list[Bracket]) -> DataFrame:
    """(place, one column a quartile) from exact counts of what lies below and in each bracket."""
    if not brackets:
        return literal_frame(values.sparkSession, [(-1, *[None] * len(QUARTILES))], "place int, " + ", ".join(f"{n} double" for n, _ in QUARTILES))
    cells = []
    for k, b in enumerate(brackets):
        x = F.col(f"x{b.place}")
        cells.append(F.struct(F.lit(k).alias("bracket"), (x < F.lit(b.low)).alias("below"), F.when((x >= F.lit(b.low)) & (x <= F.lit(b.high)), x).alias("value")))
    seen = values.select(F.inline(F.filter(F.array(*cells), lambda c: c["below"] | c["value"].isNotNull())))
    counts = seen.groupBy("bracket", "below", "value").agg(F.count(F.lit(1)).alias("n"))
    by_value = Window.partitionBy("bracket").orderBy(F.col("below").desc(), "value")
    ends = F.sum("n").over(by_value)
    ranked = counts.select("bracket", "value", ends.alias("end"), (ends - F.col("n")).alias("start"))
    asked = literal_frame(values.sparkSession, [(k, b.place, b.name, b.rank, b.fraction) for k, b in enumerate(brackets)],
                          "bracket int, place int, name string, rank bigint, fraction double")
    at = lambda r: F.max(F.when((F.col("start") <= r) & (r < F.col("end")), F.col("value")))
    picked = ranked.join(asked, "bracket").groupBy("bracket", "place", "name", "fraction").agg(at(F.col("rank")).alias("a"), at(F.col("rank") + 1).alias("b"))
    a, b, f = F.col("a"), F.col("b"), F.col("fraction")
    # linear interpolation exactly as NumPy's (and so pandas' describe): measured from the nearer order statistic
    value = F.when(f == 0, a).when(f >= 0.5, b - (b - a) * (F.lit(1.0) - f)).otherwise(a + (b - a) * f)
    return picked.groupBy("place").agg(*[F.max(F.when(F.col("name") == n, value)).alias(n) for n, _ in QUARTILES])


def missing_values(df: DataFrame) -> DataFrame:
    """Null (or NaN) cells per column, one row per column, in column order."""
    def missing(f):
        c = F.col(f.name)
        cond = c.isNull()
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            cond = cond | F.isnan(c)
        return F.count(F.when(cond, 1)).alias(f.name)
    wide = df.agg(*[missing(f) for f in df.schema.fields])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"),
                 F.col(f.name).alias("missing"))
        for i, f in enumerate(df.schema.fields)])))


def schema_report(df: DataFrame) -> DataFrame:
    """Column, Spark type and non-null count for every column (like ``info``)."""
    wide = df.agg(*[F.count(F.col(f.name)).alias(f.name) for f in df.schema.fields])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"),
                 F.lit(f.dataType.simpleString()).alias("type"),
                 F.col(f.name).alias("non_null"))
        for i, f in enumerate(df.schema.fields)])))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count (each a global count job)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def sample_rows(df: DataFrame, n: int, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """A deterministic preview: the first ``n`` rows by ``order``, chosen columns."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in order]).select(*columns).limit(n)
