"""Profiles and counts, by aggregation passes over the columns they name."""

import math
from functools import reduce
from operator import or_

from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

BINS = 1024
QUARTILES = [("p25", 0.25), ("p50", 0.5), ("p75", 0.75)]


def distribution(df, col):
    """Rows per value, ordered by value."""
    return df.groupBy(col).agg(F.count("*").alias("count")).orderBy(col)


def quality_report(df, required):
    """Total rows, rows with a missing key, and NULLs per required column."""
    nulls = [F.col(c).isNull() for c in required]
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(reduce(or_, nulls)).alias("broken"),
        *[F.count_if(null).alias(f"null_{c}") for c, null in zip(required, nulls)],
    )


def _finite(number):
    return number.isNotNull() & ~F.isnan(number) & (F.abs(number) != float("inf"))


def _scaled(x, low, high):
    """``x`` on a scale on which a histogram between ``low`` and ``high`` is useful: itself, or its logarithm where they
    are orders of magnitude apart. Both keep the order of all floating-point numbers."""
    apart = low < 0 < high or max(abs(low), abs(high)) > 4 * min(abs(low), abs(high))
    if not (apart and max(abs(low), abs(high)) > 1):
        return x, low, high
    return F.signum(x) * F.log1p(F.abs(x)), math.copysign(math.log1p(abs(low)), low), math.copysign(math.log1p(abs(high)), high)


def _histogram(df, numbers, intervals, bins):
    """{interval: [(count, least, greatest) of each bin in order]} of (column, low, high), in one pass over ``df``."""
    cells = []
    for n, (column, low, high) in enumerate(intervals):
        x = numbers[column]
        scaled, first, last = _scaled(x, low, high)
        share = F.least(F.greatest((scaled - first) / (last - first), F.lit(0.0)), F.lit(1.0))
        cell = F.struct(F.lit(n).alias("interval"), F.least(F.floor(share * bins), F.lit(bins - 1)).alias("bin"), x.alias("x"))
        cells.append(F.when(x.between(low, high), cell))
    rows = df.select(F.explode(F.array(*cells)).alias("cell")).where(F.col("cell").isNotNull()).select("cell.*")
    found = rows.groupBy("interval", "bin").agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).collect()
    out = {interval: [] for interval in intervals}
    for r in sorted(found, key=lambda r: (r.interval, r.bin)):
        out[intervals[r.interval]].append((r.n, r.low, r.high))
    return out


def exact_quantiles(df, numbers, shares, bins=BINS):
    """{name: [value of each share]} of the double columns ``numbers`` (name -> column), without any error: the least value that at
    least the share of the values does not exceed. NULLs do not count, NaN is the greatest value; a column without values has NULLs.

    Distributed selection: a histogram of each open interval gives, for each rank, the one bin that holds it, and its least and greatest value are the next
    interval, until both are the same. The driver sees at most ``bins`` rows per column and share, a task holds as many; each round
    divides an interval by about ``bins``.
    """
    ends = df.agg(*[F.struct(*_ends(x)).alias(name) for name, x in numbers.items()]).first() if numbers else {}
    return _selected(df, numbers, shares, bins, ends)


def _ends(x):
    """What a selection needs to know of a column of doubles first."""
    finite = F.when(_finite(x), x)
    return [
        F.count(x).alias("n"), F.count_if(x == float("-inf")).alias("below"), F.count_if(_finite(x)).alias("finite"), F.count_if(x == float("inf")).alias("above"),
        F.min(finite).alias("low"), F.max(finite).alias("high"),
    ]


def _selected(df, numbers, shares, bins, ends):
    found, searched = {}, {}
    for name in numbers:
        e = ends[name]
        for q in shares:
            rank = max(1, math.ceil(q * e.n)) - e.below
            if not e.n:
                found[name, q] = None
            elif rank <= 0:
                found[name, q] = float("-inf")
            elif rank <= e.finite:
                searched[name, q] = (name, e.low, e.high), rank
            else:
                found[name, q] = float("inf") if rank <= e.finite + e.above else float("nan")
    while searched:
        for place, ((name, low, high), _) in list(searched.items()):
            if low == high:
                found[place] = low
                del searched[place]
        if not searched:
            break
        cells = _histogram(df, numbers, sorted({interval for interval, _ in searched.values()}), bins)
        for place, (interval, rank) in searched.items():
            for n, low, high in cells[interval]:
                if rank <= n:
                    searched[place] = (interval[0], low, high), rank
                    break
                rank -= n
    return {name: [found[name, q] for q in shares] for name in numbers}


def profile(df, cols=None):
    """One row per column: count, mean, stddev, min, quartiles, max.

    Strings are profiled like numbers where they hold some (others are left out of mean and quartiles).
    Minimum and maximum are given as text. Quartiles are exact (``exact_quantiles``). Everything but the search for the quartiles is one pass, and that
    reads the columns with numbers only.
    """
    types = {f.name: f.dataType for f in df.schema if isinstance(f.dataType, (NumericType, StringType))}
    cols = list(types) if cols is None else cols
    numbers = {c: F.col(c).try_cast("double") if isinstance(types[c], StringType) else F.col(c) for c in cols}
    doubles = {c: number.cast("double") for c, number in numbers.items()}
    lines = df.agg(*[
        F.struct(
            F.struct(*_ends(doubles[c])).alias("ends"), F.count(c).alias("count"), F.mean(numbers[c]).cast("double").alias("mean"), F.stddev(numbers[c]).alias("stddev"),
            F.min(c).cast("string").alias("min"), F.max(c).cast("string").alias("max"),
        ).alias(f"column_{i}") for i, c in enumerate(cols)
    ]).first()
    quartiles = _selected(df, doubles, [share for _, share in QUARTILES], BINS, {c: line["ends"] for c, line in zip(cols, lines)})
    rows = [(c, line["count"], line["mean"], line["stddev"], line["min"], *quartiles[c], line["max"]) for c, line in zip(cols, lines)]
    names = ", ".join(f"{name} double" for name, _ in QUARTILES)
    return df.sparkSession.createDataFrame(rows, f"column string, count long, mean double, stddev double, min string, {names}, max string")
