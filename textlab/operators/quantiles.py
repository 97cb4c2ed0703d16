"""A15/A16 for any numeric column: exact order statistics by distributed selection.

A rank is located by refined histograms.  A pass counts the values between the
bounds of every wanted rank in ``BINS`` equal bins, with the least and largest
value of each (map-side combined; a row a bin is shuffled).  The bin that holds
the rank gives the next bounds, which are values of the data: the least and the
largest value of an interval never share a bin, so each pass gets on, and the
rank is found when both are equal.  No group is sorted or gathered, a value
that a third of all rows share ends the search at once, and the driver holds
``BINS`` counts for each group and rank (groups are columns or classes).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 256


def _ranks(n: int, probs) -> dict:
    """``{p: (rank below, rank above, weight of the one above)}`` of linear interpolation, ranks from 0."""
    out = {}
    for p in probs:
        at = p * (n - 1)
        low = math.floor(at)
        out[p] = (low, min(low + 1, n - 1), at - low)
    return out


def exact_quantiles(df: DataFrame, group: str, value: str, probs=(0.25, 0.5, 0.75), bins: int = BINS, info: dict | None = None) -> dict:
    """``{group: [quantile of each prob]}``, linearly interpolated between the two nearest values.

    Nulls and not-a-number values are left out; a group without values has no entry.  ``info`` gets the passes.
    """
    spark = df.sparkSession
    rows = df.select(F.col(group).alias("g"), F.col(value).cast("double").alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    sizes = {r["g"]: r for r in rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect()}
    wanted = {g: _ranks(r["n"], probs) for g, r in sizes.items()}
    found: dict[tuple, float] = {}
    search = {}  # (group, rank) -> (least, largest value of the interval, rank inside it)
    for g, ps in wanted.items():
        for rank in {r for low, high, _ in ps.values() for r in (low, high)}:
            search[g, rank] = (sizes[g]["lo"], sizes[g]["hi"], rank)
    schema, passes = f"g {rows.schema['g'].dataType.simpleString()}, k long, lo double, hi double", 1
    while True:
        found |= {k: lo for k, (lo, hi, _) in search.items() if lo == hi}
        search = {k: s for k, s in search.items() if s[0] < s[1]}
        if not search:
            break
        spans = sorted({(g, lo, hi) for (g, _), (lo, hi, _) in search.items()}, key=str)  # ranks in one interval share a count
        number = {s: i for i, s in enumerate(spans)}
        bounds = spark.createDataFrame([(g, i, lo, hi) for (g, lo, hi), i in number.items()], schema)
        inside = rows.join(F.broadcast(bounds), F.col("x").between(F.col("lo"), F.col("hi")) & rows["g"].eqNullSafe(bounds["g"]))
        share = (F.col("x") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)  # halves, so that no difference overflows
        cell = F.when(F.col("x") == F.col("hi"), bins - 1).otherwise(F.least(F.floor(share * bins), F.lit(bins - 2)))
        counts: dict[int, list] = {}
        for r in inside.groupBy("k", cell.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect():
            counts.setdefault(r["k"], []).append((r["b"], r["n"], r["lo"], r["hi"]))
        passes += 1
        for (g, rank), (lo, hi, inner) in search.items():
            for _, n, low, high in sorted(counts[number[g, lo, hi]]):
                if inner < n:
                    search[g, rank] = (low, high, inner)
                    break
                inner -= n
    if info is not None:
        info["passes"] = passes
    return {g: [found[g, low] + (found[g, high] - found[g, low]) * w if w else found[g, low] for low, high, w in ps.values()] for g, ps in wanted.items()}
