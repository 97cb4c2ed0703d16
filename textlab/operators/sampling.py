"""Exact, seeded sampling and stratified splitting.

All three take "the first q rows of a group in md5 key order".  A window
``row_number() over (partition by class ...)`` would put a whole class in
one task; a class may hold a third of all rows, so the rank is found
without it:

1. histogram of (group, leading 4 hex digits of the key): partial
   aggregation on the map side, at most 65,536 rows per group;
2. a running sum over that histogram (bounded by the bucket count) finds,
   per group, the bucket where the quota is crossed and the residual r;
3. only the rows of that one bucket (about n_group / 65,536) are ranked
   exactly, giving the key of the r-th row;
4. one threshold row per group is broadcast and every row is marked by a
   narrow comparison ``(bucket, key, id) <= threshold``.

The result equals the plain window definition row for row.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import DEFAULT_SEED, key_bucket, order_key
from .common import bounded_broadcast, join_on_groups

_ALL = "__grp_all"


def _with_groups(df: DataFrame, group_cols: list[str]) -> tuple[DataFrame, list[str]]:
    if group_cols:
        return df, list(group_cols)
    return df.withColumn(_ALL, F.lit(0)), [_ALL]


def mark_first_by_key(df: DataFrame, group_cols: list[str], id_col: str, quota_fn, flag: str = "selected",
                      seed: int = DEFAULT_SEED) -> DataFrame:
    """Add boolean ``flag``: the row is among the first ``quota`` rows of its group by (md5 key, id).

    ``quota_fn(counts)`` receives ``group_cols + [n]`` (rows per group) and
    returns ``group_cols + [quota]``.
    """
    src, g = _with_groups(df, group_cols)
    keyed = src.withColumn("_key", order_key(id_col, seed)).withColumn("_b", key_bucket("_key"))

    hist = keyed.groupBy(*g, "_b").agg(F.count(F.lit(1)).alias("_n"))
    counts = hist.groupBy(*g).agg(F.sum("_n").alias("n"))
    quota = quota_fn(counts if group_cols else counts).select(*g, F.col("quota").cast("long").alias("_q"))

    w = Window.partitionBy(*g).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = hist.withColumn("_cum", F.sum("_n").over(w))
    crossing = (join_on_groups(running, quota, g)
                .where((F.col("_cum") >= F.col("_q")) & (F.col("_cum") - F.col("_n") < F.col("_q")))
                .select(*g, F.col("_b").alias("_cb"), (F.col("_q") - (F.col("_cum") - F.col("_n"))).alias("_r")))
    crossing = bounded_broadcast(crossing)

    in_bucket = (join_on_groups(keyed.select(*g, "_b", "_key", id_col), crossing, g)
                 .where(F.col("_b") == F.col("_cb")))
    wb = Window.partitionBy(*g).orderBy("_key", id_col)
    last = (in_bucket.withColumn("_rn", F.row_number().over(wb))
            .where(F.col("_rn") == F.col("_r"))
            .select(*g, "_cb", F.col("_key").alias("_lk"), F.col(id_col).alias("_lid")))
    thresholds = bounded_broadcast(last)

    marked = join_on_groups(keyed, thresholds, g, "left")
    sel = ((F.col("_b") < F.col("_cb"))
           | ((F.col("_b") == F.col("_cb"))
              & ((F.col("_key") < F.col("_lk")) | ((F.col("_key") == F.col("_lk")) & (F.col(id_col) <= F.col("_lid"))))))
    out = marked.withColumn(flag, F.coalesce(sel, F.lit(False))).drop("_key", "_b", "_cb", "_lk", "_lid")
    return out if group_cols else out.drop(_ALL)


def stratified_sample(df: DataFrame, label_col: str, id_col: str, n_per_class: int,
                      seed: int = DEFAULT_SEED) -> DataFrame:
    """W1 (+U1): exactly ``min(n, n_class)`` rows per class, without replacement, seeded; one pass."""
    def quota(counts):
        return counts.select(label_col, F.least(F.col("n"), F.lit(n_per_class)).alias("quota"))

    marked = mark_first_by_key(df, [label_col], id_col, quota, "_in", seed)
    return marked.where("_in").drop("_in")


def split_quotas(counts: DataFrame, label_col: str, test_fraction: str = "0.2") -> DataFrame:
    """Per-class test quota: total ``ceil(f*n)`` shared by largest remainder, ties by class ascending.

    Exact integer/decimal arithmetic only, so quotas are exact at any size.
    ``counts`` has one row per class, so the global windows below run over a
    class-sized table.
    """
    every = Window.partitionBy()
    c = (counts.withColumn("_total", F.sum("n").over(every))
         .withColumn("_ntest", F.ceil(F.lit(Decimal(test_fraction)) * F.col("_total")).cast("long"))
         .withColumn("_scaled", F.col("n").cast("decimal(38,0)") * F.col("_ntest").cast("decimal(38,0)"))
         .withColumn("_base", F.expr("_scaled div _total"))
         .withColumn("_rem", F.expr("_scaled % _total"))
         .withColumn("_left", F.col("_ntest") - F.sum("_base").over(every)))
    w = Window.orderBy(F.col("_rem").desc(), F.col(label_col).asc_nulls_first())
    extra = F.when(F.row_number().over(w) <= F.col("_left"), 1).otherwise(0)
    return c.select(label_col, (F.col("_base") + extra).alias("quota"))


def stratified_split(df: DataFrame, label_col: str, id_col: str, test_fraction: str = "0.2",
                     seed: int = DEFAULT_SEED) -> DataFrame:
    """Exact stratified train/test split; adds ``split`` in {'train','test'}."""
    marked = mark_first_by_key(df, [label_col], id_col,
                               lambda counts: split_quotas(counts, label_col, test_fraction), "_test", seed)
    return marked.withColumn("split", F.when(F.col("_test"), "test").otherwise("train")).drop("_test")


def uniform_sample(df: DataFrame, id_col: str, n: int, seed: int = DEFAULT_SEED) -> DataFrame:
    """``min(n, rows)`` rows without replacement; a seeded top-n by md5 key (bounded merge)."""
    return (df.withColumn("_key", order_key(id_col, seed))
            .orderBy("_key", id_col).limit(n).drop("_key"))
