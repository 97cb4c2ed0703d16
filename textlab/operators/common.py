"""Small plan helpers shared by the operators."""

from __future__ import annotations

import gc
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Largest derived lookup table (rows) we broadcast after counting it.
BROADCAST_ROW_LIMIT = 200_000


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Persist a small derived table, check its size, and hint a broadcast only under the bound.

    Above the bound the table is returned as is and the join falls back to a
    shuffle join (AQE can still demote/promote it at run time).
    """
    cached = df.persist()
    n = cached.count()
    return F.broadcast(cached) if n <= max_rows else df


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Materialise an expensive intermediate once and cut its lineage.

    Written as parquet into a fresh folder under the shared
    ``spark.checkpoint.dir`` (see :func:`textlab.session.scratch_dir`) and
    read back: one job computes it, later jobs read only the columns they
    need, and a lost executor never forces a replay of the text work.
    """
    from ..session import scratch_dir

    path = scratch_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)  # no job to infer the schema
    out.__dict__[_STAGED] = path
    return out


_STAGED = "_staged_at"


def unstage(*tables: DataFrame) -> None:
    """Removes what :func:`stage` wrote for ``tables``, which nothing reads any more; other tables are left alone."""
    for df in tables:
        if path := df.__dict__.pop(_STAGED, None):
            remove_folder(df.sparkSession, path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder of our own under the shared checkpoint root, on any Hadoop file system."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def let_go(spark: SparkSession) -> None:
    """Lets Spark's cleaner remove the shuffle files of finished plans now, not when the driver happens to collect its garbage."""
    for _ in range(2):  # what Python held goes with the first, its files with the second
        gc.collect()
        spark.sparkContext._jvm.System.gc()


def join_on_groups(left: DataFrame, right: DataFrame, cols: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on group columns that may hold nulls; keeps the left copy of the keys."""
    if not cols:
        raise ValueError("join_on_groups needs at least one key column (no cross joins)")
    r = right.withColumnsRenamed({c: f"__r_{c}" for c in cols})
    cond = reduce(lambda a, b: a & b, [left[c].eqNullSafe(r[f"__r_{c}"]) for c in cols])
    return left.join(r, cond, how).drop(*[f"__r_{c}" for c in cols])


def r6(c) -> Column:
    """Round a double to 6 places (the convention shared with the SQL oracle)."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# Positions inside a partition take the low 33 bits of monotonically_increasing_id.
_POSITION_BITS = 33


def global_row_number(df: DataFrame, order: list, name: str = "rank") -> DataFrame:
    """0-based position of every row in a total order, without a single-partition window.

    The rows are sorted globally (range partitioned), numbered inside each
    sorted partition (``monotonically_increasing_id`` keeps the partition in
    its upper bits and the position in the lower 33), and staged so the
    numbering is fixed.  Each partition's offset is a running sum over one
    row per partition (broadcast; bounded by the partition count).
    ``order`` must be a total order (break ties with a key).
    """
    numbered = stage(df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()), "global_rank")
    numbered = numbered.select(*df.columns, F.shiftright("_mid", _POSITION_BITS).alias("_pid"),
                               F.col("_mid").bitwiseAND((1 << _POSITION_BITS) - 1).alias("_pos"))
    sizes = numbered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (numbered.join(F.broadcast(offsets), "_pid")
            .select(*df.columns, (F.col("_off") + F.col("_pos")).cast("long").alias(name)))
