"""Exact line dedup over levelled sorted runs of line hashes.

Documents come in batches, in the order of their ids.  A batch's distinct
line hashes, each with the smallest id that holds it, are anti-joined with
the runs written so far; what is new becomes a run of level 0, bucketed and
sorted by hash.  When a level holds ``FANOUT`` runs they are merged into one
run of the next level, so there are about FANOUT runs a level and a batch
meets few of them.  A run lies in buckets by hash, as a batch's hashes do
after their aggregation: joining moves the batch and never the runs.

A line stays only in the document that brought its hash first.  The lines to
drop are the (hash, document) rows without a match (hash, first document):
an anti-join on both, so a line that a third of all documents share spreads
over all tasks.  The text itself moves once, to meet its drop list.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import free_name, read, stage, text_bytes, text_key

MIN_CHARS, BATCHES, FANOUT = 10, 4, 2
BLANKS = b" \t\n\x0b\x0c\r"
LAST = (1 << 63) - 1


def line_digest(line: bytes, min_chars: int) -> bytes | None:
    """128-bit hash of a line's key, or None for a key under ``min_chars`` code points."""
    key = line.strip(BLANKS).lower()  # on bytes: ASCII only
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode()) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


def line_hashes(docs: DataFrame, id_col: str, text_col: str, min_chars: int = MIN_CHARS) -> DataFrame:
    """``(id, text_key, h1, h2)``, distinct within a row."""
    def run(batches):
        for b in batches:
            ids, hashes = b.column(0).to_numpy(zero_copy_only=False), []
            counts = np.zeros(b.num_rows, np.int64)
            for i, text in enumerate(text_bytes(b.column(2))):
                own = {h for line in text.split(b"\n") if (h := line_digest(line, min_chars))}
                counts[i] = len(own)
                hashes.extend(own)
            h = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
            keys = b.column(1).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, counts), pa.int64()), pa.array(np.repeat(keys, counts), pa.int64()),
                                              pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy())], names=["id", "text_key", "h1", "h2"])

    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("id"), text_key(text_col).alias("text_key"),
                       F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, text_key long, h1 long, h2 long")


@dataclass
class LineRuns:
    """The runs of each level, as bucketed tables ``(h1, h2, first)`` in shared storage."""

    spark: SparkSession
    buckets: int
    fanout: int = FANOUT
    levels: list[list[str]] = field(default_factory=list)

    def tables(self) -> list[DataFrame]:
        return [self.spark.table(t) for level in self.levels for t in level]

    def _write(self, rows: DataFrame, level: int) -> DataFrame:
        name = f"line_run_{uuid.uuid4().hex}"
        (rows.write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").format("parquet")
         .option("path", scratch_dir(self.spark, name)).saveAsTable(name))
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        return self.spark.table(name)

    def add(self, rows: DataFrame) -> DataFrame:
        """Anti-join a batch ``(h1, h2, id)`` with the runs and add what is new as a run; returns that run."""
        new = rows.groupBy("h1", "h2").agg(F.min("id").alias("first"))
        for run in self.tables():
            new = new.join(run.hint("merge"), ["h1", "h2"], "left_anti")
        return self._write(new, 0)

    def compact(self) -> None:
        """Merge full levels into one run of the next level, lowest first."""
        for level in range(len(self.levels)):
            if len(names := self.levels[level]) >= self.fanout:
                merged = self.spark.table(names[0])
                for name in names[1:]:
                    merged = merged.unionByName(self.spark.table(name))
                self._write(merged.repartition(self.buckets, "h1", "h2"), level + 1)
                self.levels[level] = []
                for name in names:
                    self.spark.sql(f"DROP TABLE {name}")  # external: its files stay for plans that still read them

    def forget(self) -> None:
        for name in [t for level in self.levels for t in level]:
            self.spark.sql(f"DROP TABLE {name}")


def dropped_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int, batches: int, fanout: int) -> DataFrame:
    """``(id, text_key, drop)``: the hashes that each text loses, as one array a text that loses any.

    Lists go by id and text, so rows that share an id (or have none) are not gathered in one list.
    """
    spark = docs.sparkSession
    cuts = docs.agg(F.percentile_approx(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)),
                                        [i / batches for i in range(1, batches)] or [1.0], 10_000)).first()[0] or []
    batch = sum([(F.col("id") > c).cast("int") for c in sorted(set(cuts))], F.lit(0))
    lines = stage(line_hashes(docs, id_col, text_col, min_chars).withColumn("batch", batch), "line_hashes")
    runs = LineRuns(spark, int(spark.conf.get("spark.sql.shuffle.partitions")), fanout)
    drops = []
    for i in range(len(set(cuts)) + 1):
        own = lines.where(F.col("batch") == i).drop("batch")
        new = runs.add(own).select("h1", "h2", F.col("first").alias("id"))
        lost = own.join(new, ["h1", "h2", "id"], "left_anti")
        drops.append(stage(lost.groupBy("id", "text_key").agg(F.collect_set(F.struct("h1", "h2")).alias("drop")), "line_drops"))
        runs.compact()
    runs.forget()
    out = drops[0]
    for d in drops[1:]:
        out = out.unionByName(d)
    return out


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                batches: int = BATCHES, fanout: int = FANOUT) -> tuple[DataFrame, dict[str, str]]:
    """Rows of ``docs`` with the kept text in ``text_col``, plus ``n_lines`` and ``n_dropped``.

    Returns the table and the names of the two new columns.  A line's key is the
    line without blanks at both ends, A-Z lower-cased; keys of ``min_chars``
    code points found in more documents stay only in the smallest id's rows, with
    all repeats there.  Null and empty texts are one empty line (kept text: empty).
    Rows that repeat an id are one document, each with its own drop list.  Null ids are one
    document, larger than all others.  An empty table gives no rows; other columns pass through.
    """
    names = {k: free_name(docs, k) for k in ("n_lines", "n_dropped")}
    lost = dropped_lines(docs, id_col, text_col, min_chars, batches, fanout)
    lost_id, lost_key, drop, my_id, my_key = (free_name(docs, k) for k in ("lost_id", "lost_key", "drop", "my_id", "my_key"))
    wide = docs.withColumns({my_id: F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)), my_key: text_key(text_col)})
    lost = lost.select(F.col("id").alias(lost_id), F.col("text_key").alias(lost_key), F.col("drop").alias(drop))
    same = (F.col(my_id) == F.col(lost_id)) & (F.col(my_key) == F.col(lost_key))
    wide = wide.join(lost.hint("merge"), same, "left").drop(lost_id, lost_key, my_id, my_key)
    wide = wide.withColumns({n: F.lit(0).cast("long") for n in names.values()})

    def run(parts):
        for b in parts:
            at = {c: b.schema.get_field_index(c) for c in (text_col, drop, *names.values())}
            texts, lists = text_bytes(b.column(at[text_col])), b.column(at[drop])
            n_lines, n_drop = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
            flat, offs = lists.values, lists.offsets.to_numpy()
            pair = np.stack([flat.field(0).to_numpy(zero_copy_only=False), flat.field(1).to_numpy(zero_copy_only=False)], 1)
            pair = np.ascontiguousarray(pair, np.int64)
            for i, text in enumerate(texts):
                n_lines[i] = text.count(b"\n") + 1
                if offs[i + 1] > offs[i]:
                    raw = pair[offs[i]:offs[i + 1]].tobytes()
                    gone = {raw[j:j + 16] for j in range(0, len(raw), 16)}
                    kept = [x for x in text.split(b"\n") if line_digest(x, min_chars) not in gone]
                    n_drop[i] = n_lines[i] - len(kept)
                    texts[i] = b"\n".join(kept)
            cols = list(b.columns)
            cols[at[text_col]] = pa.array(texts, pa.binary()).cast(pa.string())
            cols[at[names["n_lines"]]], cols[at[names["n_dropped"]]] = pa.array(n_lines), pa.array(n_drop)
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)

    return wide.mapInArrow(run, wide.schema).drop(drop), names


def op6_line_dedup(spark, sf_dir: str) -> DataFrame:
    """``op6``: lines before, lines dropped and the digest of the kept text of every document."""
    out, c = dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col(c["n_lines"]).alias("n_lines"), F.col(c["n_dropped"]).alias("n_dropped"),
                      F.sha2("text", 256).alias("kept_sha256"))
