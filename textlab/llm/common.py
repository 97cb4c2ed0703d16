"""Helpers shared by the operators of this subpackage: column names that cannot clash, Arrow text buffers, staging."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.common import stage  # noqa: F401  (re-exported)


BATCH_ROWS = 1000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table.  Whole texts go to Python in Arrow batches, so the session's batch is held to ``BATCH_ROWS`` rows."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= BATCH_ROWS:
        spark.conf.set(setting, str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until the table has no such column (Spark compares without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_key(text_col: str):
    """Tells rows that repeat an id with another text apart; null is empty."""
    return F.xxhash64(F.lit(7), F.coalesce(F.col(text_col), F.lit("")))


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def walk(items: Column, state: Column, step, kind: str, stretch: int = 256) -> tuple[Column, Column]:
    """Fold an array with ``step((s, out), x)`` and give ``(s, all that was put out)``.

    Lists are copied when they grow, so each stretch of items has a list of its own, which is then one
    entry of a list of lists: the work is in proportion to the items.
    """
    def part(a, own):
        walked = F.aggregate(own, F.struct(a["s"].alias("s"), F.array().cast(f"array<{kind}>").alias("out")), step)
        return let(walked, lambda w: F.struct(w["s"].alias("s"), F.concat(a["out"], F.array(w["out"])).alias("out")))

    def whole(v):
        parts = F.transform(F.sequence(F.lit(0), F.greatest(F.size(v) - 1, F.lit(0)), F.lit(stretch)), lambda i: F.slice(v, i + 1, stretch))
        return F.aggregate(parts, F.struct(state.alias("s"), F.array().cast(f"array<array<{kind}>>").alias("out")), part)

    done = let(items, whole)
    return done["s"], F.flatten(done["out"])


def text_bytes(column: pa.Array) -> list[bytes]:
    """The values of a string column as UTF-8 bytes; null is empty."""
    return pc.fill_null(column.cast(pa.binary()), b"").to_pylist()


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string column without copying the texts; null is empty."""
    arr = pc.fill_null(column.cast(pa.binary()), b"")
    if arr.offset:
        arr = pa.concat_arrays([arr])
    bufs = arr.buffers()
    offs = np.frombuffer(bufs[1], np.int32, len(arr) + 1, arr.offset * 4).astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.empty(0, np.uint8)
    return data, offs


def pieces(offs: np.ndarray, most_bytes: int = 1 << 20):
    """Ranges of rows whose texts fill about ``most_bytes``; a longer text is a range of its own."""
    n, a = len(offs) - 1, 0
    while a < n:
        b = int(np.searchsorted(offs, offs[a] + most_bytes, "right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


# Multiplier of the word hash (odd, so that it has an inverse modulo 2**64) and the mixing constants of a 64-bit finaliser.
BASE = 0x9E3779B97F4A7C15
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_U = np.uint64
_powers = {"n": 0, "pow": np.ones(0, _U), "inv": np.ones(0, _U)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE**i`` and ``BASE**-i`` modulo 2**64 for i < n (kept per worker, grown when a longer text comes)."""
    if _powers["n"] < n:
        n = max(n, 1 << 16)
        for key, base in (("pow", BASE), ("inv", pow(BASE, -1, 1 << 64))):
            steps = np.full(n, base, _U)
            steps[:1] = 1
            _powers[key] = np.cumprod(steps, dtype=_U)
        _powers["n"] = n
    return _powers["pow"][:n], _powers["inv"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(MIX[0])
    h = (h ^ (h >> _U(27))) * _U(MIX[1])
    return h ^ (h >> _U(31))


def split_words(buf: np.ndarray, doc_offs: np.ndarray, is_word: np.ndarray):
    """``(start, end, doc)`` of every maximal run of word bytes; runs end at text borders."""
    mask = is_word[buf]
    before = np.zeros(len(buf), bool)
    before[1:] = mask[:-1]
    first = doc_offs[:-1][doc_offs[:-1] < len(buf)]
    before[first] = False
    start = np.flatnonzero(mask & ~before)
    after = np.zeros(len(buf), bool)
    after[:-1] = mask[1:]
    last = doc_offs[1:] - 1
    after[last[last >= 0]] = False
    end = np.flatnonzero(mask & ~after) + 1
    return start, end, np.searchsorted(doc_offs, start, "right") - 1


def word_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, most_bytes: int = 1 << 20) -> np.ndarray:
    """64-bit hash of every ``buf[start:end]``: a polynomial over the bytes from prefix sums, then mixed.

    The sums go over stretches of about ``most_bytes``, so that a very long text needs no table of its length.
    """
    out, a = np.empty(len(start), _U), 0
    while a < len(start):
        low = start[a]
        b = max(a + 1, int(np.searchsorted(end, low + most_bytes, "right")))
        part = buf[low:end[b - 1]]
        up, down = powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, _U)
        np.cumsum((part.astype(_U) + _U(1)) * up[:len(part)], dtype=_U, out=sums[1:])
        out[a:b] = mix((sums[end[a:b] - low] - sums[start[a:b] - low]) * down[start[a:b] - low])
        a = b
    return out
