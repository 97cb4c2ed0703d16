"""SimHash near-duplicate detection with pigeonhole blocks.

Fingerprints of 64 bits link at ``max_bits`` (3) or fewer differing bits.
They are cut into 6 blocks; 3 differing bits touch at most 3 blocks, so a
linked pair shares at least 3: joined on every choice of 3 blocks (20 keys
of about 32 bits a fingerprint), each linked pair meets in some bucket.
Inside a bucket the Hamming distance is verified.

Exact copies are grouped first (a fingerprint enters the blocks once), and a
bucket gives the links of a spanning forest, not of all pairs.  A bucket with
more than ``BUCKET`` fingerprints is cut again by the same principle: its
free bits (at most 33) go into 8 groups, of which a linked pair shares 5, so
it is dealt out on 56 finer keys whose buckets hold at most 2**13
fingerprints, whatever the data.  Components of the links come from
alternating large-star and small-star steps, staged in shared storage.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.common import bounded_broadcast
from .common import read, stage, text_bytes, text_key

SHINGLE, MAX_BITS, SEED = 3, 3, 42
BLOCKS, GROUPS, BUCKET = 6, 8, 4096
BLANKS = re.compile(rb"[\x20\x09-\x0D]+")


def fingerprint(text: bytes, words: int = SHINGLE, stretch: int = 1 << 16) -> int:
    """Bit i is set if it is set in over half the shingles' hashes; A-Z lower-cased; no words: zero.

    Shingles are hashed ``stretch`` at a time, so a very long text takes no list of its words.
    """
    line = BLANKS.sub(b" ", text.lower()).strip(b" ")  # on bytes: ASCII only, as the definition asks
    if not line:
        return 0
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 0x20)
    starts, ends = np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(line)]])
    k = min(words, len(starts))
    n, total = len(starts) - k + 1, np.zeros(64, np.int64)
    for a in range(0, n, stretch):
        b = min(n, a + stretch)
        hashes = b"".join([xxhash.xxh64_digest(line[s:e], SEED) for s, e in zip(starts[a:b].tolist(), ends[a + k - 1:b + k - 1].tolist())])
        total += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE) -> DataFrame:
    """``(id, text_key, fp)`` of every row; ``text_key`` tells rows that repeat an id with another text apart."""
    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t, words) for t in text_bytes(b.column(2))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps, pa.int64())],
                                             names=["id", "text_key", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_key(text_col).alias("text_key"),
                       F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, text_key long, fp long")


def _masks(positions: list[int], groups: int, shared: int) -> list[int]:
    """The masks of every choice of ``shared`` out of ``groups`` even cuts of the bit positions."""
    cuts = [sum(1 << int(p) for p in part) for part in np.array_split(positions, groups)]
    return [sum(c) for c in combinations(cuts, shared)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _keys(masks: list[int]):
    return F.explode(F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                               for i, m in enumerate(masks)])).alias("k")


def forest(fps: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of one bucket: (root, member), each member reached over verified distances."""
    links, left = [], np.arange(len(fps))
    while len(left) > 1:
        root, left, todo = int(left[0]), left[1:], [int(left[0])]
        while todo and len(left):
            near = np.bitwise_count(fps[left] ^ fps[todo.pop()]) <= most
            hit = left[near].tolist()
            links += [(root, x) for x in hit]
            todo += hit
            left = left[~near]
    return links


def _verify(most: int):
    """Buckets come as runs of equal (t, key) in sorted batches; an open run is carried to the next batch."""
    def links_of(t, key, fp):
        edge = np.flatnonzero((t[1:] != t[:-1]) | (key[1:] != key[:-1])) + 1
        begin, end = np.concatenate([[0], edge]), np.concatenate([edge, [len(t)]])
        size = end - begin
        two = begin[size == 2]
        two = two[np.bitwise_count((fp[two] ^ fp[two + 1]).view(np.uint64)) <= most]
        a, b = [fp[two]], [fp[two + 1]]
        for s, e in zip(begin[size > 2].tolist(), end[size > 2].tolist()):
            if links := forest(fp[s:e].view(np.uint64), most):
                i, j = np.array(links).T
                a.append(fp[s:e][i])
                b.append(fp[s:e][j])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    def run(batches):
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            t, key, fp = cols if rest is None else [np.concatenate(x) for x in zip(rest, cols)]
            open_run = np.flatnonzero((t != t[-1]) | (key != key[-1]))
            cut = int(open_run[-1]) + 1 if len(open_run) else 0
            rest = (t[cut:], key[cut:], fp[cut:])
            if cut:
                yield links_of(t[:cut], key[:cut], fp[:cut])
        if rest is not None:
            yield links_of(*rest)

    return run


def _bucket_links(rows: DataFrame, most: int) -> DataFrame:
    """``(t, key, fp)`` -> links ``(a, b)``, bucket by bucket."""
    return (rows.select("t", "key", "fp").repartition("t", "key").sortWithinPartitions("t", "key", "fp")
            .mapInArrow(_verify(most), "a long, b long"))


def links(distinct: DataFrame, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """Verified links between distinct fingerprints ``fp`` that connect the same ones as all links do."""
    blocks = max_bits + 3
    masks = _masks(list(range(64)), blocks, blocks - max_bits)
    rows = distinct.select("fp", _keys(masks)).select("k.*", "fp")
    large = stage(rows.groupBy("t", "key").count().where(F.col("count") > bucket).select("t", "key"), "simhash_large")
    if large.isEmpty():
        return _bucket_links(rows, max_bits)
    large = bounded_broadcast(large)
    finer = []
    for t, m in enumerate(masks):  # few distinct t, each with its own free bits
        free = [p for p in range(64) if not m >> p & 1]
        finer.append([m | x for x in _masks(free, GROUPS, GROUPS - max_bits)])
    per = len(finer[0])
    hot = rows.join(large, ["t", "key"], "left_semi")
    table = F.array(*[F.array(*[F.lit(_signed(x)) for x in row]) for row in finer])
    hot = hot.select("t", "fp", F.posexplode(table[F.col("t")]).alias("i", "m"))
    hot = hot.select((F.col("t") * per + F.col("i")).alias("t"), F.col("fp").bitwiseAND(F.col("m")).alias("key"), "fp")
    return (_bucket_links(rows.join(large, ["t", "key"], "left_anti"), max_bits)
            .unionByName(_bucket_links(hot, max_bits)))


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node with a link; root is the smallest node of its component.

    Large-star ties each larger neighbour to the smallest node around, small-star
    the smaller ones; they alternate, every step staged, until nothing moves.
    """
    def state(e):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    e = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
              "components")
    now = state(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stage(large, "components")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*").where("u <> v").distinct()
        e = stage(small, "components")
        before, now = now, state(e)
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE,
                       max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """``(id, text_key, fp, root, component_id)`` of every row: the group's fingerprint and the smallest id reachable over links.

    Null and empty texts, and texts of white space alone, have fingerprint zero,
    which links like any other.  Fewer words than a shingle hash as a whole.
    Repeated rows each get their row.  Null ids count as larger than any id: the
    component of null ids alone is null.  An empty table gives no rows; other
    columns are not read.
    """
    rows = stage(fingerprints(docs, id_col, text_col, words), "simhash_fingerprints")
    distinct = stage(rows.groupBy("fp").agg(F.min("id").alias("first")), "simhash_distinct")
    roots = components(links(distinct, max_bits, bucket))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = stage(rooted, "simhash_roots")
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = rooted.join(smallest, "root").select("fp", "root", "component_id")
    return rows.join(by_fp, "fp").select("id", "text_key", "fp", "root", "component_id")


def op9_simhash(spark, sf_dir: str) -> DataFrame:
    """``op9``: fingerprint and component of every document."""
    out = simhash_components(read(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
