"""Merkle manifest of a dataset: a tree of hashes for each source, a tree over the sources, proofs and folds.

A leaf is the hash of a row's fields; ``FAN`` consecutive nodes become the hash
of their digests (as hex text), level by level, until one remains.  A parent
keeps a copy of its running hash state before each child's slot (the midstate),
so that another digest in a slot is folded in by resuming that state with the
replacement and the children to its right alone; those on the left are never
hashed again.

On a cluster the tree is cut into tiles of ``TILE_LEVELS`` levels (256 leaves).
Rows are sorted by range and numbered within their source, however many
partitions a source fills; a tile is one row with an array of its children,
whose root is a child of a tile of the next round, until a source has one
node.  Then the way back down: each tile hands its children the siblings on
their way to the root, and the tiles of leaves fold and prove their rows with
them.  So no task holds more than a batch of tiles, and a tile's siblings, not
a leaf's, are moved.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import read, stage

FAN, TILE_LEVELS = 16, 2
TILE = FAN ** TILE_LEVELS
WAY = "array<struct<left string, right string>>"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Slots:
    """One level above a node: the state before each slot, and what stands right of it."""

    def __init__(self, children: list[bytes]):
        state, self.children, self.before = sha256(), children, []
        for child in children:
            self.before.append(state.copy())
            state.update(child)
        self.digest = state.hexdigest().encode()

    def fold(self, slot: int, digest: bytes) -> bytes:
        """The parent's digest with another child in ``slot``."""
        state = self.before[slot].copy()
        state.update(digest)
        state.update(b"".join(self.children[slot + 1:]))
        return state.hexdigest().encode()

    def beside(self, slot: int) -> tuple[bytes, bytes]:
        return b"".join(self.children[:slot]), b"".join(self.children[slot + 1:])


class Step:
    """One level of a way to the root, as handed down: its state after the left siblings, and the right ones."""

    def __init__(self, left: str, right: str):
        self.state, self.left, self.right = sha256(left.encode()), left.encode(), right.encode()

    def fold(self, digest: bytes) -> bytes:
        state = self.state.copy()
        state.update(digest)
        state.update(self.right)
        return state.hexdigest().encode()


class Tile:
    """The levels above up to ``TILE`` nodes: all ``TILE_LEVELS``, or till one node remains."""

    def __init__(self, nodes: list[bytes], whole: bool):
        self.levels = []
        while len(self.levels) < TILE_LEVELS and (whole or len(nodes) > 1):
            runs = [Slots(nodes[a:a + FAN]) for a in range(0, len(nodes), FAN)]
            self.levels.append(runs)
            nodes = [r.digest for r in runs]
        self.root = nodes[0]

    def way(self, i: int) -> list[tuple[bytes, bytes]]:
        """Left and right siblings of node ``i`` and of the nodes above it."""
        return [runs[i // FAN ** (n + 1)].beside(i // FAN ** n % FAN) for n, runs in enumerate(self.levels)]

    def fold(self, i: int, digest: bytes) -> bytes:
        for runs in self.levels:
            digest = runs[i // FAN].fold(i % FAN, digest)
            i //= FAN
        return digest


def leaf(columns: list) -> Column:
    """Hash of the fields: ``-`` for null, else byte count, ``:``, value."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)).cast("binary"), 256)


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``pos``: the place of a row in its group ``g``, from 0; no task sees more than its own range of the order.

    The last sort key tells equal rows apart, so that a third of all rows being
    equal still spreads over the ranges.  Sizes are a row for each group and range.
    """
    ranged = rows.withColumn("same", F.monotonically_increasing_id()).orderBy("g", *order, "same").drop("same")
    kept = stage(ranged.withColumn("mid", F.monotonically_increasing_id()), "merkle_order")
    kept = kept.withColumns({"range": F.shiftright("mid", 33), "at": F.col("mid").bitwiseAND((1 << 33) - 1)}).drop("mid")
    before = Window.partitionBy("g").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = kept.groupBy("g", "range").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    sizes = sizes.select("g", "range", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("off"))
    return kept.join(sizes, ["g", "range"]).withColumn("pos", F.col("at") + F.col("off")).drop("range", "at", "off")


def tiles_of(nodes: DataFrame) -> DataFrame:
    """``(g, tile, rows)``: at most ``TILE`` nodes in a row, in order."""
    tile = F.floor(F.col("pos") / TILE).cast("long").alias("tile")
    node = F.struct("pos", *(c for c in nodes.columns if c not in ("g", "pos")))
    return stage(nodes.groupBy("g", tile).agg(F.array_sort(F.collect_list(node)).alias("rows")), "merkle_tiles")


def _rows(batch: pa.RecordBatch, *names: str):
    """For each tile of a batch: its row number, and lists of the named fields of its nodes."""
    lists = batch.column(batch.schema.get_field_index("rows"))
    ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]).tolist()
    flat = lists.flatten()
    fields = [flat.field(flat.type.get_field_index(n)).to_pylist() for n in names]
    for i, (a, z) in enumerate(zip(ends, ends[1:])):
        yield i, *([x if not isinstance(x, str) else x.encode() for x in f[a:z]] for f in fields)


def _roots(batches):
    """A node of the next round for each tile: its digest as one of many, and as the last one of its group."""
    for b in batches:
        whole, alone = [], []
        for _, digests, single in _rows(b, "whole", "alone"):
            whole.append(Tile(digests, True).root.decode())
            alone.append((single[0] if len(digests) == 1 else Tile(digests, False).root).decode())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(whole, pa.string()), pa.array(alone, pa.string())], ["g", "pos", "whole", "alone"])


def climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The tiles of each round, and ``(g, digest)`` of each group's root."""
    rounds = []
    while True:
        rounds.append(tiles_of(nodes))
        nodes = rounds[-1].select("g", "tile", "rows").mapInArrow(_roots, "g string, pos long, whole string, alone string")
        if rounds[-1].where("tile > 0").isEmpty():
            return rounds, stage(nodes.select("g", F.col("alone").alias("digest")), "merkle_roots")


def _ways(key: str):
    """For each child of a tile: ``key`` or the child's place, whether it is its group's last node, and its way up."""
    def run(batches):
        for b in batches:
            carried = {c: b.column(b.schema.get_field_index(c)).to_pylist() for c in ("g", "subroot", "only", "way")}
            out = {c: [] for c in ("g", "tile", "subroot", "only", "way")}
            for i, digests, keys in _rows(b, "whole", key):
                g, subroot, only, above = (carried[c][i] for c in ("g", "subroot", "only", "way"))
                tile, above = Tile(digests, not only), [(x["left"], x["right"]) for x in above]
                for n, k in enumerate(keys):
                    out["g"].append(k.decode() if key == "key" else g)
                    out["tile"].append(0 if key == "key" else k)
                    out["subroot"].append(digests[n].decode() if key == "key" else subroot)
                    out["only"].append(True if key == "key" else only and len(digests) == 1)
                    out["way"].append([{"left": x.decode(), "right": y.decode()} for x, y in tile.way(n)] + [{"left": x, "right": y} for x, y in above])
                if len(out["g"]) >= 512:
                    yield _way_rows(out)
                    out = {c: [] for c in out}
            yield _way_rows(out)

    return run


def _way_rows(out: dict) -> pa.RecordBatch:
    way = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
    return pa.RecordBatch.from_arrays([pa.array(out[c], t) for c, t in zip(out, (pa.string(), pa.int64(), pa.string(), pa.bool_(), way))], [*out])


def descend(rounds: list[DataFrame], top: DataFrame, key: str = "pos") -> DataFrame:
    """``(g, tile, subroot, only, way)`` for the children of the last of ``rounds``, from that of each group's root."""
    for tiles in reversed(rounds):
        way = tiles.join(top, ["g", "tile"]).select("g", "tile", "rows", "subroot", "only", "way")
        top = stage(way.mapInArrow(_ways(key if tiles is rounds[0] else "pos"), f"g string, tile long, subroot string, only boolean, way {WAY}"), "merkle_ways")
    return top


def _proofs(id_type: str, whole_way: bool):
    def run(batches):
        for b in batches:
            subroots, onlies, ways = (b.column(b.schema.get_field_index(c)).to_pylist() for c in ("subroot", "only", "way"))
            lists = b.column(b.schema.get_field_index("rows"))
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]).tolist()
            ids = lists.flatten().field(lists.type.value_type.get_field_index("id"))
            for i, leaves, others in _rows(b, "whole", "other"):
                tile, above = Tile(leaves, not onlies[i]), [Step(x["left"], x["right"]) for x in ways[i]]
                beside = b"".join(s.left + s.right for s in above)
                proofs, folded, full = [], [], []
                for n, (own, other) in enumerate(zip(leaves, others)):
                    way = tile.way(n)
                    proofs.append(sha256(b"".join(x + y for x, y in way) + beside).hexdigest())
                    digest = tile.fold(n, other or own)
                    for step in above:
                        digest = step.fold(digest)
                    folded.append(digest.decode())
                    if whole_way:
                        full.append([{"left": x.decode(), "right": y.decode()} for x, y in way + [(s.left, s.right) for s in above]])
                cols = [ids.slice(ends[i], len(leaves)), pa.array([x.decode() for x in leaves]), pa.array([subroots[i]] * len(leaves), pa.string()),
                        pa.array(proofs), pa.array(folded)]
                names = ["id", "leaf", "subroot", "proof_sha256", "folded_root"]
                if whole_way:
                    cols.append(pa.array(full, pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))))
                    names.append("proof")
                yield pa.RecordBatch.from_arrays(cols, names)

    return run


def manifest(docs: DataFrame, other: Column | None = None, fields=FIELDS, id_col: str = "doc_id", source_col: str = "source",
             with_proof: bool = False) -> DataFrame:
    """``(id, leaf, subroot, root, proof_sha256, folded_root, verified)`` of every row.

    ``folded_root`` is the root that the row's proof gives for another leaf,
    ``other`` (null: the row's own); ``verified`` tells whether it is the root.
    ``with_proof`` adds ``proof``: the left and right siblings of each level,
    each as one string of digests.  Nulls hash as ``-``; sources and ids sort
    with null first, rows that repeat an id by their leaf; equal rows are
    leaves of their own; a source of one row has its leaf as subroot, a single
    source its subroot as root, and a proof without siblings is the hash of
    nothing; an empty table gives no rows.  Other columns play no part.
    """
    own = leaf([F.col(c) for c in fields])
    id_type = docs.schema[id_col].dataType.simpleString()
    group = F.when(F.col(source_col).isNull(), "").otherwise(F.concat(F.lit("="), F.col(source_col).cast("string")))  # null first, in byte order
    rows = stage(docs.select(group.alias("g"), F.col(id_col).alias("id"), own.alias("whole"),
                             (F.lit(None).cast("string") if other is None else other).alias("other")), "merkle_leaves")
    leaves = numbered(rows, ["id", "whole"]).withColumn("alone", F.col("whole"))
    rounds, subroots = climb(leaves.select("g", "pos", "whole", "alone", "id", "other"))
    sources = subroots.select(F.lit("").alias("g"), F.col("g").alias("key"), F.col("digest").alias("whole"), F.col("digest").alias("alone"))
    upper, top = climb(numbered(sources, ["key"]))
    first = top.first()
    root = first["digest"] if first else None
    ways = descend(upper, top.select("g", F.lit(0).cast("long").alias("tile"), F.lit("").alias("subroot"), F.lit(True).alias("only"), F.array().cast(WAY).alias("way")), "key")
    ways = descend(rounds[1:], ways)
    names = f"id {id_type}, leaf string, subroot string, proof_sha256 string, folded_root string" + f", proof {WAY}" * with_proof
    out = rounds[0].join(ways, ["g", "tile"]).select("rows", "subroot", "only", "way").mapInArrow(_proofs(id_type, with_proof), names)
    return out.select(F.col("id").alias(id_col), "leaf", "subroot", F.lit(root).cast("string").alias("root"), "proof_sha256", "folded_root",
                      (F.col("folded_root") == F.lit(root)).alias("verified"), *["proof"] * with_proof)


def op13_merkle(spark, sf_dir: str) -> DataFrame:
    """``op13``: every document's place in the tree; those whose id's checksum 5 divides are folded with their text lower-cased."""
    lowered = leaf([F.translate("text", UPPER, LOWER) if c == "text" else F.col(c) for c in FIELDS])
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return manifest(read(spark, sf_dir, "documents"), F.when(tampered, lowered))
