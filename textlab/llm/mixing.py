"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Every source is cut into blocks by a hash of its rows; the block's place in
the source's hash order is a random permutation.  The source's target fixes
its quota: whole passes over all its blocks, then what fits of one more pass in
another permuted order, then a part of the smallest block left (document by
document, whatever still fits).  Where long documents leave a gap, one more
pass fills it, within the limit of repeats.  The quotas are exact, and a tree splits them
among the output shards: at each node the left half of the shards gets a
multivariate-hypergeometric draw from the node's blocks.  At a leaf a shard
knows how many blocks of each source it holds; the sources' block sequences
are dealt to the shards in these lengths, so no draw is dealt twice.  Rows
then move once, to their shard, and are shuffled there by hash.

Only tables of one row a source and one row a block reach the driver; the
number of blocks is a parameter and not tied to the input.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.common import global_row_number
from .common import free_name, read, stage

WEIGHTS = (5.0, 2.0, 1.0)
MOST_REPEATS = 3.0
BLOCKS, SHARDS, SEED = 8192, 16, 20240229
SLICE_WORDS = 16_000_000  # about 100 MB of text
BROADCAST_KEYS = 1_000_000  # some 50 MB; more keys are joined by a merge
NEAR = 0.002  # share of a target that may be missing before a source is gone through once more


def word_count(text_col: str):
    """Number of runs of non-blank characters; null is 0."""
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: list[float], most: float = MOST_REPEATS) -> list[float]:
    """Shares of the total by weight; a target over ``most`` times its size stops there, the excess is reshared by weight."""
    total, fixed, out = float(sum(sizes)), set(), [0.0] * len(sizes)
    while len(fixed) < len(sizes):
        open_ = [i for i in range(len(sizes)) if i not in fixed]
        rest, weight = total - sum(out[i] for i in fixed), sum(weights[i] for i in open_)
        for i in open_:
            out[i] = rest * weights[i] / weight
        over = [i for i in open_ if out[i] > most * sizes[i]]
        if not over:
            break
        for i in over:
            out[i] = most * sizes[i]
        fixed.update(over)
    return out


def split_tree(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """``(shards, sources)`` block counts: every node deals its left shards a multivariate-hypergeometric draw."""
    if shards == 1:
        return quotas[None, :]
    left = shards // 2
    take = int(quotas.sum()) * left // shards
    drawn, rest, pool = np.zeros_like(quotas), take, int(quotas.sum())
    for i, q in enumerate(quotas.tolist()):  # source by source: the conditional draws of the multivariate law
        pool -= q
        if rest and q:
            drawn[i] = rng.hypergeometric(q, pool, rest) if pool else rest
        rest -= int(drawn[i])
    return np.concatenate([split_tree(drawn, left, rng), split_tree(quotas - drawn, shards - left, rng)])


@dataclass
class Mix:
    """The input's rows and columns plus those in ``names``, the words that the mix takes, and its number of shards."""

    rows: DataFrame
    names: dict[str, str]
    words: int
    shards: int
    seed: int


DRAWS = "array<struct<epoch:int,shard:int>>"


def border_cut(group: pd.DataFrame) -> pd.DataFrame:
    """Which documents of a source's border block are taken: a row with the key up to which all are, and a row for each
    key after it of which any are, with the number of its copies that are taken.

    In key order every document that still fits is taken, copies of a row one by one.  If a gap is left, the shortest
    of the others goes in too and documents from the end go out for it, where the sum comes nearer to the target so
    and passes it by no more than the shortest of all.
    """
    rows = group.sort_values("key")
    left, sizes, many, keys = float(rows["words"].iloc[0]), rows["size"].to_numpy(), rows["n"].to_numpy(), rows["key"].to_numpy()
    taken = np.where(np.cumsum(sizes * many) <= left, many, 0)
    left -= int((sizes * taken).sum())
    for i in np.flatnonzero((taken == 0) & (sizes > 0) & (sizes <= left)):
        if sizes[i] <= left:
            taken[i] = min(many[i], int(left // sizes[i]))
            left -= int(sizes[i] * taken[i])
    over = np.flatnonzero((taken < many) & (sizes > 0))
    if len(over) and left > 0:
        best = over[np.argmin(sizes[over])]
        excess, out = float(sizes[best] - left), {}
        for i in np.flatnonzero((taken > 0) & (sizes > 0) & (sizes <= excess))[::-1]:
            if sizes[i] <= excess:
                out[i] = min(int(taken[i]), int(excess // sizes[i]))
                excess -= int(sizes[i] * out[i])
        if excess < left and excess <= sizes[sizes > 0].min():
            taken[best] += 1
            for i, n in out.items():
                taken[i] -= n
    full = taken == many
    n = len(full) if full.all() else int(np.argmin(full))
    later = n + np.flatnonzero(taken[n:] > 0)
    return pd.DataFrame({"i": [rows["i"].iloc[0]] * (1 + len(later)), "upto": pd.array([int(keys[n - 1]) if n else None] + [None] * len(later), "Int64"),
                         "key": pd.array([None, *keys[later].tolist()], "Int64"), "copies": pd.array([None, *taken[later].tolist()], "Int64"),
                         "whole": [True, *full[later].tolist()]})


def _some_copies(rows: DataFrame) -> DataFrame:
    """Rows of keys that are taken in part, with ``extra`` on as many of each key as ``copies`` says.

    They are numbered by a global sort, so that copies of one row, were they a third of all, are spread;
    written first, so that their order is the same for a task that is run again.
    """
    at, rows = free_name(rows, "place"), stage(rows, "mix_copies")
    numbered = global_row_number(rows.withColumn(at, F.monotonically_increasing_id()), ["i", "key", at], "nth")
    first = numbered.groupBy("i", "key").agg(F.min("nth").alias("first"))  # one row a key that is taken in part
    return (numbered.join(first, ["i", "key"]).withColumn("extra", F.col("nth") - F.col("first") < F.col("copies"))
            .select(*rows.columns, "extra"))


def mix_sources(docs: DataFrame, weights: tuple = WEIGHTS, source_col: str = "source", id_col: str = "doc_id",
                text_col: str = "text", most: float = MOST_REPEATS, blocks: int = BLOCKS, shards: int = SHARDS,
                seed: int = SEED) -> Mix:
    """All rows and columns of ``docs`` plus their size, their source's size and target, and their draws.

    ``draws`` is an array of (epoch, shard), one entry for each time the mix takes the
    row, at most ceil(most) of them.  New columns get underscores where their names are taken.
    Sources in code point order, null last, take the weights in turn.  Null and empty
    texts have size 0, and a source of such rows alone has target 0.  Rows that repeat an
    id and its text are taken one by one where the target ends among them.  An empty table gives no rows.  Other columns pass
    through.  Reruns with the same seed agree.
    """
    spark = docs.sparkSession
    names = {k: free_name(docs, k) for k in ("size", "source_size", "target", "draws")}
    given = [F.col(source_col).cast("string").alias("source"), word_count(text_col).alias("size"),
             F.xxhash64(F.lit(seed), F.col(id_col).cast("string"), F.col(text_col)).alias("key")]
    sized = stage(docs.select(*given), "mix_sizes")
    per = sized.groupBy("source").agg(F.sum("size").alias("size")).collect()
    per.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))  # UTF-8 bytes sort as code points do
    sizes = [int(r["size"]) for r in per]
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(per))], most)
    cuts = [max(1, math.ceil(blocks * s / max(1, sum(sizes)))) for s in sizes]
    sources = F.broadcast(spark.createDataFrame(  # one row a source
        [(r["source"], i, cuts[i], sizes[i], goal[i]) for i, r in enumerate(per)],
        "name string, i int, cuts long, source_size long, target double"))

    def blocked(df):
        """The hash order of a source's rows, cut evenly into its blocks."""
        place = F.shiftrightunsigned(F.xxhash64(F.lit(1), "key"), 32)
        return (df.join(sources, F.col("source").eqNullSafe(F.col("name")))
                .withColumn("b", F.shiftright(place * F.col("cuts"), 32).cast("int")))

    words = [np.zeros(n, np.int64) for n in cuts]
    for r in blocked(sized).groupBy("i", "b").agg(F.sum("size").alias("w")).collect():  # one row a block
        words[r["i"]][r["b"]] = r["w"]

    rng = np.random.default_rng(seed)
    sequences, borders = [], []
    for i, w in enumerate(words):
        epochs = int(goal[i] // sizes[i]) if sizes[i] else 0
        sequence = [(e, b) for e in range(epochs) for b in rng.permutation(len(w)).tolist()]
        left, skipped = goal[i] - epochs * sizes[i], []
        while sizes[i] and left >= max(0.5, NEAR * goal[i]) and epochs < most:
            skipped = []
            for b in rng.permutation(len(w)).tolist():  # what still fits, in permuted order
                if 0 < w[b] <= left:
                    sequence.append((epochs, b))
                    left -= int(w[b])
                elif w[b]:
                    skipped.append(b)
            epochs += 1
        if skipped and left >= 0.5:  # the smallest block left is cut
            b = min(skipped, key=lambda x: (w[x], x))
            sequence.append((epochs - 1, b))
            borders.append((i, b, epochs - 1, float(left)))
        sequences.append(sequence)
    dealt = split_tree(np.array([len(s) for s in sequences], np.int64), shards, rng)
    draws: dict[tuple[int, int], list] = {}
    for i, sequence in enumerate(sequences):
        for (epoch, b), shard in zip(sequence, np.repeat(np.arange(shards), dealt[:, i]).tolist()):
            draws.setdefault((i, b), []).append((epoch, shard))

    edge = F.broadcast(spark.createDataFrame(borders, "i int, b int, border int, words double"))  # at most one row a source
    cut = (blocked(sized).join(edge, ["i", "b"]).groupBy("i", "words", "key").agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("n"))
           .groupBy("i").applyInPandas(border_cut, "i int, upto long, key long, copies long, whole boolean"))  # about 1/blocks of all keys a group
    cut = stage(cut, "mix_border")
    extras = cut.where(F.col("key").isNotNull()).select("i", "key", "copies", "whole")  # a key is in one block
    parted = not extras.where("not whole").isEmpty()
    extras = F.broadcast(extras) if extras.count() <= BROADCAST_KEYS else extras.hint("merge")
    edge = edge.join(F.broadcast(cut.where(F.col("key").isNull()).select("i", "upto")), "i").drop("words")
    table = spark.createDataFrame([(i, b, sorted(d)) for (i, b), d in draws.items()], f"i int, b int, dealt {DRAWS}")

    wide = blocked(docs.select(F.struct("*").alias("row"), *given))  # no name in the row can clash
    wide = wide.join(F.broadcast(table), ["i", "b"], "left").join(F.broadcast(edge), ["i", "b"], "left")
    wide = wide.join(extras, ["i", "key"], "left")
    if parted:
        some = F.coalesce(~F.col("whole"), F.lit(False))
        wide = wide.where(~some).withColumn("extra", F.col("whole")).unionByName(_some_copies(wide.where(some)))
    else:
        wide = wide.withColumn("extra", F.col("whole"))
    inside = F.coalesce(F.col("key") <= F.col("upto"), F.lit(False)) | F.coalesce("extra", F.lit(False))
    taken = F.filter("dealt", lambda d: F.col("border").isNull() | (d["epoch"] != F.col("border")) | inside)
    wide = wide.select("row", "size", "source_size", "target", F.coalesce(taken, F.array().cast(DRAWS)).alias("draws"))
    wide = wide.select(*[F.col(k).alias(name) for k, name in names.items()], "row.*").select(*docs.columns, *names.values())
    return Mix(wide, names, round(sum(goal)), shards, seed)


def write_order(mix: Mix, id_col: str = "doc_id", text_col: str = "text", slice_words: int = SLICE_WORDS) -> DataFrame:
    """One row for each draw, moved to its shard and shuffled there, plus ``epoch``, ``shard`` and ``slice``.

    A shard is dealt by hash into slices of about ``slice_words`` words, one task each, and
    shuffled inside; slice after slice is a random order of the shard, whatever its size.
    Rows without an id are dealt by their text, so only copies of one row share a slice.
    """
    slices = max(1, math.ceil(mix.words / mix.shards / slice_words))
    df = mix.rows
    names = {k: free_name(df, k) for k in ("epoch", "shard", "slice")}
    draw, same = free_name(df, "draw"), free_name(df, "same")
    out = df.withColumn(draw, F.explode(mix.names["draws"])).drop(mix.names["draws"])
    out = out.withColumns({names["epoch"]: F.col(draw)["epoch"], names["shard"]: F.col(draw)["shard"]}).drop(draw)
    order = F.xxhash64(F.lit(mix.seed), F.col(names["epoch"]), F.col(id_col).cast("string"), F.col(text_col))
    out = out.withColumn(same, order).withColumn(names["slice"], F.pmod(F.col(same), F.lit(slices)).cast("int"))
    place = F.col(names["shard"]) * slices + F.col(names["slice"])
    return out.repartitionById(mix.shards * slices, place).sortWithinPartitions(names["shard"], names["slice"], F.xxhash64(same)).drop(same)


def op2_mix(spark, sf_dir: str) -> DataFrame:
    """``op2``: size, target of its source and words taken of every document."""
    mix = mix_sources(read(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    size, draws = F.col(mix.names["size"]), F.col(mix.names["draws"])
    return mix.rows.select("doc_id", size.alias("size"), F.col(mix.names["source_size"]).alias("source_size"),
                           F.col(mix.names["target"]).alias("target"), (size * F.size(draws)).alias("taken"),
                           F.transform(draws, lambda d: d["shard"]).alias("shards"))
