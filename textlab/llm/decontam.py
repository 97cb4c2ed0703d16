"""Benchmark decontamination by winnowing.

Both sides are cut into words and hashed in k-word grams; of every ``w``
consecutive grams the one with the smallest hash (the rightmost of equal
ones) is kept as a fingerprint.  With ``k + w - 1 = window`` a shared run of
``window`` words holds the same ``w`` grams on both sides, so both keep the
same gram of it: every window shared with the benchmark shows as a joined
fingerprint.  Each joined fingerprint is extended to all windows that cover
it, and these are compared word for word, so hash collisions change nothing.
An item shorter than a window is one window of its own length; its texts are
found by the gram hash of that length at every position.

The documents are never shuffled.  The benchmark's distinct rows join them in
parts of at most ``PART_WORDS`` words, each of which is broadcast as sorted
arrays of some 50 bytes a word (that bounds a part whatever the benchmark's
size); a longer item is cut into stretches that share ``window - 1`` words, so
each of its windows is in one.  A larger benchmark takes more passes, which add
to the spans and items of each row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, mix, pieces, split_words, stage, text_buffer, text_bytes, word_hashes

WINDOW, GRAM = 10, 5  # so 6 grams a window
PART_WORDS = 1_000_000
SCANS = 4

# Words: A-Z (lower-cased), a-z, digits and every byte of a non-ASCII character.
IS_WORD = np.zeros(256, bool)
IS_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_U = np.uint64


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive word hashes (positions that cross a text border included)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, _U)
    g = np.full(n, k, _U)
    for j in range(k):
        g = g * _U(0x100000001B3) + h[j:j + n]
    return mix(g)


def grams_at(h: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The hashes of :func:`gram_hashes` at the given positions."""
    g = np.full(len(at), k, _U)
    for j in range(k):
        g = g * _U(0x100000001B3) + h[at + j]
    return mix(g)


def winnow(g: np.ndarray, doc: np.ndarray, k: int, w: int) -> np.ndarray:
    """Positions of the grams kept: the rightmost smallest of every w grams that lie in one text."""
    n = len(g) - w + 1
    if n <= 0:
        return np.empty(0, np.int64)
    best, at = g[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, w):
        other = g[j:j + n]
        less = other <= best
        best[less] = other[less]
        at[less] = j
    inside = doc[:n] == doc[k + w - 2:k + w - 2 + n]
    keep = np.zeros(len(g), bool)
    keep[(np.arange(n) + at)[inside]] = True
    return np.flatnonzero(keep)


def spelled(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All words, a space after each, and where each begins (and the last one ends)."""
    size = end - start + 1
    offs = np.concatenate([[0], np.cumsum(size)])
    out = np.full(offs[-1], 0x20, np.uint8)
    inside = np.ones(len(out), bool)
    inside[offs[1:] - 1] = False
    out[inside] = buf[np.repeat(start - offs[:-1], size - 1) + np.flatnonzero(inside)]
    return out, offs


class Windows:
    """The benchmark's windows of ``k`` words: distinct hashes in order, a place of each, and the items that hold it."""

    def __init__(self, k: int, hashes: np.ndarray, place: np.ndarray, item: np.ndarray, words: tuple[np.ndarray, np.ndarray]):
        order = np.lexsort((place, hashes))
        hashes, place, item = hashes[order], place[order], item[order]
        text, offs = words
        self.k, self.clash = k, {}  # windows of another text than the first one with their hash: text -> items
        first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
        model = np.repeat(place[first], np.diff(np.append(first, len(hashes))))
        for i in np.flatnonzero(place != model).tolist():
            own = text[offs[place[i]]:offs[place[i] + k] - 1].tobytes()
            if own != text[offs[model[i]]:offs[model[i] + k] - 1].tobytes():
                self.clash.setdefault(own, set()).add(int(item[i]))
                item[i] = -1
        hashes, place, item = (x[item >= 0] for x in (hashes, place, item))
        first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
        self.hashes, self.place, self.item = hashes[first], place[first], item.astype(np.int32)
        self.edges = np.append(first, len(hashes))

    def find(self, h: np.ndarray) -> np.ndarray:
        """Index of each hash, or -1."""
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, at, -1)


class Part:
    """A bounded part of the benchmark: fingerprints and exact windows with the items that hold them."""

    def __init__(self, rows: list[tuple[str, bytes]], window: int = WINDOW, gram: int = GRAM):
        self.window, self.gram, self.grams = window, gram, window - gram + 1
        self.ids = [item_id for item_id, _ in rows]
        buf = LOWER[np.frombuffer(b"".join(text for _, text in rows), np.uint8)]
        offs = np.concatenate([[0], np.cumsum([len(text) for _, text in rows])]).astype(np.int64)
        start, end, item = split_words(buf, offs, IS_WORD)
        size = np.bincount(item, minlength=len(rows))
        h, self.words = word_hashes(buf, start, end), spelled(buf, start, end)
        long, self.prints, self.windows = size[item] >= window, np.empty(0, _U), []
        if len(g := gram_hashes(h, gram)):
            at = winnow(g, item, gram, self.grams)
            self.prints = np.unique(g[at])
        for k in np.unique(np.minimum(size[size > 0], window)).tolist():
            here = np.flatnonzero(long if k == window else (size[item] == k))
            here = here[here + k <= len(item)]
            here = here[item[here] == item[here + k - 1]]
            self.windows.append(Windows(k, gram_hashes(h, k)[here], here, item[here], self.words))

    @staticmethod
    def joined(g: np.ndarray, prints: np.ndarray) -> np.ndarray:
        at = np.searchsorted(prints, g)
        at[at == len(prints)] = 0
        return prints[at] == g

    def scan(self, buf: np.ndarray, offs: np.ndarray):
        """``(words of each text, {text: (spans, items)})`` of adjacent texts."""
        buf = LOWER[buf]
        start, end, doc = split_words(buf, offs, IS_WORD)
        n, found = len(start), {}
        n_words = np.bincount(doc, minlength=len(offs) - 1)
        first_word = np.concatenate([[0], np.cumsum(n_words)])
        h, (words, spots) = word_hashes(buf, start, end), self.words
        for w in self.windows:
            k = w.k
            if n < k:
                continue
            if k == self.window:
                prints = gram_hashes(h, self.gram)
                at = winnow(prints, doc, self.gram, self.grams)
                at = at[self.joined(prints[at], self.prints)] if len(self.prints) else at[:0]
                s = np.unique((at[:, None] - np.arange(self.grams)).ravel())  # extend: all windows over the gram
                s = s[(s >= 0) & (s + k <= n)]
                at = w.find(grams_at(h, s, k))
            else:
                s = np.arange(n - k + 1)
                at = w.find(gram_hashes(h, k))
            s, at = s[at >= 0], at[at >= 0]
            same = doc[s] == doc[s + k - 1]
            for i, j in zip(s[same].tolist(), at[same].tolist()):
                text = b" ".join([buf[a:b].tobytes() for a, b in zip(start[i:i + k].tolist(), end[i:i + k].tolist())])
                p = w.place[j]
                same_text = words[spots[p]:spots[p + k] - 1].tobytes() == text
                own = w.item[w.edges[j]:w.edges[j + 1]].tolist() if same_text else w.clash.get(text)
                if own:
                    d = int(doc[i])
                    spans, items = found.setdefault(d, ([], set()))
                    spans.append((i - int(first_word[d]), i - int(first_word[d]) + k))
                    items.update(own)
        return n_words, {d: (spans, {self.ids[x] for x in items}) for d, (spans, items) in found.items()}


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def item_stretches(part_words: int, window: int = WINDOW):
    """Cuts texts of over ``part_words`` words into stretches that share ``window - 1`` words; texts without words go."""
    most = max(part_words, window)

    def run(batches):
        for batch in batches:
            out = []
            for item, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
                start, end, _ = split_words(np.frombuffer(text, np.uint8), np.array([0, len(text)]), IS_WORD)
                if len(start) <= most:
                    out += [(item, text, len(start))] if len(start) else []
                    continue
                for i in range(0, len(start) - window + 1, most - window + 1):
                    last = min(i + most, len(start))
                    out.append((item, text[start[i]:end[last - 1]], last - i))
            items, texts, n = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())],
                                             names=["item", "text", "n"])

    return run


def benchmark_parts(benchmark: DataFrame, id_col: str, text_col: str, part_words: int = PART_WORDS) -> list[DataFrame]:
    """The distinct rows of the benchmark, long ones in stretches, in parts of at most ``part_words`` words (a window at least).

    Rows go to buckets by a hash; buckets are halved until each fits, and filled into parts in turn.
    """
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                            F.coalesce(F.col(text_col), F.lit("")).alias("text")).distinct()
    rows = stage(rows.mapInArrow(item_stretches(part_words), "item string, text string, n long").distinct(), "benchmark")
    most = max(part_words, WINDOW)
    buckets = max(1, -(-int(rows.agg(F.sum("n")).first()[0] or 0) // most))
    while True:
        bucket = F.pmod(F.xxhash64("item", "text"), F.lit(buckets))
        sums = sorted(tuple(r) for r in rows.groupBy(bucket.alias("bucket")).agg(F.sum("n")).collect())  # a few rows a part
        if all(n <= most for _, n in sums) or buckets >= 1 << 40:
            break
        buckets *= 2
    parts, left = [[]], most
    for i, n in sums:
        if n > left and parts[-1]:
            parts.append([])
            left = most
        parts[-1].append(i)
        left -= n
    rows = rows.withColumn("bucket", bucket)
    return [rows.where(F.col("bucket").isin(ids)).select("item", "text") for ids in parts]


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text", part_words: int = PART_WORDS) -> tuple[DataFrame, dict[str, str]]:
    """All rows and columns of ``docs`` plus ``n_words``, the merged word spans hit, and the items found (as strings).

    Returns the table and the names the three new columns got (underscores are
    added where ``docs`` has such a column).  Null and empty texts have no words
    and no hits; repeated rows are each scanned; an empty benchmark hits
    nothing; items without words, or with a null text, have no windows; a null
    item id reads as the empty string.
    """
    spark = docs.sparkSession
    names = {k: free_name(docs, k) for k in ("n_words", "spans", "items")}
    out = docs.withColumns({names["n_words"]: F.lit(0).cast("long"), names["spans"]: F.array().cast(SPANS),
                            names["items"]: F.array().cast("array<string>")})
    for n, rows in enumerate(benchmark_parts(benchmark, item_id, item_text, part_words)):
        if n and n % SCANS == 0:  # each scan is a Python worker and a part in its memory: a task has at most SCANS of them
            out = stage(out, "decontam_scans")
        part = spark.sparkContext.broadcast(Part([(r["item"], r["text"].encode()) for r in rows.toLocalIterator()]))
        out = out.mapInArrow(_scanner(part, text_col, names), out.schema)
    return out, names


def _scanner(part, text_col: str, names: dict[str, str]):
    def scan(batches):
        for batch in batches:
            at = {k: batch.schema.get_field_index(v) for k, v in names.items()}
            data, offs = text_buffer(batch.column(batch.schema.get_field_index(text_col)))
            counts = np.zeros(batch.num_rows, np.int64)
            spans, items = batch.column(at["spans"]).to_pylist(), batch.column(at["items"]).to_pylist()
            for a, b in pieces(offs):
                counts[a:b], found = part.value.scan(data[offs[a]:offs[b]], offs[a:b + 1] - offs[a])
                for d, (new, ids) in found.items():
                    old = [(x["start"], x["end"]) for x in spans[a + d]]
                    spans[a + d] = [{"start": s, "end": e} for s, e in merged(old + new)]
                    items[a + d] = sorted({*items[a + d], *ids})
            cols = list(batch.columns)
            cols[at["n_words"]] = pa.array(counts, pa.int64())
            for k, values in (("spans", spans), ("items", items)):
                cols[at[k]] = pa.array(values, batch.schema.field(at[k]).type)
            yield pa.RecordBatch.from_arrays(cols, schema=batch.schema)

    return scan


def hit_words(spans: str) -> Column:
    """Words inside the merged spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])


def op5_decontaminate(spark, sf_dir: str) -> DataFrame:
    """``op5``: hits of benchmark windows in every document, see the module docstring."""
    from .common import read

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found, c = decontaminate(docs, read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", F.col(c["n_words"]).alias("n_words"), hit_words(c["spans"]).alias("n_hit"),
        F.size(c["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(c["items"]), ","), 256).alias("items_sha256"),
        (hit_words(c["spans"]) > 0).alias("contaminated"))
