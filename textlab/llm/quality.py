"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of 64 words (in training longer ones in texts of over
128 passages, so a bag has at most 128 and covers the whole text).  A passage
is described by the frequencies of its bytes, its mean word length, its size
and how often a word repeats one shortly before, and encoded by a learned tanh layer.  Gated attention,
``softmax(w . (tanh(V h) * sigmoid(U h)))`` over the passages of a document,
weighs the encodings, and a logistic unit scores the weighted sum.  All
layers are learned together from document labels alone.

The fit uses at most ``TRAIN_ROWS`` labelled documents (those with the
smallest hash of the id, a documented bound); only their passage features
reach the driver, at most 128 vectors of 522 bytes a document (200 MB in all).  Scoring is one pass over
the documents without a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import free_name, pieces, read, split_words, text_buffer, word_hashes

TRAIN_ROWS = 3000
THRESHOLD = 0.3
PASSAGE_WORDS, MAX_PASSAGES = 64, 128
LONG_BYTES = 1 << 20
LAGS = (1, 2, 3)
FEATURES, HIDDEN, GATE = 258 + len(LAGS), 24, 12
EPOCHS, BATCH, RATE, DECAY = 40, 64, 0.01, 1e-4

NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[0x20, *range(0x09, 0x0E)]] = False


def stretches(buf: np.ndarray, most_bytes: int):
    """A long text in parts of about ``most_bytes`` that begin with a passage, so that their passages are those of the text."""
    at, size = 0, most_bytes
    while at + size < len(buf):
        start, _, _ = split_words(buf[at:at + size], np.array([0, size]), NOT_BLANK)
        last = (len(start) - 1) // PASSAGE_WORDS * PASSAGE_WORDS  # the passage that may go on behind the part
        if last > 0:
            yield buf[at:at + start[last]]
            at, size = at + int(start[last]), most_bytes
        else:
            size *= 2
    yield buf[at:]


def passages(buf: np.ndarray, offs: np.ndarray, most: int | None = MAX_PASSAGES) -> tuple[np.ndarray, np.ndarray]:
    """``(features of each passage, first passage of each text)``; a text without words is one passage.

    With ``most``, the passages of a text are longer where it would have more of them.
    """
    n_docs = len(offs) - 1
    start, end, doc = split_words(buf, offs, NOT_BLANK)
    words = np.bincount(doc, minlength=n_docs)
    size = np.maximum(PASSAGE_WORDS, -(-words // most)) if most else np.full(n_docs, PASSAGE_WORDS)
    count = np.maximum(1, -(-words // size))
    first = np.concatenate([[0], np.cumsum(count)])
    in_doc = np.arange(len(start)) - np.concatenate([[0], np.cumsum(words)])[doc]
    of_word = first[doc] + in_doc // size[doc]
    n = int(first[-1])
    # a passage runs from its first word to the next one's; a text's first passage from the text's start
    begin = np.zeros(n, np.int64)
    begin[of_word[::-1]] = start[::-1]
    begin[first[:-1]] = offs[:-1]
    length = np.diff(np.append(begin, offs[-1]))
    x = np.empty((n, FEATURES), np.float32)
    edges, at = np.append(begin, offs[-1]), 0
    while at < n:  # the bytes of about a megabyte of passages at a time
        to = max(at + 1, int(np.searchsorted(edges, edges[at] + (1 << 20), "right")) - 1)
        cell = np.repeat(np.arange(to - at, dtype=np.int64) * 256, length[at:to]) + buf[edges[at]:edges[to]]
        counts = np.bincount(cell, minlength=(to - at) * 256).reshape(-1, 256)
        x[at:to, :256] = np.sqrt(counts / np.maximum(length[at:to], 1)[:, None])
        at = to
    n_words = np.bincount(of_word, minlength=n)
    chars = np.bincount(of_word, weights=end - start, minlength=n)
    x[:, 256] = chars / np.maximum(n_words, 1) / 10
    x[:, 257] = np.minimum(n_words, PASSAGE_WORDS) / PASSAGE_WORDS
    h = word_hashes(buf, start, end)
    for i, lag in enumerate(LAGS):
        again = np.flatnonzero((h[lag:] == h[:-lag]) & (of_word[lag:] == of_word[:-lag])) + lag
        x[:, 258 + i] = np.bincount(of_word[again], minlength=n) / np.maximum(n_words, 1)
    return x, first


class Model:
    """Weights of the encoder, the gates and the output; ``prior`` alone decides when nothing was learned."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        shape = {"W": (FEATURES, HIDDEN), "b": (HIDDEN,), "V": (HIDDEN, GATE), "U": (HIDDEN, GATE), "w": (GATE,), "c": (HIDDEN,), "d": (1,)}
        self.p = {k: (rng.normal(0, 1 / np.sqrt(s[0]), s) if len(s) > 1 else np.zeros(s)).astype(np.float32) for k, s in shape.items()}
        self.p["w"] = rng.normal(0, 0.3, GATE).astype(np.float32)
        self.p["c"] = rng.normal(0, 0.3, HIDDEN).astype(np.float32)
        self.mean, self.scale = np.zeros(FEATURES, np.float32), np.ones(FEATURES, np.float32)
        self.prior: float | None = 0.5

    def gated(self, x):
        p = self.p
        x = np.clip((x - self.mean) * self.scale, -8, 8)
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        return x, h, t, s, (t * s) @ p["w"]

    def forward(self, x, first):
        p, starts, counts = self.p, first[:-1], np.diff(first)
        x, h, t, s, e = self.gated(x)
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), counts))
        a = e / np.repeat(np.add.reduceat(e, starts), counts)
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return x, h, t, s, a, z, 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))

    def score(self, x, first) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(first) - 1, self.prior)
        return self.forward(x, first)[-1].astype(np.float64)

    def score_parts(self, parts) -> np.ndarray:
        """The score of one text whose passages come in parts; only the attention's sums are held."""
        if self.prior is not None:
            return np.full(1, self.prior)
        top, total, z = -np.inf, 0.0, np.zeros(HIDDEN)
        for x in parts:
            _, h, _, _, e = self.gated(x)
            new = max(top, float(e.max()))
            a, keep = np.exp(e.astype(np.float64) - new), np.exp(top - new)
            top, total, z = new, total * keep + a.sum(), z * keep + a @ h
        return 1 / (1 + np.exp(-np.clip(z / total @ self.p["c"] + self.p["d"], -30, 30)))

    def gradient(self, x, first, y) -> dict:
        p, starts, counts = self.p, first[:-1], np.diff(first)
        x, h, t, s, a, z, out = self.forward(x, first)
        err = (out - y) / len(y)
        g = {"c": z.T @ err, "d": err.sum(keepdims=True)}
        dz = np.repeat(err[:, None] * p["c"], counts, axis=0)
        da = (dz * h).sum(axis=1)
        de = a * (da - np.repeat(np.add.reduceat(a * da, starts), counts))
        g["w"] = (t * s).T @ de
        dt, ds = de[:, None] * p["w"] * s * (1 - t * t), de[:, None] * p["w"] * t * s * (1 - s)
        g["V"], g["U"] = h.T @ dt, h.T @ ds
        dh = (a[:, None] * dz + dt @ p["V"].T + ds @ p["U"].T) * (1 - h * h)
        g["W"], g["b"] = x.T @ dh, dh.sum(axis=0)
        return g

    def fit(self, bags: list[np.ndarray], y: np.ndarray, seed: int = 7) -> "Model":
        """Adam over shuffled batches of documents; one class alone, or no rows, leaves the share of ones as the score."""
        if not len(y) or y.min() == y.max():
            self.prior = float(np.mean(y)) if len(y) else 0.5
            return self
        n = sum(map(len, bags))
        mean = sum(b.sum(axis=0, dtype=np.float64) for b in bags) / n
        squares = sum(np.einsum("ij,ij->j", b, b, dtype=np.float64) for b in bags) / n
        self.prior, self.mean = None, mean.astype(np.float32)
        self.scale = (1 / (np.sqrt(np.maximum(squares - mean * mean, 0)) + 1e-2)).astype(np.float32)
        rng, step = np.random.default_rng(seed), 0
        m, v = ({k: np.zeros_like(w) for k, w in self.p.items()} for _ in range(2))
        for epoch in range(EPOCHS):
            order = rng.permutation(len(y))
            for i in range(0, len(y), BATCH):
                rows = order[i:i + BATCH]
                x = np.concatenate([bags[r] for r in rows]).astype(np.float32)
                first = np.concatenate([[0], np.cumsum([len(bags[r]) for r in rows])])
                step += 1
                for k, g in self.gradient(x, first, y[rows]).items():
                    g = g + DECAY * self.p[k] * (k not in "bd")
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    rate = RATE * (1 - epoch / EPOCHS) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
                    self.p[k] = (self.p[k] - rate * m[k] / (np.sqrt(v[k]) + 1e-8)).astype(np.float32)
        return self


def held_out(id_col: str) -> Column:
    """The fold that is never learned from: crc32 of the id as text divisible by 5 (null reads as empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
          rows: int = TRAIN_ROWS) -> Model:
    """Fit on at most ``rows`` labelled documents outside the held-out fold, the smallest by hash of the id.

    Null ids and null labels are left out; an id with several labels counts with their mean;
    an id with several texts gives a bag for each, all with that label.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.avg(F.col(label_col).cast("double")).alias("y"))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    ids = known.join(texts.select("id").distinct(), "id", "left_semi")
    chosen = ids.orderBy(F.xxhash64("id", F.lit(11)), "id").limit(rows)  # at most `rows` rows: safe to broadcast

    def features(batches):
        for b in batches:
            data, offs = text_buffer(b.column(2))
            bags = []
            for i, j in pieces(offs):
                x, first = passages(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                bags += [x[s:e].astype(np.float16).tobytes() for s, e in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(bags, pa.binary())], names=["id", "y", "bag"])

    got = (texts.join(F.broadcast(chosen), "id").select("id", "y", "text")
           .mapInArrow(features, "id long, y double, bag binary")
           .orderBy(F.xxhash64("id", F.lit(11)), "id", "bag").limit(rows).toArrow())
    bags = [np.frombuffer(x.as_buffer(), np.float16).reshape(-1, FEATURES) for x in got.column("bag")]  # views, no copies
    return Model().fit(bags, np.array(got.column("y").to_pylist(), np.float32))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> tuple[DataFrame, str]:
    """All rows and columns of ``docs`` plus the score, and the name of that column.

    The score reads the text alone, all its passages of 64 words; those of a text of over a megabyte
    are read in stretches.  Null and empty texts score as a bag
    of one empty passage; equal texts score alike; it is rounded to 6 places.
    """
    name = free_name(docs, "score")
    weights = docs.sparkSession.sparkContext.broadcast(model)  # 7,000 numbers

    def scored(buf, offs):
        if len(offs) == 2 and len(buf) > LONG_BYTES:
            return weights.value.score_parts(passages(part, np.array([0, len(part)]), None)[0] for part in stretches(buf, LONG_BYTES))
        return weights.value.score(*passages(buf, offs, None))

    def run(batches):
        for b in batches:
            data, offs = text_buffer(b.column(b.schema.get_field_index(text_col)))
            out = [scored(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]) for i, j in pieces(offs, LONG_BYTES)]
            out = np.round(np.concatenate(out), 6) if out else np.empty(0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.float64())], names=[*b.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())])), name


def op4_quality(spark, sf_dir: str) -> DataFrame:
    """``op4``: score and decision of every document; learns outside the held-out fold."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, read(spark, sf_dir, "labels"))
    scored, name = score(docs, model)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), F.col(name).alias("score"),
                         (F.col(name) >= THRESHOLD).cast("int").alias("predicted"))
