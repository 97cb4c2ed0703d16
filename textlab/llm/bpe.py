"""Byte-level BPE encoding and decoding of whole texts, by the ranks of a public vocabulary.

A text is cut into pre-tokens by the vocabulary's pattern; a pre-token that is
itself a token is taken whole, any other is merged from its bytes: always the
pair with the lowest rank, the leftmost of equal ones.  The pairs wait in a
rank queue: a bucket for each rank holds the positions (of a linked list of
tokens) whose pair has it, and a hierarchical bitmap of 256-bit words says which
buckets hold any, so that find-first-set on one word of each of two levels
gives the next rank.  A merge changes the pairs of both neighbours, whose earlier entries
stay in their buckets and are skipped as stale when they come up.  A pre-token
of n bytes costs n pushes and pops, so one of many megabytes is no trouble.

Pre-tokens repeat, so each worker keeps what it merged in a table of bounded
size.  The vocabulary (some 50,000 tokens) is read by the driver and broadcast.
"""

from __future__ import annotations

import base64
from array import array
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, pieces, read

WORD = 8  # a word of the bitmap has 2**WORD bits
LOW = (1 << WORD) - 1
CACHE, CACHED_CHARS, LONG, STRETCH = 1 << 18, 64, 4096, 1 << 20


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from lines of ``base64 rank``."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, f))}


class Coder(dict):
    """Encoder and decoder; as a dict it maps a pre-token to its ids as bytes of 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.tokens: list[bytes] = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.single = [ranks.get(bytes([b]), -1) for b in range(256)]
        self.old: dict[str, bytes] = {}
        self.table = pa.array(self.tokens, pa.large_binary())

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece) or array("i", self.merge(piece.encode())).tobytes()
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHE:  # what was not used since the last time goes
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token.

        The queue's two bitmap levels are ``words`` (a bit for each rank) and ``top`` (a bit for each word that has any).
        """
        if piece in self.ranks:
            return [self.ranks[piece]]
        get, tokens, n = self.ranks.get, self.tokens, len(piece)
        buckets, words, top = {}, [0] * ((len(tokens) >> WORD) + 1), 0
        row = list if n < LONG else lambda x: array("q", x)
        ids, after, before = row(map(self.single.__getitem__, piece)), row(range(1, n + 1)), row(range(-1, n - 1))
        waits = row([-1]) * n  # the rank of the pair that begins at a position; another entry for it is stale
        for i in range(n - 1):
            rank = get(piece[i:i + 2])
            if rank is not None:
                waits[i] = rank
                if rank in buckets:
                    buckets[rank].append(i)  # positions come in order
                else:
                    buckets[rank] = [i]
                    words[rank >> WORD] |= 1 << (rank & LOW)
                    top |= 1 << (rank >> WORD)
        while top:
            at = (top & -top).bit_length() - 1  # find first set, at either level
            word = words[at]
            bit = word & -word
            rank = at << WORD | bit.bit_length() - 1
            bucket = buckets[rank]
            i = heappop(bucket)
            if not bucket:
                del buckets[rank]
                words[at] = word ^ bit
                if word == bit:
                    top ^= 1 << at
            if waits[i] != rank:
                continue
            gone, left = after[i], before[i]
            right = after[gone]
            ids[i], after[i], ids[gone], waits[gone], waits[i] = rank, right, -1, -1, -1
            token = tokens[rank]
            if right < n:
                before[right] = i
            for i, new in ((i, right < n and get(token + tokens[ids[right]])), (left, left >= 0 and get(tokens[ids[left]] + token))):
                if new is None or new is False:
                    if i >= 0:
                        waits[i] = -1
                    continue
                waits[i] = new
                if new in buckets:
                    heappush(buckets[new], i)
                else:
                    buckets[new] = [i]
                    words[new >> WORD] |= 1 << (new & LOW)
                    top |= 1 << (new >> WORD)
        return [x for x in ids if x >= 0]

    def encode(self, text: str) -> bytes:
        """Ids of a text; a long text takes no list of its pre-tokens."""
        if len(text) <= STRETCH:
            return b"".join(map(self.__getitem__, self.pattern.findall(text)))
        return b"".join(self[m[0]] for m in self.pattern.finditer(text))

    def decode(self, ids: pa.Array) -> pa.Array:
        """The token bytes of ids, which must be of the vocabulary."""
        return self.table.take(ids)


_coders: dict[int, Coder] = {}


def coder(vocabulary) -> Coder:
    """This worker's coder of a broadcast ``(ranks, pattern)``."""
    if vocabulary.value is not _coders.get("of"):
        _coders.update({"of": vocabulary.value, "coder": Coder(*vocabulary.value)})
    return _coders["coder"]


def broadcast_vocabulary(spark, path: str, pattern: str):
    """The ranks of a vocabulary file, read once by the driver, for :func:`encode` and :func:`decode`."""
    return spark.sparkContext.broadcast((load_ranks(path), pattern))


def encode(docs: DataFrame, vocabulary, text_col: str = "text", keep_text: bool = True) -> tuple[DataFrame, str]:
    """All rows and columns of ``docs`` plus the ids of every text, and the name that column got (``ids``).

    Null and empty texts have no ids (an empty list); a text is encoded whole,
    whatever its length; repeated rows are each encoded; an empty table stays
    empty; underscores are added to the name where ``docs`` has such a column.
    ``keep_text=False`` leaves the text out.
    """
    name = free_name(docs, "ids")
    kept = [c for c in docs.columns if keep_text or c != text_col]
    schema = docs.select(*kept).withColumn(name, F.array().cast("array<int>")).schema

    def run(batches):
        for b in batches:
            own = coder(vocabulary)
            texts = b.column(b.schema.get_field_index(text_col)).cast(pa.large_string())
            offs = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
            for a, z in pieces(offs, 4 * STRETCH):
                ids = [own.encode(t) if t else b"" for t in texts[a:z].to_pylist()]
                ends = np.cumsum([0, *map(len, ids)]) // 4
                flat = pa.array(np.frombuffer(b"".join(ids), np.int32))
                part = b.slice(a, z - a)
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in kept),
                                                  pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)], [*kept, name])

    return docs.mapInArrow(run, schema), name


def decode(coded: DataFrame, vocabulary, ids_col: str = "ids") -> tuple[DataFrame, str]:
    """All rows and columns of ``coded`` plus the bytes its ids stand for, and the name that column got (``decoded``).

    A null or empty list gives empty bytes; a null id, or one outside the vocabulary, is an error.
    """
    name = free_name(coded, "decoded")
    schema, names = coded.withColumn(name, F.lit(b"")).schema, [*coded.columns, name]

    def run(batches):
        for b in batches:
            own = coder(vocabulary)
            lists = b.column(b.schema.get_field_index(ids_col))
            lens = lists.value_lengths().fill_null(0).to_numpy()
            flat, ends = lists.flatten(), np.concatenate([[0], np.cumsum(lens, dtype=np.int64)])
            if flat.null_count:
                raise ValueError("null among the ids")
            for a, z in pieces(ends, STRETCH):
                data = own.decode(flat.slice(ends[a], ends[z] - ends[a]))
                starts = np.frombuffer(data.buffers()[1], np.int64, len(data) + 1) if len(data) else np.zeros(1, np.int64)
                offs = starts[ends[a:z + 1] - ends[a]]
                cells = pa.Array.from_buffers(pa.large_binary(), z - a, [None, pa.py_buffer(offs.astype(np.int64).tobytes()), data.buffers()[2]])
                part = b.slice(a, z - a)
                yield pa.RecordBatch.from_arrays([*part.columns, cells.cast(pa.binary())], names)

    return coded.mapInArrow(run, schema), name


def op12_bpe(spark, sf_dir: str) -> DataFrame:
    """``op12``: ids and decoded bytes of every document, as digests, see the module docstring."""
    import public_tokenizers

    words = broadcast_vocabulary(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    coded, ids = encode(read(spark, sf_dir, "documents").select("doc_id", "text"), words, keep_text=False)
    back, decoded = decode(coded, words, ids)
    return back.select("doc_id", F.size(ids).cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col(ids).cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(decoded, 256).alias("decoded_sha256"))
