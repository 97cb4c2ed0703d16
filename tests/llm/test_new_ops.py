"""Operators 11 to 13 against brute force, on the edge table and on small parts and tiles."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import brute
from edge_fixtures import edge_docs, empty_docs, tools  # noqa: F401
from textlab.llm import bpe, lexical, merkle


@pytest.fixture(scope="module")
def pairs(edge_docs, tools):
    return tools.rows(edge_docs, "doc_id", "text")


# ---- ranked lexical search

def ranked(docs, items, k=20):
    words = lambda t: re.findall(lexical.TERM, brute.lower(t or ""))
    texts = [(d, Counter(w), len(w)) for d, t in docs if (w := words(t))]
    n_docs, length = len(texts), sum(n for *_, n in texts)
    df = Counter(t for _, c, _ in texts for t in c)
    asked: dict = {}
    for item, text in items:
        asked.setdefault(item, Counter()).update(words(text))
    out = []
    for item, terms in asked.items():
        found = []
        for d, c, n in texts:
            m = 100 - 25 + 25 * n * n_docs // length
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                        for t, times in terms.items() if t in c)
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(found, key=lambda x: x[:3])[:k], 1)]
    return out


ITEMS = [(1, "shared1 Shared2 shared2 tail"), (2, "ONE two"), (3, None), (4, "!!"), (None, "key password é"), (None, "repeated line"),
         (5, " ".join(f"shared{i}" for i in range(40))), (6, "absent terms only"), (7, "one two"), (8, "shar ed1 hared10 own")]


@pytest.mark.parametrize("part_terms", [lexical.PART_TERMS, 7, 1])
def test_search_equals_brute_force(spark, edge_docs, pairs, tools, part_terms):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumns({c: F.lit(1) for c in ("item", "id", "score", "rank")})
    for k in (20, 3):
        got = lexical.search(edge_docs, items, k, part_terms=part_terms)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        tools.equal(tools.rows(got, *got.columns), ranked(pairs, ITEMS, k))


def test_search_of_empty_tables(spark, edge_docs, empty_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical.search(empty_docs, items).count() == 0
    assert lexical.search(edge_docs, items.limit(0)).count() == 0
    assert lexical.search(edge_docs, items.limit(0)).columns == lexical.search(edge_docs, items).columns


def test_stretches_change_no_counts():
    part = lexical.Part([("a", t, 1) for t in ("one", "é", "two", "on", "x" * 50)])
    text = ("One two-é onë on,x " + "x" * 50 + "  ").encode() * 40
    for stretch in (1, 7, 64, 1 << 20):
        assert lexical.scan(part.automaton(), text, stretch) == lexical.scan(part.automaton(), text)
    n, found = lexical.scan(part.automaton(), text)
    assert n == 280 and found == {0: 40, 1: 40, 2: 40, 3: 40, 4: 40}


def test_ties_at_the_last_place_are_broken_by_id():
    best = lexical.Best(2, 3)
    rng, rows = np.random.default_rng(1), []
    for _ in range(50):
        ids, scores = rng.integers(0, 10_000, 20), rng.integers(0, 3, (20, 2))
        best.add(scores, ids, np.zeros(20, bool))
        best.rank()
        rows += [(i, -int(s[i]), int(d)) for d, s in zip(ids, scores) for i in (0, 1) if s[i] > 0]
    item, score, _, ids = best.rank()
    assert list(zip(item.tolist(), (-score).tolist(), ids.tolist())) == [r for i in (0, 1) for r in sorted(x for x in rows if x[0] == i)[:3]]


# ---- byte-level BPE

@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_equal_the_reference_encoder(ranks, reference, pairs):
    own, rng = bpe.Coder(ranks, public_tokenizers.PATTERN), random.Random(3)
    texts = [t or "" for _, t in pairs] + ["a" * 30_000, "".join(rng.choice("abcdet") for _ in range(30_000)), "\n" * 3000 + " " * 2000 + "x", "<|endoftext|>"]
    for _ in range(800):
        texts.append("".join(chr(rng.choice([rng.randrange(128), rng.randrange(0x3000), 0x1F600, 0x85, 0x1C, 0x2028, 0x200B])) for _ in range(rng.randrange(50))))
    for t in texts:
        assert np.frombuffer(own.encode(t), np.int32).tolist() == reference.encode_ordinary(t), t[:80]


def test_other_ranks_merge_the_leftmost_of_equal_pairs():
    """Random vocabularies, in which a longer token may have the lower rank, against a plain scan for the least pair."""
    rng = random.Random(8)
    for _ in range(60):
        ranks = {bytes([b]): b for b in range(256)}
        while len(ranks) < 300:
            ranks.setdefault("".join(rng.choice("abc") for _ in range(rng.randint(2, 6))).encode(), rng.choice([len(ranks), 256 + len(ranks)]))
        ranks = {t: i for i, (t, _) in enumerate(sorted(ranks.items(), key=lambda x: x[1]))}
        own = bpe.Coder(ranks, r".+")
        for _ in range(20):
            piece = "".join(rng.choice("abc") for _ in range(rng.randint(1, 40))).encode()
            parts = [piece] if piece in ranks else [bytes([b]) for b in piece]
            while True:
                pair = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks), default=None)
                if pair is None:
                    break
                parts[pair[1]:pair[1] + 2] = [parts[pair[1]] + parts[pair[1] + 1]]
            assert own.merge(piece) == [ranks[p] for p in parts]


def test_a_pre_token_costs_time_in_proportion(ranks):
    import time

    own, rng, took = bpe.Coder(ranks, public_tokenizers.PATTERN), random.Random(4), []
    for n in (100_000, 800_000):
        piece = "".join(rng.choice("etaoinshr") for _ in range(n)).encode()
        began = time.perf_counter()
        own.merge(piece)
        took.append(time.perf_counter() - began)
    assert took[1] < 24 * took[0]  # eight times the bytes


def test_the_table_of_pre_tokens_is_bounded(ranks, reference, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 50)
    own = bpe.Coder(ranks, public_tokenizers.PATTERN)
    text = " ".join(f"word{i % 400}x" for i in range(2000))
    assert np.frombuffer(own.encode(text), np.int32).tolist() == reference.encode_ordinary(text)
    assert len(own) <= 50 and len(own.old) <= 50


def test_coded_table_and_round_trip(spark, edge_docs, empty_docs, ranks, reference):
    words = bpe.broadcast_vocabulary(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    docs = edge_docs.withColumn("ids", F.lit("taken"))
    out, ids = bpe.encode(docs, words)
    back, decoded = bpe.decode(out, words, ids)
    assert ids == "ids_" and back.columns == [*docs.columns, ids, decoded]
    rows = back.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert list(r[ids]) == reference.encode_ordinary(r["text"] or "") and bytes(r[decoded]) == (r["text"] or "").encode()
    assert bpe.decode(bpe.encode(empty_docs, words)[0], words)[0].count() == 0
    no_text, _ = bpe.encode(edge_docs, words, keep_text=False)
    assert "text" not in no_text.columns
    lists = spark.createDataFrame([(1, None), (2, []), (3, [64, 65])], "i int, ids array<int>")
    assert [(r["i"], bytes(r["decoded"])) for r in bpe.decode(lists, words)[0].orderBy("i").collect()] == [
        (1, b""), (2, b""), (3, reference.decode_bytes([64, 65]))]
    with pytest.raises(Exception, match="null among the ids"):
        bpe.decode(spark.createDataFrame([(1, [64, None])], "i int, ids array<int>"), words)[0].collect()


def test_texts_beyond_a_stretch_are_whole(ranks, reference, monkeypatch):
    monkeypatch.setattr(bpe, "STRETCH", 100)
    own, text = bpe.Coder(ranks, public_tokenizers.PATTERN), "some words, 12 numbers\n\n  and blanks " * 30
    assert np.frombuffer(own.encode(text), np.int32).tolist() == reference.encode_ordinary(text)


# ---- Merkle manifest

def tree(rows, fan=16):
    """{row number: (leaf, subroot, root, proof, folded)}; rows are (doc_id, source, lang, n_chars, text)."""
    def h(*fields):
        return brute.sha("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))

    def grow(nodes):
        """Root, and for each node the siblings level by level as (left, right)."""
        ways = [[] for _ in nodes]
        under = [[i] for i in range(len(nodes))]
        while len(nodes) > 1:
            up, covers = [], []
            for a in range(0, len(nodes), fan):
                run = nodes[a:a + fan]
                for j in range(len(run)):
                    for i in under[a + j]:
                        ways[i].append(("".join(run[:j]), "".join(run[j + 1:])))
                up.append(brute.sha("".join(run)))
                covers.append([i for u in under[a:a + fan] for i in u])
            nodes, under = up, covers
        return nodes[0], ways

    leaves = [h(*r) for r in rows]
    order, subroots, lower = {}, {}, {}
    for s in {r[1] for r in rows}:
        order[s] = sorted((i for i, r in enumerate(rows) if r[1] == s), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, leaves[i]))
        subroots[s], ways = grow([leaves[i] for i in order[s]])
        lower |= dict(zip(order[s], ways))
    sources = sorted(order, key=lambda s: (s is not None, (s or "").encode()))
    root, upper = grow([subroots[s] for s in sources])
    out = []
    for i, r in enumerate(rows):
        way = lower[i] + upper[sources.index(r[1])]
        digest = leaves[i]
        if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
            digest = h(*r[:4], None if r[4] is None else brute.lower(r[4]))
        for left, right in way:
            digest = brute.sha(left + digest + right)
        out.append((r[0], leaves[i], subroots[r[1]], root, brute.sha("".join(a + b for a, b in way)), digest, digest == root))
    return out


def manifest_of(docs):
    lowered = merkle.leaf([F.translate("text", merkle.UPPER, merkle.LOWER) if c == "text" else F.col(c) for c in merkle.FIELDS])
    return merkle.manifest(docs, F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, lowered))


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_manifest_equals_brute_force(spark, edge_docs, tools):
    docs = edge_docs.withColumns({"lang": F.when(F.col("doc_id") % 3 > 0, "É"), "n_chars": F.length("text")})
    docs = docs.withColumns({c: F.lit(c) for c in ("g", "pos", "whole", "alone", "other", "tile", "rows")})
    rows = [tuple(r) for r in docs.select(*merkle.FIELDS).collect()]
    out = manifest_of(docs)
    assert out.columns == COLUMNS
    tools.equal(tools.rows(out, *COLUMNS), tree(rows))
    assert not out.where("not verified").isEmpty()


@pytest.mark.parametrize("n, sources", [(1, 1), (17, 1), (256, 1), (257, 1), (300, 300), (4097, 1)])
def test_sizes_at_the_borders_of_runs_and_tiles(spark, tools, n, sources):
    rows = [(i, f"s{i % sources}" if i % sources else None, "x", i, f"Text {i}") for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(3)
    out = manifest_of(docs)
    tools.equal(tools.rows(out, *COLUMNS), tree(rows))


def test_a_proof_folds_to_the_root(spark):
    rows = [(i // 2, "hot" if i % 3 else f"s{i}", None, None, "same") for i in range(500)]  # repeated ids, equal rows
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    for r in merkle.manifest(docs, with_proof=True).collect():
        digest = r["leaf"]
        for step in r["proof"]:
            digest = brute.sha(step["left"] + digest + step["right"])
        assert digest == r["root"] == r["folded_root"] and r["verified"]


def test_a_state_is_resumed_right_of_its_slot():
    children = [brute.sha(str(i)).encode() for i in range(16)]
    slots = merkle.Slots(children)
    for i in range(16):
        other = [*children[:i], brute.sha("other").encode(), *children[i + 1:]]
        assert slots.fold(i, other[i]).decode() == brute.sha(b"".join(other).decode())
        assert slots.beside(i) == (b"".join(children[:i]), b"".join(children[i + 1:]))


def test_manifest_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, source string, lang string, n_chars long, text string")
    assert manifest_of(docs).collect() == [] and manifest_of(docs).columns == COLUMNS
