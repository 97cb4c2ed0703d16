"""Each operator against brute force on a table of nulls, empty and long texts, ties, repeats and clashing names."""

import base64
import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from edge_fixtures import edge_docs, empty_docs, tools  # noqa: F401
from textlab.llm import chat, decontam, license_scan, linededup, mixing, quality, secrets, simhash, topk, warc
from textlab.llm.common import split_words, word_hashes


@pytest.fixture(scope="module")
def pairs(edge_docs, tools):
    return tools.rows(edge_docs, "doc_id", "text")


def test_decontamination_equals_brute_force(spark, edge_docs, pairs, tools):
    items = [(1, " ".join(f"shared{i}" for i in range(5, 40))), (2, "one TWO"), (3, None), (4, "!!"), (None, "tail"),
             (5, " ".join(f"Shared{i}" for i in range(30, 45))), (10, "never in there at all " * 4), (6, "one two")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("spans", F.lit(1))
    for part_words in (decontam.PART_WORDS, 20):  # several parts give the same
        out, c = decontam.decontaminate(edge_docs, bench, part_words=part_words)
        assert out.columns[:len(edge_docs.columns)] == edge_docs.columns
        got = out.select("doc_id", c["n_words"], decontam.hit_words(c["spans"]), F.size(c["items"]),
                         F.sha2(F.array_join(F.array_sort(c["items"]), ","), 256), decontam.hit_words(c["spans"]) > 0)
        tools.equal([tuple(r) for r in got.collect()], brute.decontaminate(pairs, items))


def test_decontamination_of_empty_tables(spark, edge_docs, empty_docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    out, c = decontam.decontaminate(edge_docs, bench)
    assert out.where(F.size(c["spans"]) > 0).count() == 0 and out.count() == edge_docs.count()
    assert decontam.decontaminate(empty_docs, bench)[0].count() == 0


def test_benchmark_parts_are_bounded(spark, tools):
    rng = np.random.default_rng(6)
    items = [(1, "one and the same row of twelve words that comes again and again")] * 500
    items += [(2, " ".join(f"é{x}" for x in rng.integers(0, 400, 1000)))] + [(i, " ".join(f"w{x}" for x in rng.integers(0, 50, 30))) for i in range(3, 40)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for most in (60, 400):
        sizes = [sum(len(r["text"].split()) for r in p.collect()) for p in decontam.benchmark_parts(bench, "item_id", "text", most)]
        assert max(sizes) <= most and min(sizes) > 0 and sum(sizes) < 4000
    long = items[500][1].split()
    docs = [(i, " ".join(["x", *long[i:i + 10], "y"])) for i in range(0, 991)] + [(1000, items[0][1]), (1001, " ".join(long[:9])), (1002, items[501][1])]
    out, c = decontam.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), bench, part_words=400)
    got = out.select("doc_id", c["n_words"], decontam.hit_words(c["spans"]), F.size(c["items"]),
                     F.sha2(F.array_join(F.array_sort(c["items"]), ","), 256), decontam.hit_words(c["spans"]) > 0)
    tools.equal([tuple(r) for r in got.collect()], brute.decontaminate(docs, items))


def test_windows_of_equal_hashes_are_told_apart(monkeypatch):
    rng, few = np.random.default_rng(5), np.uint64(7)  # seven hashes for all windows
    hashes, at = decontam.gram_hashes, decontam.grams_at
    monkeypatch.setattr(decontam, "gram_hashes", lambda h, k: hashes(h, k) % few)
    monkeypatch.setattr(decontam, "grams_at", lambda h, s, k: at(h, s, k) % few)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 3, n)) for n in rng.integers(0, 40, 40)]
    items = [(str(i), t) for i, t in enumerate(texts[:12] + texts[:2] + ["w1", "w2 w2"])]
    part = decontam.Part([(i, t.encode()) for i, t in items])
    data = "".join(texts).encode()
    n_words, found = part.scan(np.frombuffer(data, np.uint8), np.cumsum([0, *[len(t) for t in texts]]))
    want = brute.decontaminate(list(enumerate(texts)), items)
    assert n_words.tolist() == [w[1] for w in want]
    for d, _, n_hit, n_items, digest, _ in want:
        spans, ids = found.get(d, ([], set()))
        assert sum(e - s for s, e in decontam.merged(spans)) == n_hit and len(ids) == n_items
        assert brute.sha(",".join(sorted(ids))) == digest


def test_stretches_of_long_texts_change_nothing():
    text = " ".join(f"word{i * i % 977}" for i in range(5000)).encode()
    buf = np.frombuffer(text, np.uint8)
    start, end, _ = split_words(buf, np.array([0, len(buf)]), quality.NOT_BLANK)
    assert np.array_equal(word_hashes(buf, start, end), word_hashes(buf, start, end, most_bytes=64))
    assert simhash.fingerprint(text) == simhash.fingerprint(text, stretch=7)
    assert simhash.fingerprint(b" \t\x0b\r\n") == 0 and simhash.fingerprint(b"\x0cA  b\n") == simhash.fingerprint(b"a b")


def test_winnowing_keeps_a_gram_of_every_shared_window():
    rng = np.random.default_rng(3)
    for n in (10, 11, 25, 60):
        shared = rng.integers(0, 4, n).astype(np.uint64)  # few words, so many ties
        texts = [np.concatenate([rng.integers(0, 4, 17).astype(np.uint64), shared, rng.integers(0, 4, 9).astype(np.uint64)]) for _ in range(2)]
        kept = [decontam.winnow(g := decontam.gram_hashes(t, 5), np.zeros(len(t), int), 5, 6) for t in texts]
        for s in range(17, 17 + n - 9):  # every window of 10 shared words holds one and the same kept gram
            assert {*kept[0][(kept[0] >= s) & (kept[0] <= s + 5)]} & {*kept[1][(kept[1] >= s) & (kept[1] <= s + 5)]}


@pytest.mark.parametrize("batches,fanout", [(1, 2), (4, 2), (7, 3)])
def test_line_dedup_equals_brute_force(edge_docs, pairs, tools, batches, fanout):
    out, c = linededup.dedup_lines(edge_docs, batches=batches, fanout=fanout)
    got = out.select("doc_id", c["n_lines"], c["n_dropped"], F.sha2("text", 256))
    tools.equal([tuple(r) for r in got.collect()], brute.line_dedup(pairs))
    assert out.drop(*c.values()).columns == edge_docs.columns


def test_line_dedup_of_an_empty_table(empty_docs):
    assert linededup.dedup_lines(empty_docs)[0].count() == 0


def test_line_runs_are_compacted_by_level(spark):
    runs = linededup.LineRuns(spark, 4, fanout=2)
    for i in range(5):
        new = runs.add(spark.range(i * 10, i * 10 + 15).selectExpr("id h1", "id h2", "id"))
        assert new.count() == (15 if i == 0 else 10)  # five of each batch are known
        runs.compact()
    assert [len(x) for x in runs.levels] == [1, 0, 1]
    assert sum(t.count() for t in runs.tables()) == 55
    runs.forget()


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 2])
def test_simhash_equals_brute_force(edge_docs, pairs, tools, bucket):
    out = simhash.simhash_components(edge_docs.drop("id"), bucket=bucket)
    got = out.select("id", F.lpad(F.lower(F.hex("fp")), 16, "0"), "component_id")
    tools.equal([tuple(r) for r in got.collect()], brute.simhash_components(pairs))


def test_simhash_links_planted_fingerprints(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    flipped = [int(b) ^ int(sum(1 << int(x) for x in rng.choice(64, k, replace=False))) for b, k in zip(base, rng.integers(0, 6, 300))]
    fps = sorted({*map(int, base), *flipped})
    fps = np.array(fps, np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3
    want = list(range(len(fps)))
    for _ in range(10):
        want = [min(want[j] for j in np.flatnonzero(near[i])) for i in range(len(fps))]
    signed = fps.view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    for bucket in (4096, 1):
        roots = {r["node"]: r["root"] for r in simhash.components(simhash.links(df, bucket=bucket)).collect()}
        groups: dict = {}
        for x, w in zip(signed, want):
            groups.setdefault(w, set()).add(roots.get(x, x))
        assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_simhash_of_an_empty_table(empty_docs):
    assert simhash.simhash_components(empty_docs.drop("id")).count() == 0


def test_warc_equals_brute_force(spark, tools, tmp_path):
    pages = [(1, "http://a", "<p>same</p>"), (2, "http://b", "<p>same</p>"), (2, "http://c", "<p>same</p>"), (None, "http://d", "<p>same</p>"),
             (3, None, None), (4, "http://e\r\nX: 1", ""), (5, "http://f", "WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n😀"), (6, "http://g", "x" * 300_000),
             (None, None, "lonely"), (2, "http://c", "<p>same</p>"), (7, "u", "\r\n\r\n"), (None, None, "twice"), (None, None, "twice")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit("x")).withColumn("n", F.lit(1))
    warc.write_warc(df, f"{tmp_path}/w")
    index = warc.read_warc(spark, f"{tmp_path}/w", payloads=True).cache()
    got = warc.resolved(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    tools.equal([tuple(r) for r in got.collect()], brute.warc(pages))
    want = {hashlib.sha1((h or "").encode()).digest(): (h or "").encode() for _, _, h in pages}
    full = index.where("record_type = 'response'").collect()
    assert {bytes(r["payload"]) for r in full} == set(want.values()) and len(full) == len(want)
    assert all(base64.b32encode(hashlib.sha1(r["payload"]).digest()).decode() == r["digest"] for r in full)
    assert index.select("record_id").distinct().count() == len(pages)


def test_warc_min_bytes_and_empty(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "v", "ab"), (3, "w", "abcd"), (4, "x", "abcd")], "page_id long, url string, html string")
    warc.write_warc(df, f"{tmp_path}/a", min_bytes=3)
    got = {r["page_id"]: r["refers_to"] for r in warc.resolved(warc.read_warc(spark, f"{tmp_path}/a")).collect()}
    assert got == {1: None, 2: None, 3: 4, 4: None}
    warc.write_warc(df.limit(0), f"{tmp_path}/b")
    assert warc.read_warc(spark, f"{tmp_path}/b").count() == 0


def test_topk_equals_brute_force(spark, tools):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=5).round(2).tolist()) for i in range(400)]
    rows += [(i, rows[7][1]) for i in range(400, 520)]  # equal vectors
    rows += [(None, [1.0] * 5), (700, None), (800, [1.0, None, 1.0, 1.0, 1.0]), (801, [float("inf")] * 5), (900, [float("nan")] * 5),
             (1000, [1.0, 2.0]), (1001, [2.0, 1.0]), (1100, [1e9] * 5), (1101, [-1e9, 1e9, 3.0, 0.0, 1.0]), (1200, []), (5, rows[5][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit(1)).withColumn("vec", F.lit(2)).repartition(5)
    for block in (topk.BLOCK, 2):
        got = topk.top_k(df.select("vec_id", "embedding"), F.col("id") % 100 == 0, block=block)
        tools.equal([tuple(r) for r in got.collect()], brute.topk(rows))
    assert topk.top_k(df.limit(0), F.col("id") % 100 == 0).count() == 0


def test_secret_spans_equal_brute_force(edge_docs, pairs):
    got = {}
    for r in secrets.scan_secrets(edge_docs.drop("id")).collect():
        got.setdefault(r["id"], []).append(sorted((s["start"], s["rank"], s["end"], s["kind"]) for s in r["base"]))
    for doc, text in pairs:
        assert brute.base_secrets(text) in got[doc], doc
    assert sum(map(len, got[12])) and [s[3] for s in got[12][0]] == ["assign", "access", "hex"]


def test_entropy_windows_equal_a_recount(spark):
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdef0123456789"), n)) for n in (20, 25, 60)]
    words += ["".join(rng.choice(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"), n)) for n in (20, 40, 90, 3000)]
    words += ["a1" * 15 + words[3] + "b2" * 12 + words[4], "0" * 30]
    df = spark.createDataFrame([(w, b) for w in words for b in (3.0, 3.5, 3.9)], "w string, bits double")
    for bits in (3.0, 3.5, 3.9):
        rows = df.where(F.col("bits") == bits).select("w", secrets.hot_runs(F.col("w"), F.lit(secrets.entropy_limit(bits))).alias("runs")).collect()
        for r in rows:
            assert [(x["start"], x["end"]) for x in r["runs"]] == brute.entropy_runs(r["w"], bits)


def test_entropy_spans_and_allow_list(spark):
    text = ("key Zk3vR9xQ7mB2tY8wL5nC1pF6 é 123e4567-e89b-12d3-a456-426614174000 losasmentementementemente "
            "EXAMPLEk3vR9xQ7mB2tY8wL5 9233A8ECF7C5B09FE5949719B6B82BC439E9329B some-slug-of-words-in-a-row token = 9af8e7d6c5b4a3928170ffee")
    found = secrets.scan_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [text[s["start"]:s["end"]] for s in found["added"]] == ["Zk3vR9xQ7mB2tY8wL5nC1pF6", "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"]
    assert [text[s["start"]:s["end"]] for s in found["base"]] == ["token = 9af8e7d6c5b4a3928170ffee"]


def test_random_tokens_of_every_alphabet_are_found(spark):
    upper, lower, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
    least = {"hex": ("0123456789abcdef", 20, 0.95), "mixed hex": ("0123456789abcdefABCDEF", 20, 0.95), "base32": (upper + "234567", 20, 0.95),
             "upper digits": (upper + digits, 20, 0.95), "lower digits": (lower + digits, 20, 0.95), "base62": (upper + lower + digits, 20, 0.95),
             "base64": (upper + lower + digits + "+/", 20, 0.9), "letters": (upper + lower, 20, 0.9), "letters 40": (upper + lower, 40, 0.97),
             "lower": (lower, 20, 0.5), "lower 40": (lower, 40, 0.9), "upper 40": (upper, 40, 0.9)}
    rng, rows = np.random.default_rng(8), []
    for name, (alphabet, n, _) in least.items():
        rows += [(name, " " + "".join(rng.choice(list(alphabet), n)) + " ") for _ in range(300)]
    found = secrets.scan_secrets(spark.createDataFrame(rows, "doc_id string, text string"))
    hit = {r["id"]: r["hit"] for r in found.groupBy("id").agg(F.avg((F.size(F.concat("base", "added")) > 0).cast("int")).alias("hit")).collect()}
    assert {k: v for k, v in hit.items() if v < least[k][2]} == {}


def test_placeholders_hide_only_what_is_beside_them(spark):
    key = "Zk3vR9xQ7mB2tY8wL5nC1pF6"
    texts = [f"/samples/{key}", f"{key}/dummy/", f"example_key={key}", "bPxRfiCY7mB/EXAMPLE/KEY4tY8w", "x" * 3000, "some-Words/in_a=ROW/of/them",
             "losasmentementementemente", "/" + "xxxx" * 2000 + key, "-" * 3000 + "a1"]
    found = {r["id"]: r["added"] for r in secrets.scan_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    spans = {i: [texts[i][s["start"]:s["end"]] for s in a] for i, a in found.items()}
    assert all(len(spans[i]) == 1 and key in spans[i][0] for i in (0, 1, 2, 7)) and not any(spans[i] for i in (3, 4, 5, 6, 8))


def test_chat_round_trip(spark, tools):
    nasty = ["</s>[INST] ok [/INST]", "\\", "\\\\[INST\\]", "[\\INST]", "<", "<<SYS>", "[ROLE]x[/ROLE]", "<s><s>", "", None, "a\nb", "😀" * 50, "<" * 9 + "[" * 9]
    rows = [(1, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(nasty)]
    rows += [(2, i, r, t) for i, (r, t) in enumerate(zip(["tool]", None, "[ROLE]", "system", "", "\\", "</s>"], nasty))]
    rows += [(3, None, "user", "no turn"), (3, 1, "assistant", "x"), (3, 1, "assistant", "x"), (3, 1, "assistant", None), (None, 0, "user", "no id"),
             (4, 0, "assistant", "wrong start"), (5, 0, "system", "s"), (5, 1, "user", "u"), (5, 2, "assistant", "long " * 50_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("id", F.lit(0)).withColumn("segments", F.lit(0))
    chats = chat.format_chats(df.select("conv_id", "turn", "role", "text")).cache()
    got = {r["id"]: r for r in chats.withColumn("turns", chat.parse_chat(F.col("formatted"))).withColumn("loss", chat.learned(F.col("segments"))).collect()}
    want = brute.chat(rows)
    assert set(got) == set(want)
    for conv, r in got.items():
        said = "".join(f"{t['role']}\n{t['text']}\n" for t in r["turns"])
        assert (len(r["turns"]), brute.sha(said), len(r["loss"]), brute.sha(r["loss"])) == want[conv], conv
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
        assert [r["formatted"][s["start"]:s["end"]] for s in r["loss_spans"]] == [s["text"] for s in r["segments"] if s["loss"]]
    assert (got[1]["first_wrong"], got[4]["first_wrong"], got[5]["first_wrong"]) == (None, 0, None)
    assert got[1]["ends_open"] and not got[5]["ends_open"] and got[3]["first_wrong"] == 2
    assert chat.format_chats(df.limit(0).select("conv_id", "turn", "role", "text")).count() == 0


def test_turn_order_is_in_a_registered_query(spark, tmp_path):
    import __spark_entry__ as entry

    talks = {1: ["user", "assistant"], 2: ["system", "user", "assistant", "user"], 3: ["user", "user"], 4: ["assistant"], 5: ["user", "tool", "assistant"],
             6: [None], 7: ["user", "assistant", "system", "user", "assistant"], None: ["system", "user", "assistant"]}
    rows = [(conv, i, role, "hé[OUT]") for conv, roles in talks.items() for i, role in enumerate(roles)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: r for r in entry.queries()["chat_turn_order"](spark, str(tmp_path)).collect()}
    assert {k: (r["first_wrong"], r["ends_open"]) for k, r in got.items()} == {
        1: (None, False), 2: (None, True), 3: (1, True), 4: (0, True), 5: (1, True), 6: (0, True), 7: (2, True), None: (None, False), -7: (None, False)}
    assert {k: len(r["loss_spans"].split(",")) for k, r in got.items() if r["loss_spans"]} == {1: 1, 2: 1, 4: 1, 5: 1, 7: 2, None: 1, -7: 1}
    assert got[4]["loss_spans"] == "8:16"  # after <s>[OUT]: the text, its mark broken by a backslash


def test_mix_reaches_targets_and_is_the_same_again(edge_docs, empty_docs):
    mix = mixing.mix_sources(edge_docs)
    n = mix.names
    cols = ("doc_id", "source", n["size"], n["source_size"], n["target"], n["draws"])
    rows = mix.rows.select(*cols).collect()
    assert mix.rows.columns[:len(edge_docs.columns)] == edge_docs.columns and len(rows) == edge_docs.count()
    sizes: dict = {}
    for r in rows:
        s = sizes.setdefault(r[1], [0, 0, r[4], r[3], []])
        s[0] += r[2]
        s[1] += r[2] * len(r[5])
        s[4].append(r[2])
        assert len(r[5]) <= 3 and len({d["epoch"] for d in r[5]}) == len(r[5])
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    assert [sizes[s][2] for s in order] == pytest.approx(mixing.targets([sizes[s][0] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))]))
    for size, taken, target, said, own in sizes.values():
        assert said == size and target <= 3 * size + 1e-6 and abs(taken - target) <= max(own)
    again = mixing.mix_sources(edge_docs.repartition(5)).rows.select(*cols).collect()
    key = lambda r: (r[0] is None, r[0], str(r))
    assert sorted(map(tuple, again), key=key) == sorted(map(tuple, rows), key=key)
    out = mixing.write_order(mix, slice_words=2000)
    assert out.count() == sum(len(r[5]) for r in rows)
    assert mixing.write_order(mixing.mix_sources(empty_docs)).count() == 0


def test_border_block_is_filled_whatever_its_documents(spark, monkeypatch):
    def texts(seed, sizes):
        return [(seed * 10_000 + i, "w " * n, f"s{seed}") for i, n in enumerate(sizes)]

    for long in (15_000, 3_000):  # of one block a source, three quarters; the long document stands anywhere in hash order
        rows = [r for seed in range(6) for r in texts(seed, [10] * 1000 + [long])]
        rows += texts(9, [100] * ((10_000 + long) // 100))  # takes the rest
        docs = spark.createDataFrame(rows + rows[:1], "doc_id long, text string, source string")
        weights = [0.75] * 6 + [2.5]
        for keys in (mixing.BROADCAST_KEYS, 0):
            monkeypatch.setattr(mixing, "BROADCAST_KEYS", keys)
            mix = mixing.mix_sources(docs, tuple(weights), blocks=1)
            n = mix.names
            got = mix.rows.groupBy("source").agg(F.first(n["target"]).alias("target"), F.sum(F.col(n["size"]) * F.size(n["draws"])).alias("taken")).collect()
            assert len(got) == 7 and all(abs(r["taken"] - r["target"]) <= 20 for r in got if r["source"] != "s9")


def test_targets_by_hand():
    assert mixing.targets([100, 100], [1, 1]) == [100, 100]
    assert mixing.targets([10, 290, 300], [5, 2, 1]) == pytest.approx([30, 380, 190])  # the first stops at 3 x 10
    assert mixing.targets([0, 5], [5, 2]) == [0, 5] and mixing.targets([0], [5]) == [0] and mixing.targets([], []) == []


def test_split_tree_is_exact_and_hypergeometric():
    quotas = np.array([40, 0, 25, 15])
    cells = np.array([mixing.split_tree(quotas, 8, np.random.default_rng(s)) for s in range(400)])
    assert (cells.sum(axis=1) == quotas).all() and (cells.sum(axis=2) == 10).all()
    assert np.allclose(cells.mean(axis=(0, 1)), quotas / 8, atol=0.05)
    want = 10 * .5 * .5 * (80 - 10) / 79  # variance of the hypergeometric draw of the first source
    assert cells[:, :, 0].var() == pytest.approx(want, rel=0.1)


def test_quality_learns_and_scores_whole_texts(spark, tools):
    rng = np.random.default_rng(0)
    word = lambda: "".join(rng.choice(list("abcdefgh"), rng.integers(2, 8)))
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        words = [word() for _ in range(rng.integers(30, 400))]
        if bad:  # junk in one stretch alone, often far behind
            a = rng.integers(0, len(words) - 20)
            words[a:a + 20] = [w + "%%%" for w in words[a:a + 20]]
        rows.append((i, " ".join(words)))
        labels.append((i, int(not bad)))
    rows += [(None, "null id"), (500, None), (501, ""), (501, ""), (502, "x" * 200_000), (503, "w " * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("own"))
    known = spark.createDataFrame([*labels, (None, 1), (7, None), (9, 1)], "doc_id long, quality int")
    out, name = quality.score(docs, quality.train(docs, known))
    assert name == "score_" and out.columns == ["doc_id", "text", "score", "score_"]
    got = [(r["doc_id"], r["held"], r["score_"]) for r in out.withColumn("held", quality.held_out("doc_id")).collect()]
    assert len(got) == len(rows) and all(0 <= s <= 1 for *_, s in got)
    truth = dict(labels)
    held = [(truth[d], s) for d, h, s in got if h and d in truth]
    assert sum((s >= 0.3) == bool(y) for y, s in held) / len(held) > 0.9
    # labels of the held-out fold change nothing
    import zlib
    flipped = spark.createDataFrame([(d, 1 - q if zlib.crc32(str(d).encode()) % 5 == 0 else q) for d, q in labels], "doc_id long, quality int")
    again, _ = quality.score(docs, quality.train(docs, flipped))
    base, _ = quality.score(docs, quality.train(docs, known.where("doc_id IS NOT NULL AND quality IS NOT NULL").limit(len(labels))))
    tools.equal(tools.rows(again, "doc_id", "score_"), tools.rows(base, "doc_id", "score_"))
    none, _ = quality.score(docs, quality.train(docs, known.limit(0)))
    assert {r["score_"] for r in none.collect()} == {0.5}
    assert quality.score(docs.limit(0), quality.train(docs, known.limit(0)))[0].count() == 0


def test_passages_cover_the_text():
    text = ("lead  " + " ".join(f"w{i}" for i in range(20_000))).encode()
    buf = np.frombuffer(b"ab" + text + b"" + b"  " + b"tail", np.uint8)
    offs = np.array([0, 2, 2 + len(text), 2 + len(text), 4 + len(text), 8 + len(text)])
    x, first = quality.passages(buf, offs)
    assert np.diff(first).tolist() == [1, 128, 1, 1, 1] and np.isfinite(x).all()
    assert np.allclose((x[:1, :256] ** 2).sum(), 1) and x[first[2]].sum() == 0


def test_long_texts_are_scored_by_passages_of_64_words(spark):
    rng, model = np.random.default_rng(3), quality.Model()
    model.prior = None
    model.p["w"] *= 40  # sharp attention, so that a short stretch counts
    words = [f"w{x}" for x in rng.integers(0, 500, 300_000)]
    words[64 * 900:64 * 903] = ["!!??##"] * 192
    texts = [" ".join(words), "  " + " ".join(words[50_000:70_000]), "x" * 3_000_000 + " a" * 600_000, "y" * 2_100_000, " " * 1_500_000, "few words"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    scored, name = quality.score(df, model)
    got = {r["doc_id"]: r[name] for r in scored.select("doc_id", name).collect()}
    for i, text in enumerate(texts):
        own = text.split()
        x = []  # each passage as a text of its own, with the blanks before the first and after its last word
        ends = [m.start() for m in re.finditer(r"[^ ]+", text)][64::64]
        for a, z in zip([0, *ends], [*ends, len(text)]):
            part = np.frombuffer(text[a:z].encode(), np.uint8)
            x.append(quality.passages(part, np.array([0, len(part)]))[0])
        assert len(x) == max(1, -(-len(own) // 64))
        x = np.concatenate(x)
        assert got[i] == pytest.approx(float(model.score(x, np.array([0, len(x)]))[0]), abs=2e-5), i


def test_license_blocks(spark):
    mit = license_scan.TEMPLATES["MIT"]
    long_line = " ".join(f"word{i}" for i in range(500)) + " Released under the MIT License. " + " ".join(f"more{i}" for i in range(300))
    rows = [(1, "code\n" + mit[1] + "\nend"), (2, "Licensed under CC BY-NC 4.0."), (3, "a license to speak, nothing else"), (4, None), (5, ""),
            (6, "nothing here"), (7, mit[1].replace("free of charge", "for a fee").replace("merge, ", "")), (8, long_line),
            (9, "This work is licensed under the GNU General Public License, version 2."), (10, "Licensed under the Apache License, Version 2.0."),
            (2, "Licensed under CC BY-NC 4.0.")]
    out = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string").withColumn("block", F.lit(0))).collect()
    best = {r["id"]: r for r in out if r["confirmed"]}
    assert {k: r["license"] for k, r in best.items()} == {1: "MIT", 2: "CC-BY-NC", 7: "MIT", 8: "MIT", 9: "GPL", 10: "Apache-2.0"}
    assert not any(r["confirmed"] for r in out if r["id"] == 3) and sum(r["id"] == 2 for r in out) == 2
    assert best[1]["n_missing"] == 0 and best[7]["n_missing"] == 4 and "-free" in best[7]["differences"] and "+fee" in best[7]["differences"]
    text = dict(rows)[1]
    assert text[best[1]["start"]:best[1]["end"]] == mit[1].rstrip(":")


def test_license_wordings_broken_over_lines(spark):
    def broken(wording, mark):
        cut = wording.split(" ")
        return "\n".join(mark + " ".join(cut[i:i + 9]) for i in range(0, len(cut), 9))

    wordings = {(name, i): w for name, ws in license_scan.TEMPLATES.items() for i, w in enumerate(ws) if len(w.split()) > 25}
    rows = [(n, "def f(): pass\n" + broken(w, mark) + "\n\nmore of it " * 40) for n, (w, mark) in
            enumerate((w, mark) for w in wordings.values() for mark in ("# ", " * "))]
    rows.append((100, "a license\nto speak\n" * 200))
    out = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = sorted((r["id"], r["license"]) for r in out if r["confirmed"])
    assert found == sorted((2 * n + m, name) for n, (name, _) in enumerate(wordings) for m in (0, 1))
    texts, whole = dict(rows), [r for r in out if r["confirmed"] and (r["license"], r["template"]) in wordings]
    assert len(whole) >= 2 * len(wordings) - 2  # the first line of Apache's long wording is its short one
    for r in whole:
        assert license_scan.words(texts[r["id"]][r["start"]:r["end"]].replace("*", "").replace("#", "")) == license_scan.words(wordings[r["license"], r["template"]])


def test_license_cues_on_later_lines(spark):
    texts = {"MPL-2.0": "/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not",
             "MIT": "Released under the\nMIT License.", "BSD": "# Use of this source code is governed by a BSD-style\n# license that can be found in the LICENSE file.",
             "Proprietary": "all of it\n// All rights\n// reserved.", "Unlicense": "This is free and unencumbered software released into the public\n * domain."}
    out = license_scan.scan_licenses(spark.createDataFrame(list(enumerate(texts.values())), "doc_id long, text string")).collect()
    assert sorted((r["id"], r["license"], r["n_missing"], r["confirmed"]) for r in out) == [(i, name, 0, True) for i, name in enumerate(texts)]
    assert texts["MIT"][:-1] == next(texts["MIT"][r["start"]:r["end"]] for r in out if r["license"] == "MIT")
    lines = "\n".join(f"x{i}\nReleased under\nthe MIT License." for i in range(200))  # no wording is lost between stretches
    assert [(lines[a:b], r[0]) for a, b, r in license_scan.Scanner().scan(lines)] == [("Released under\nthe MIT License", "MIT")] * 200


def test_license_blocks_with_several_notices(spark):
    alone = {(name, i): w for name, ws in license_scan.TEMPLATES.items() for i, w in enumerate(ws) if (name, i) != ("Apache-2.0", 0)}
    mit = " ".join(license_scan.TEMPLATES["MIT"][1].replace("charge", "cost").split())
    wrapped = "\n".join(" * " + " ".join(mit.split(" ")[i:i + 9]) for i in range(0, len(mit.split(" ")), 9))
    texts = ["Released under the MIT License. All rights reserved.", "Released under the MIT License. Licensed under the Apache License, Version 2.0.",
             wrapped + "\n\n * All rights reserved.", " ".join(alone.values()), " ".join(f"{w} Of {i}." for i, w in enumerate([*alone.values()] * 2)),
             "This work is licensed under the GNU General Public License, version 2. " * 3]
    out = license_scan.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert all(r["confirmed"] for r in out)

    def found(i):
        return [(r["license"], r["template"]) for r in sorted(out, key=lambda r: r["block"]) if r["id"] == i]

    assert found(0) == [("MIT", 0), ("Proprietary", 0)] and found(1) == [("MIT", 0), ("Apache-2.0", 0)]
    assert found(2) == [("MIT", 1), ("Proprietary", 0)] and found(3) == [*alone] and found(4) == [*alone] * 2
    assert found(5) == [("GPL", 0)] * 3


def test_line_dedup_gathers_no_list_over_rows_without_an_id(spark):
    rows = [(None, f"shared line number {i % 3}\nown line number {i}") for i in range(60)] + [(1, "shared line number 0"), (1, "own line number 7")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lost = linededup.dropped_lines(docs, "doc_id", "text", linededup.MIN_CHARS, 4, 2).collect()
    assert len(lost) == 21 and max(len(r["drop"]) for r in lost) == 1
    out, c = linededup.dedup_lines(docs)
    assert out.agg(F.sum(c["n_dropped"])).first()[0] == 21


def test_license_ranking_agrees_with_an_alignment_of_all_templates(spark):
    scanner = license_scan.Scanner()
    for name, wordings in license_scan.TEMPLATES.items():
        for w in wordings:
            block = license_scan.words("some words before " + w + " and after")
            fewest = min(scanner.templates, key=lambda t: (sum(map(len, scanner.differences(t[2], block))), -len(t[2])))
            found = scanner.judge(block)
            assert found[0] == fewest[0] == name and found[6]
