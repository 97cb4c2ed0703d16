"""Repeated rows in a mix, and long conversations in the chat machine."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
import pandas as pd
from pyspark.sql import functions as F

import brute
from textlab.llm import chat, mixing


def per_source(mix):
    n = mix.names
    got = mix.rows.groupBy("source").agg(F.first(n["target"]).alias("target"), F.sum(F.col(n["size"]) * F.size(n["draws"])).alias("taken"),
                                         F.max(n["size"]).alias("longest"), F.max(F.size(n["draws"])).alias("most"))
    return {r["source"]: r for r in got.collect()}


@pytest.mark.parametrize("blocks", [1, 64, mixing.BLOCKS])
def test_a_source_of_equal_rows_reaches_its_target(spark, blocks):
    rows = [(7, "one two three four five six seven eight nine ten", "a")] * 1000 + [(None, "x y z", "b")] * 333 + [(i, f"w{i} " * (i % 9 + 1), "c") for i in range(667)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    mix = mixing.mix_sources(docs, (0.5, 2.0, 1.0), blocks=blocks)
    got = per_source(mix)
    assert mix.rows.count() == len(rows)
    for r in got.values():
        assert abs(r["taken"] - r["target"]) <= r["longest"] and r["most"] <= 3, r
    assert 0 < got["a"]["taken"] < 10_000
    again = per_source(mixing.mix_sources(docs.repartition(2), (0.5, 2.0, 1.0), blocks=blocks))
    assert {s: r["taken"] for s, r in again.items()} == {s: r["taken"] for s, r in got.items()}


@settings(max_examples=200, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(1, 40)), min_size=1, max_size=30), st.floats(0.5, 4000))
def test_a_border_block_takes_what_fits_whatever_repeats(groups, words):
    rows = pd.DataFrame([{"i": 3, "words": words, "key": 10 * k - 100, "size": s, "n": n} for k, (s, n) in enumerate(groups)])
    out = mixing.border_cut(rows)
    upto = out["upto"].dropna()
    taken = {int(k): (int(c), bool(w)) for k, c, w in zip(out["key"], out["copies"], out["whole"]) if not pd.isna(k)}
    total = 0
    for r in rows.itertuples():
        full = len(upto) and r.key <= upto.iloc[0]
        n = r.n if full else taken.get(r.key, (0, False))[0]
        assert 0 <= n <= r.n and (full or r.key not in taken or taken[r.key][1] == (n == r.n))
        total += n * r.size
    everything = int((rows["size"] * rows["n"]).sum())
    smallest = min((s for s, _ in groups if s), default=0)
    assert total <= words + smallest
    if total < min(words, everything):  # nothing left that fits
        left = words - total
        assert all(r.size > left or r.size == 0 for r in rows.itertuples()
                   if not (len(upto) and r.key <= upto.iloc[0]) and taken.get(r.key, (0,))[0] < r.n)


def test_written_mix_has_every_draw_of_repeated_rows(spark):
    rows = [(None, "same words here", "a")] * 300 + [(i, "other words", "b") for i in range(300)]
    mix = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"), (5.0, 0.1))
    n = mix.names
    assert mixing.write_order(mix, slice_words=100).count() == mix.rows.agg(F.sum(F.size(n["draws"]))).first()[0]


def test_long_conversations_are_walked_whole(spark, monkeypatch):
    rows = [(1, i, ("user", "assistant")[i % 2], f"turn {i}") for i in range(1000)] + [(2, i, "user" if i % 2 == 0 or i == 777 else "assistant", "") for i in range(1000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    seen = []
    for stretch in (1, 7, 64, 4096):
        monkeypatch.setattr(chat, "STRETCH", stretch)
        out = {r["id"]: r for r in chat.format_chats(df).collect()}
        assert (out[1]["first_wrong"], out[1]["ends_open"], out[2]["first_wrong"], out[2]["ends_open"]) == (None, False, 777, True)
        assert len(out[1]["loss_spans"]) == 500 and "".join(s["text"] for s in out[1]["segments"]) == out[1]["formatted"]
        seen.append((out[1]["formatted"], out[2]["formatted"]))
    assert len(set(seen)) == 1


def test_segments_come_from_the_machine(spark):
    """Its transitions decide the verdict of the same walk that emits the segments."""
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "assistant", "c")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    loose = chat.Template(order={**chat.INST.order, "assistant": {"user": "user", "assistant": "assistant"}})
    a, b = chat.format_chats(df).first(), chat.format_chats(df, loose).first()
    assert (a["first_wrong"], a["ends_open"], b["first_wrong"], b["ends_open"]) == (2, True, None, False) and a["segments"] == b["segments"]
    plan = chat.format_chats(df).select("segments")._jdf.queryExecution().optimizedPlan().toString()
    assert "wrong" in plan  # the walk is not pruned away where only segments are read
