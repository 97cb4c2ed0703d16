"""Secret scans with column expressions alone.

Three base kinds are regular expressions.  Java's ``split`` gives the text
between the matches that ``regexp_extract_all`` gives, so running lengths of
both are the code point positions.  Beside them, candidate strings (long
runs of key characters) are read by a sliding window: the window's character
counts and its entropy sum change by the character that enters and the one
that leaves, and the windows whose Shannon entropy reaches the minimum of
the candidate's character class are merged into spans.  Candidates on the
allow-list, and entropy spans inside a base span, are suppressed.

Entropies are compared in fixed point (``c * log2 c`` in units of 2**-20), so
any engine decides alike.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import permutations
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, read, walk

# The base kinds in their order, with the group and length that a match needs.
KINDS = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]{32,}", 0, 32),  # a run of [0-9a-f]+ under 32 fails, and no part of it is longer
}
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW, UNIT, STRETCH = 20, 1 << 20, 1024
# Character classes, narrowest first: pattern of the whole candidate, least entropy in bits a character of a window.  A limit lies
# where about 1 in 100 windows of random characters of the alphabet is under it (base64: 1 in 30); in letters alone above long words.
MIXED = "|".join(".*".join(f"[{r}]" for r in order) for order in permutations(("a-z", "A-Z", "0-9")))
CLASSES = (("hex", r"^(?:[0-9a-f]+|[0-9A-F]+)$", 3.0), ("mixed hex", r"^[0-9a-fA-F]+$", 3.15),
           ("one-case letters", r"^(?:[a-z]+|[A-Z]+)$", 3.6), ("letters", r"^[A-Za-z]+$", 3.7),
           ("upper digits", r"^[A-Z0-9]+=*$", 3.4), ("lower digits", r"^[a-z0-9]+=*$", 3.4), ("base62", r"^[A-Za-z0-9]+=*$", 3.65),
           ("base64", MIXED, 3.7), ("signs", r"^[A-Za-z0-9+/_=-]+$", 3.9))
# Candidates that are no secrets: words (each under 20 letters, in one case or capitalised) joined by signs, identifiers in the
# 8-4-4-4-12 form, placeholders without 20 characters in a row beside them, numbers.
PLAIN, PLACEHOLDERS = "(?:[A-Z]?[a-z]{1,18}|[A-Z]{1,19})", "example|sample|dummy|placeholder|changeme|xxxx|1234567890"
ALLOWED = (rf"^{PLAIN}(?:[-_/+=]+{PLAIN})*[-_/+=]*$", r"^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
           rf"(?i)^(?:[A-Za-z0-9+/_=-]{{0,19}}(?:{PLACEHOLDERS}))+[A-Za-z0-9+/_=-]{{0,19}}$", r"^[0-9_/+=-]+$")
COST = [round(c * math.log2(c) * UNIT) if c else 0 for c in range(WINDOW + 1)]

SPAN = "struct<start:int,rank:int,end:int,kind:string>"


def entropy_limit(bits: float, window: int = WINDOW) -> int:
    """The largest sum of ``c * log2 c`` (fixed point) of a window whose entropy is at least ``bits``."""
    return math.floor(window * (math.log2(window) - bits) * UNIT)


def located(text: Column, pattern: str, group: int, least: int, kind: str, rank: int) -> Column:
    """Spans of the matches whose group has at least ``least`` characters."""
    whole, part = (F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in (0, group))
    sizes = F.arrays_zip(F.transform(F.split(text, pattern, -1), F.length).alias("gap"), F.transform(whole, F.length).alias("m"),
                         F.transform(part, F.length).alias("g"))

    def step(s, x):
        begin = s["s"] + x["gap"]
        end = begin + F.coalesce(x["m"], F.lit(0))
        span = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"))
        return F.struct(end.alias("s"), F.when(x["g"] >= least, F.concat(s["out"], F.array(span))).otherwise(s["out"]).alias("out"))

    _, found = walk(sizes, F.lit(0), step, SPAN)
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(f"array<{SPAN}>"))


# Counts of the 128 characters, PACKED to a long, of BITS bits each; a window's counts fit.
PACKED, BITS = 12, 5
LONGS = -(-128 // PACKED)


def _shift(a: Column, c: Column, name: str = "shiftright") -> Column:
    return F.call_function(name, a, (F.pmod(c, F.lit(PACKED)) * BITS).cast("int"))


def _count(n: Column, c: Column) -> Column:
    """The count of the character with code ``c``."""
    return _shift(F.get(n, F.floor(c / PACKED).cast("int")), c).bitwiseAND((1 << BITS) - 1).cast("int")


def _put(n: Column, c: Column, by: int) -> Column:
    """The counts with that of the character with code ``c`` changed by ``by``."""
    i = F.floor(c / PACKED).cast("int")
    return F.concat(F.slice(n, F.lit(1), i), F.array(F.get(n, i) + _shift(F.lit(1).cast("long"), c, "shiftleft") * by), F.slice(n, i + 2, F.lit(LONGS)))


def hot_runs(candidate: Column, limit: Column, window: int = WINDOW) -> Column:
    """Runs ``(start, end)`` of the candidate's characters that lie in a window at or under the entropy limit.

    One pass: the state holds the counts of the window's characters, the entropy sum and the run
    that is open.  The candidate is read in stretches that hand this state and their last window on.
    """
    cost = F.array(*[F.lit(c).cast("long") for c in COST])
    run = "struct<start:int,end:int>"

    def step(s, x):
        # two steps, each a let-binding: first the old character leaves, then the new one enters
        def leave(c):
            return F.struct(_put(s["n"], x["old"], -1).alias("n"), (s["sum"] - F.get(cost, c) + F.get(cost, c - 1)).alias("sum"))

        def enter(m):
            c = _count(m["n"], x["new"])
            return F.struct(_put(m["n"], x["new"], 1).alias("n"), (m["sum"] - F.get(cost, c) + F.get(cost, c + 1)).alias("sum"))

        left = F.when(x["old"].isNull(), F.struct(s["n"].alias("n"), s["sum"].alias("sum"))).otherwise(leave(_count(s["n"], x["old"])))

        def close(m):
            begin, end = s["i"] + 1 - window, s["i"] + 1
            hot = (s["i"] + 1 >= window) & (m["sum"] <= limit)
            joins = hot & (s["end"] >= begin) & (s["start"] >= 0)
            old = F.struct(s["start"].alias("start"), s["end"].alias("end"))
            return F.struct((s["i"] + 1).alias("i"), m["n"].alias("n"), m["sum"].alias("sum"),
                            F.when(hot & ~joins, begin).otherwise(s["start"]).alias("start"),
                            F.when(hot, end).otherwise(s["end"]).alias("end"),
                            F.when(hot & ~joins & (s["start"] >= 0), F.concat(s["out"], F.array(old))).otherwise(s["out"]).alias("out"))

        return let(let(left, enter), close)

    def kept(s):
        return [s[c].alias(c) for c in ("i", "n", "sum", "start", "end")]

    def stretch(s, piece):
        def read_on(codes):
            both = F.concat(s["tail"], codes)  # the character that enters, the one that leaves
            pairs = F.arrays_zip(codes.alias("new"), F.slice(both, F.lit(1), F.size(codes)).alias("old"))
            walked = F.aggregate(pairs, F.struct(*kept(s), F.array().cast(f"array<{run}>").alias("out")), step)
            return let(walked, lambda w: F.struct(*kept(w), F.slice(both, -window, window).alias("tail"), F.concat(s["out"], F.array(w["out"])).alias("out")))

        return let(F.transform(F.split(piece, ""), F.ascii), read_on)

    state = F.struct(F.lit(0).alias("i"), F.array_repeat(F.lit(0).cast("long"), LONGS).alias("n"), F.lit(0).cast("long").alias("sum"),
                     F.lit(-1).alias("start"), F.lit(-1).alias("end"), F.array_repeat(F.lit(None).cast("int"), window).alias("tail"),
                     F.array().cast(f"array<array<{run}>>").alias("out"))

    def finish(s):
        last = F.struct(s["start"].alias("start"), s["end"].alias("end"))
        return F.concat(F.flatten(s["out"]), F.when(s["start"] >= 0, F.array(last)).otherwise(F.array().cast(f"array<{run}>")))

    return F.aggregate(F.regexp_extract_all(candidate, F.lit(f"(?s).{{1,{STRETCH}}}"), F.lit(0)), state, stretch, finish)


def entropy_spans(text: Column, base: Column) -> Column:
    """Spans of high entropy in candidates that are not allow-listed, outside the base spans."""
    found = located(text, CANDIDATE, 0, 20, "entropy", len(KINDS))

    # each step is an array of its own, so a word is cut and classed once
    words = F.arrays_zip(found.alias("at"), F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)).alias("word"))
    words = F.filter(words, lambda x: ~reduce(or_, [x["word"].rlike(p) for p in ALLOWED]))

    def limited(x):
        limit = F.lit(None).cast("long")
        for _, pattern, bits in reversed(CLASSES):
            limit = F.when(x["word"].rlike(pattern), F.lit(entropy_limit(bits))).otherwise(limit)
        return F.struct(x["at"].alias("at"), x["word"].alias("word"), limit.alias("limit"))

    def runs(x):
        at = x["at"]
        return F.transform(hot_runs(x["word"], x["limit"]), lambda r: F.struct(
            (at["start"] + r["start"]).alias("start"), at["rank"].alias("rank"), (at["start"] + r["end"]).alias("end"), at["kind"].alias("kind")))

    added = F.flatten(F.transform(F.transform(words, limited), runs))

    # both in one order, base spans first: an added span lies in a base span if one that began before reaches its end
    def tagged(spans, tag):
        return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.lit(tag).alias("tag"), x["end"].alias("end"), x["rank"].alias("rank"), x["kind"].alias("kind")))

    def step(s, x):
        span = F.struct(*(x[c].alias(c) for c in ("start", "rank", "end", "kind")))
        outside = (x["tag"] == 1) & (s["s"] < x["end"])
        return F.struct(F.when(x["tag"] == 0, F.greatest(s["s"], x["end"])).otherwise(s["s"]).alias("s"),
                        F.when(outside, F.concat(s["out"], F.array(span))).otherwise(s["out"]).alias("out"))

    _, outside = walk(F.array_sort(F.concat(tagged(base, 0), tagged(added, 1))), F.lit(-1), step, SPAN)
    return outside


def joined(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, base, added)`` of every row: arrays of spans ``(start, rank, end, kind)`` in code points.

    Null and empty texts have no spans; the whole text is read; repeated rows each get
    their row; null ids stay; an empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    base = F.concat(*[located(F.col("text"), p, g, n, kind, i) for i, (kind, (p, g, n)) in enumerate(KINDS.items())])
    rows = rows.select("id", "text", base.alias("base"))
    none = F.array().cast(f"array<{SPAN}>")
    added = F.when(F.col("text").rlike(CANDIDATE), entropy_spans(F.col("text"), F.col("base"))).otherwise(none)
    return rows.select("id", "base", added.alias("added"))


def op8_secrets(spark, sf_dir: str) -> DataFrame:
    """``op8``: counts of the base kinds, the digest of the base spans, and all spans of every document."""
    found = scan_secrets(read(spark, sf_dir, "documents"))

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(F.col("id").alias("doc_id"), *[count(k) for k in KINDS], F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                        joined(F.concat("base", "added")).alias("spans"))
