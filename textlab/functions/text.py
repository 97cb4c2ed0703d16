"""Text scalars as native Spark column expressions (no Python UDF).

Every function takes and returns a :class:`~pyspark.sql.Column`, so the
cleaning runs inside the JVM next to the parquet scan and can be used in
``select`` or ``withColumn``.

Semantics follow the reference's cleaner: lowercase, delete ``http\\S+``,
delete every character that is not ``a-z`` or whitespace (deleted, not
replaced: ``don't`` -> ``dont``), word-tokenize, drop stop words and
tokens of length <= 2.  On text made only of ``a-z`` and whitespace the
word tokenizer is a whitespace split plus six fixed contraction splits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour).
# English stop-word list used by the reference's cleaner, in its natural
# order.  Entries with an apostrophe can never match after the
# non-letter deletion step; they are kept so the list reads as published.
STOP_WORDS_EN = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself "
    "yourselves he him his himself she she's her hers herself it it's its itself they them their "
    "theirs themselves what which who whom this that that'll these those am is are was were be "
    "been being have has had having do does did doing a an the and but if or because as until "
    "while of at by for with about against between into through during before after above below "
    "to from up down in out on off over under again further then once here there when where why "
    "how all any both each few more most other some such no nor not only own same so than too "
    "very s t can will just don don't should should've now d ll m o re ve y ain aren aren't "
    "couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma "
    "mightn mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't weren "
    "weren't won won't wouldn wouldn't"
).split()

# Contractions the word tokenizer splits in letters-only text: whole token -> two parts.
CONTRACTION_SPLITS = (
    ("cannot", "can", "not"),
    ("gimme", "gim", "me"),
    ("gonna", "gon", "na"),
    ("gotta", "got", "ta"),
    ("lemme", "lem", "me"),
    ("wanna", "wan", "na"),
)

# Shortest token that survives the stop-word step (reference: len(w) > 2).
MIN_TOKEN_LENGTH = 3
# Token window of the encoder step: total length including the two special tokens.
WINDOW_LENGTH = 128
CLS_TOKEN, SEP_TOKEN, PAD_TOKEN = "[CLS]", "[SEP]", "[PAD]"
# ---------------------------------------------------------------------------


def _whitespace_ranges() -> list[tuple[int, int]]:
    """Code points Python's ``str.split()`` / ``\\s`` treat as whitespace, as ranges.

    Built from the rule (``str.isspace``) rather than typed in, so the Java
    pattern agrees with the reference's Python regexes on every code point.
    """
    points = [cp for cp in range(0x110000) if chr(cp).isspace()]
    ranges: list[tuple[int, int]] = []
    for cp in points:
        if ranges and ranges[-1][1] == cp - 1:
            ranges[-1] = (ranges[-1][0], cp)
        else:
            ranges.append((cp, cp))
    return ranges


def whitespace_class_body() -> str:
    """Body of a regex character class (no brackets) in ``\\x{...}`` form; valid in Java and RE2."""
    parts = []
    for lo, hi in _whitespace_ranges():
        parts.append(f"\\x{{{lo:04X}}}" if lo == hi else f"\\x{{{lo:04X}}}-\\x{{{hi:04X}}}")
    return "".join(parts)


WS = whitespace_class_body()
# Regex forms (used by the SQL oracle, which applies them to the raw text).
URL_PATTERN = f"http[^{WS}]+"
NON_LETTER_PATTERN = f"[^a-z{WS}]"
# The same characters for the JVM, where a class of that many ranges is tried on every character: letters and
# the plain space are passed over first.
_NON_LETTER = f"(?![a-z ])[^{WS}]"
WS_RUN_PATTERN = f"[{WS}]+"
# Whitespace tokens of a raw text: every whitespace code point is first mapped to a plain
# space with ``translate`` (a per-character table lookup), so the split only needs ' '.
WS_CHARS = "".join(chr(cp) for lo, hi in _whitespace_ranges() for cp in range(lo, hi + 1))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def combine_text(first, second) -> Column:
    """``coalesce(a,'') + ' ' + coalesce(b,'')`` (the space stays when a side is null)."""
    return F.concat(F.coalesce(_col(first), F.lit("")), F.lit(" "), F.coalesce(_col(second), F.lit("")))


def spaces(text) -> Column:
    """Null -> '' and every whitespace character -> ' ' (token boundaries unchanged)."""
    return F.translate(F.coalesce(_col(text), F.lit("")), WS_CHARS, " " * len(WS_CHARS))


def normalize_text(text) -> Column:
    """Null-safe lowercase, URLs deleted, non-letters deleted; whitespace kept as it was."""
    t = F.lower(F.coalesce(_col(text), F.lit("")))
    t = F.regexp_replace(t, URL_PATTERN, "")
    return F.regexp_replace(t, _NON_LETTER, "")


def _letter_words(text) -> Column:
    """P4-P7 for tokenising: the words of :func:`normalize_text`, which holds letters and whitespace alone."""
    # no pass over every character to find the spaces: whatever is no letter by now is one
    return F.split(normalize_text(text), "[^a-z]+")


def whitespace_tokens(text) -> Column:
    """Python ``str.split()``: split on runs of whitespace, no empty tokens; null -> []."""
    return F.filter(F.split(spaces(text), " "), lambda w: w != F.lit(""))


def split_contractions(tokens) -> Column:
    """Whole-token contraction splits of the word tokenizer (``gonna`` -> ``gon na``)."""
    whole = [c[0] for c in CONTRACTION_SPLITS]

    def one(w):
        return F.when(
            w.isin(whole), F.array(F.substring(w, 1, 3), F.substring(w, 4, 100))
        ).otherwise(F.array(w))

    return F.flatten(F.transform(_col(tokens), one))


def drop_stop_words(tokens, stop_words=STOP_WORDS_EN, min_length: int = MIN_TOKEN_LENGTH) -> Column:
    """Keep tokens with ``length >= min_length`` that are not stop words.

    ``isin`` over a long literal list is rewritten by Catalyst into a hash
    set lookup (``InSet``), so the per-token cost does not grow with the list.
    """
    stops = sorted(set(stop_words))
    return F.filter(_col(tokens), lambda w: (F.length(w) >= min_length) & ~w.isin(stops))


def clean_tokens(text, stop_words=STOP_WORDS_EN) -> Column:
    """P4-P8 (X1): the cleaned token array of a raw text column."""
    return drop_stop_words(split_contractions(_letter_words(text)), stop_words)


def clean_text(text, stop_words=STOP_WORDS_EN) -> Column:
    """Cleaned tokens joined by one space."""
    return F.array_join(clean_tokens(text, stop_words), " ")


def ngrams(tokens, n: int) -> Column:
    """P10: contiguous n-grams joined by a space; fewer than ``n`` tokens -> []."""
    t = _col(tokens)
    grams = F.transform(F.sequence(F.lit(0), F.size(t) - n), lambda i: F.array_join(F.slice(t, i + 1, n), " "))
    return F.when(F.size(t) >= n, grams).otherwise(F.array().cast("array<string>"))


def term_runs(sorted_tokens) -> Column:
    """Run-length encoding of an already sorted token array: ``array<struct<term, tf bigint>>``.

    A run starts where a term differs from the one before it.  The lambdas
    read the sorted array by position, so ``sorted_tokens`` must be a
    column (projected once, e.g. ``sort_array(tokens)``), not an expression
    that would be re-evaluated per element.
    """
    s = _col(sorted_tokens)
    n = F.size(s)
    starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: ~F.get(s, i).eqNullSafe(F.get(s, i - 1)))
    ends = F.concat(F.slice(starts, 2, n), F.array(n))
    runs = F.zip_with(starts, ends, lambda a, b: F.struct(F.get(s, a).alias("term"), (b - a).cast("long").alias("tf")))
    return F.when(n > 0, runs).otherwise(F.array().cast("array<struct<term:string,tf:bigint>>"))


def term_counts(df, tokens, keep: list, out: str = "_t"):
    """Distinct terms of each row's token (or n-gram) array with their counts, counted in the row.

    Returns ``df`` projected to ``keep + [out array<struct<term, tf>>]``.
    A document is one row, so its term frequencies need no shuffle: the
    array is sorted once (own projection) and run-length encoded.
    """
    sorted_df = df.select(*keep, F.sort_array(_col(tokens)).alias("_sorted"))
    return sorted_df.select(*keep, term_runs("_sorted").alias(out))


def token_count(text) -> Column:
    """Whitespace token count; null or blank -> 0."""
    return F.size(whitespace_tokens(text))


def token_window(tokens, length: int = WINDOW_LENGTH) -> Column:
    """``[CLS] + first (length-2) tokens + [SEP]``, padded to ``length``; with a 0/1 mask.

    Returns ``struct(window array<string>, mask array<int>)``.
    """
    t = _col(tokens)
    content = F.slice(t, 1, length - 2)
    n = F.size(content)
    pad = F.lit(length - 2) - n
    window = F.concat(F.array(F.lit(CLS_TOKEN)), content, F.array(F.lit(SEP_TOKEN)),
                      F.array_repeat(F.lit(PAD_TOKEN), pad))
    mask = F.concat(F.array_repeat(F.lit(1), n + 2), F.array_repeat(F.lit(0), pad))
    return F.struct(window.alias("window"), mask.alias("mask"))
