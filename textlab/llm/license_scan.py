"""License scans by conditional compression.

Cue words are searched over the whole text, with any blanks and comment marks
between them.  The stretch of words around a cue, long enough on both sides for
the longest template, is compressed with zstandard twice: plainly, and with each
license template as a raw-content dictionary.  The templates are ranked by the
size reduction; down the ranking, as long as there is a reduction, each is aligned
word by word with the stretch, and a wording that is there but for a few words is
confirmed, with its own place.  Numbers may differ from the template.

Rows are never shuffled.  Only texts with a cue word leave the JVM.
"""

from __future__ import annotations

import math
import re
from array import array
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read, text_bytes

# Wordings of license notices.  "#" stands for any number.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version #.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        "law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met:",
        "Licensed under the BSD License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    "CC-BY": ("Licensed under CC BY #.", "This work is licensed under a Creative Commons Attribution # International License."),
    "CC-BY-NC": ("Licensed under CC BY-NC #.",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial # International License."),
    "CC-BY-SA": ("Licensed under CC BY-SA #.",
                 "This work is licensed under a Creative Commons Attribution-ShareAlike # International License."),
    "GPL": (
        "This work is licensed under the GNU General Public License, version #.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version # of the License, or (at your option) any later version."),
    "LGPL": ("This work is licensed under the GNU Lesser General Public License, version #.",),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions:"),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. #.",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "Proprietary": ("All rights reserved.", "Unauthorized copying of this file, via any medium, is strictly prohibited."),
}
CUES = "(?i)" + "|".join(cue.replace(" ", r"[\W_]+") for cue in (
    "licen[cs]", "copyright", "permission is hereby", "redistribut", "public domain", "all rights reserved", "creative commons",
    "unauthorized copying", "free software"))
BLOCK_WORDS, OVERLAP = 160, 80
LEVEL = 9
MISSING = 0.15
WORD = re.compile(r"[^\W_]+", re.UNICODE)
RESULT = ("id long, block int, start int, end int, license string, template int, reduction double, "
          "n_missing int, n_added int, differences string, confirmed boolean")


def words(text: str) -> list[str]:
    """Lower-cased words; a number is #."""
    return words_of(WORD.finditer(text))


def words_of(spots) -> list[str]:
    return ["#" if m.group().isdigit() else m.group().lower() for m in spots]


def table(own: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Cell (i, j): fewest words missing or added between the first i words of a template and some words that end before j."""
    out, at = np.zeros((len(own) + 1, len(block) + 1), np.int32), np.arange(len(block) + 1, dtype=np.int32)
    for i, w in enumerate(own):
        row = out[i] + 1
        row[1:] = np.where(block == w, out[i, :-1], row[1:])
        out[i + 1] = np.minimum.accumulate(row - at) + at
    return out


def traced(cells: np.ndarray, own: np.ndarray, block: np.ndarray, end: int):
    """``(start, end, missing, added)`` of the alignment that ends before ``end``: first and last matched word, and what differs."""
    i, j, matched, missing, added = len(own), end, [], [], []
    while i:
        if j and own[i - 1] == block[j - 1]:
            i, j = i - 1, j - 1
            matched.append(j)
        elif cells[i, j] == cells[i - 1, j] + 1:
            i -= 1
            missing.append(i)
        else:
            j -= 1
            added.append(j)
    return (matched[-1], matched[0] + 1, missing[::-1], added[::-1]) if matched else (0, 0, missing[::-1], [])


def occurrences(own: np.ndarray, block: np.ndarray, limit: float) -> list[tuple]:
    """The alignments of a template with at most ``limit`` differences that do not overlap, best first."""
    cells, out = table(own, block), []
    last = cells[-1]
    ends = np.flatnonzero((last[1:] <= limit) & (last[1:] <= last[:-1])) + 1  # after others the last word is one more than the wording
    for end in sorted(ends.tolist(), key=lambda j: (last[j], j)):
        new = traced(cells, own, block, end)
        if all(new[1] <= a or z <= new[0] for a, z, _, _ in out):
            out.append(new)
    return out


class Scanner:
    """Compressors for every template, made once in a worker."""

    def __init__(self, templates: dict = TEMPLATES):
        small = dict(write_content_size=False, write_checksum=False, write_dict_id=False)
        params = zstandard.ZstdCompressionParameters.from_level(LEVEL, format=zstandard.FORMAT_ZSTD1_MAGICLESS, **small)
        self.plain = zstandard.ZstdCompressor(compression_params=params)
        self.templates = []
        for name, wordings in templates.items():
            for i, wording in enumerate(wordings):
                raw = zstandard.ZstdCompressionDict(" ".join(words(wording)).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                raw.precompute_compress(compression_params=params)
                self.templates.append((name, i, words(wording), zstandard.ZstdCompressor(compression_params=params, dict_data=raw)))
        self.ids = {w: n for n, w in enumerate(sorted({w for t in self.templates for w in t[2]}))}
        self.own = [self.numbers(t[2]) for t in self.templates]
        self.counts = np.array([np.bincount(o, minlength=len(self.ids)) for o in self.own])
        self.limits = [MISSING * len(o) for o in self.own]
        self.reach = math.ceil(max((1 + MISSING) * len(o) for o in self.own))

    def numbers(self, block: list[str]) -> np.ndarray:
        return np.array([self.ids.get(w, -1) for w in block], np.int32)

    def ranked(self, block: list[str]) -> list[tuple[float, int]]:
        """(size reduction, template), best first: the bytes that the dictionary saves, as a share of the template's own saving."""
        data = " ".join(block).encode()
        plain, out = len(self.plain.compress(data)), []
        for i, (_, _, own, with_dict) in enumerate(self.templates):
            saved = plain - len(with_dict.compress(data))
            out.append((saved / max(1, len(" ".join(own))), i))
        return sorted(out, key=lambda x: (-x[0], x[1]))

    @staticmethod
    def differences(template: list[str], block: list[str]) -> tuple[list[str], list[str]]:
        """Template words that the block lacks, and block words inside the wording that the template lacks."""
        ids = {w: n for n, w in enumerate(template)}
        own, found = (np.array([ids.get(w, -1) for w in x], np.int32) for x in (template, block))
        cells = table(own, found)
        _, _, missing, added = traced(cells, own, found, int(cells[-1].argmin()))
        return [template[i] for i in missing], [block[j] for j in added]

    def row(self, i: int, reduction: float, missing: list[str], added: list[str]):
        n = len(missing) + len(added)
        return (*self.templates[i][:2], round(reduction, 6), len(missing), len(added),
                " ".join([*("-" + w for w in missing), *("+" + w for w in added)]), n <= self.limits[i])

    def near(self, found: np.ndarray) -> np.ndarray:
        """Which templates can be confirmed: the words that the block lacks, wherever they stand, are within the tolerance."""
        return np.maximum(self.counts - np.bincount(found[found >= 0], minlength=len(self.ids)), 0).sum(1) <= self.limits

    def wordings(self, block: list[str]):
        """``(start, end, template, rank row)`` of the confirmed wordings in a stretch; start and end are words of it.

        The ranking decides which templates are tried: down from the largest size reduction, as long as there is any.
        Of these, one with too many words that the stretch lacks altogether is known to fail and is not aligned.
        """
        found, out = self.numbers(block), []
        near = self.near(found)
        for reduction, i in self.ranked(block):
            if reduction <= 0:
                break
            if near[i]:
                for start, end, missing, added in occurrences(self.own[i], found, self.limits[i]):
                    row = self.row(i, reduction, [self.templates[i][2][m] for m in missing], [block[j] for j in added])
                    out.append((start, end, i, row))
        return out

    def scan(self, text: str):
        """``(start, end, rank row)`` of each confirmed wording and of each other block with a cue word, by place in characters."""
        cues = [m.start() for m in re.finditer(CUES, text)]
        if not cues:
            return
        starts, ends = array("q"), array("q")
        for m in WORD.finditer(text):
            starts.append(m.start())
            ends.append(m.end())

        def block(first, last):
            return ["#" if (w := text[a:b]).isdigit() else w.lower() for a, b in zip(starts[first:last], ends[first:last])]

        at, found, done = sorted({bisect_right(starts, c) - 1 for c in cues}), [], -1
        for c in at:
            if c > done:  # all cues up to ``done`` have a whole template's length on both sides
                first, done = max(0, c - self.reach), c + OVERLAP
                found += [(first + a, first + z, i, row) for a, z, i, row in self.wordings(block(first, done + self.reach))]
        kept = []  # by start; a wording that overlaps a longer one goes
        for a, z, i, row in sorted(found, key=lambda x: (x[0] - x[1], x[3][3] + x[3][4], -len(self.own[x[2]]), x[2], x[0])):
            n = bisect_left(kept, (a,))
            if (n == 0 or kept[n - 1][1] <= a) and (n == len(kept) or kept[n][0] >= z):
                kept.insert(n, (a, z, row))
        out = [(starts[a], ends[z - 1], row) for a, z, row in kept]

        done = -1
        for c in at:
            if c <= done:
                continue
            line_end = text.find("\n", starts[c])
            lo = bisect_left(starts, text.rfind("\n", 0, starts[c]) + 1)
            hi = len(starts) if line_end < 0 else bisect_left(starts, line_end)
            done = hi - 1
            for first in range(lo, max(lo + 1, hi - OVERLAP), OVERLAP):
                last = min(first + BLOCK_WORDS, hi)
                n, k = bisect_left(at, first), bisect_left(kept, (last,))
                if n < len(at) and at[n] < last and (k == 0 or kept[k - 1][1] <= first):
                    out.append((starts[first], ends[last - 1], self.judge(block(first, last))))
        yield from sorted(out, key=lambda x: x[:2])

    def judge(self, block: list[str]):
        """The rank row of a block: the confirmed wording with the fewest differences, or else the best-ranked template."""
        found, near = None, self.near(self.numbers(block))
        for reduction, i in self.ranked(block):
            if found and not near[i]:
                continue
            own = self.templates[i][2]
            row = self.row(i, reduction, *self.differences(own, block))
            if found is None or row[6] and (not found[6] or (row[3] + row[4], -len(own)) < found[7]):
                found = (*row, (row[3] + row[4], -len(own)))
        return found[:7]


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict = TEMPLATES) -> DataFrame:
    """One row a block: its place, its license and how the wording differs; ``confirmed`` if within the tolerance.

    A confirmed block is a wording around a cue word, whatever lines it is broken over.  Other blocks are the
    lines, or each stretch of 160 words (every 80) of a longer one, that hold a cue word and no part of a confirmed
    wording.  Of wordings that overlap, the longer one is given, then the one that differs less.  Null and empty texts
    and texts without cue words have no rows; the whole text is read; repeated rows each give
    their rows; null ids stay; ties go to the first template; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.where(F.col("text").rlike(CUES))

    def run(batches):
        scanner = Scanner(templates)
        for b in batches:
            out = [(i, n, s, e, *found) for i, text in zip(b.column(0).to_pylist(), text_bytes(b.column(1)))
                   for n, (s, e, found) in enumerate(scanner.scan(text.decode()))]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    names = [c.split()[0] for c in RESULT.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_()}
    types = [kinds[c.split()[1]] for c in RESULT.split(", ")]
    return rows.mapInArrow(run, RESULT)


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    """``op1``: every candidate block of every document with its license."""
    return scan_licenses(read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
