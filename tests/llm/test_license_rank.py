"""The compression ranking decides which templates a stretch is held against."""

from textlab.llm import license_scan

TEXTS = ["Some words before. Released under the MIT License. All rights reserved.",
         "a b c " * 30 + license_scan.TEMPLATES["MIT"][1] + " d e f" * 30,
         "nothing of the kind, but a license to cook", ""]


def rows(spark, texts=TEXTS):
    out = license_scan.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    return sorted(map(tuple, out.collect()), key=str)


def test_every_stretch_is_compressed_with_every_template(monkeypatch):
    scanner, calls = license_scan.Scanner(), []
    whole = scanner.ranked
    monkeypatch.setattr(scanner, "ranked", lambda block: calls.append(len(block)) or whole(block))
    list(scanner.scan(TEXTS[2]))  # no template is near
    assert len(calls) == 2  # its stretch, and then its line
    assert len(whole(license_scan.words(TEXTS[0]))) == len(scanner.templates)


def test_a_reversed_ranking_confirms_nothing_in_a_stretch(monkeypatch):
    scanner = license_scan.Scanner()
    block = license_scan.words(TEXTS[1])
    before = scanner.wordings(block)
    assert [(i, row[6]) for *_, i, row in before if scanner.templates[i][0] == "MIT" and row[0] == "MIT"]
    whole = scanner.ranked
    monkeypatch.setattr(scanner, "ranked", lambda b: sorted(whole(b), key=lambda x: (x[0], -x[1])))
    assert scanner.wordings(block) == []


def test_templates_are_tried_down_to_no_reduction(monkeypatch):
    scanner = license_scan.Scanner()
    block = license_scan.words(TEXTS[0])
    ranked = scanner.ranked(block)
    found = {i for *_, i, _ in scanner.wordings(block)}
    assert found and all(dict((i, r) for r, i in ranked)[i] > 0 for i in found)
    monkeypatch.setattr(scanner, "ranked", lambda b: [(r if i not in found else -1.0, i) for r, i in ranked])
    assert not scanner.wordings(block)


def test_ties_and_empty_tables(spark):
    twice = {"B": ("same words of a license notice here",), "A": ("same words of a license notice here",)}
    df = spark.createDataFrame([(1, "same words of a license notice here")], "doc_id long, text string")
    assert [r["license"] for r in license_scan.scan_licenses(df, templates=twice).collect()] == ["B"]  # the first template
    assert license_scan.scan_licenses(df.limit(0)).count() == 0
    assert [r[0] for r in rows(spark)] == sorted(r[0] for r in rows(spark)) and {r[0] for r in rows(spark)} == {0, 1, 2}
