"""The keyword test before a rule loses no detection."""

from larkspur.llm import licenses
from tests.llm.test_licenses import brute

TEXTS = ["Licensed under the ASL 2.0.", "FreeBSD license", "released under the FreeBSD licence", "License: ASL, version 1.1"]


def statements():
    """Each name of each family in each form, with its last version."""
    for _, _, names, versions in licenses.FAMILIES:
        for name in names:
            name = f"{name} {versions[-1]}".strip()
            yield from (f"SPDX-License-Identifier: {name}", f"Licensed under the terms of the {name}", f"a {name} license", f"License: {name}")


def test_names_without_the_familys_word(spark):
    got = licenses.scanned(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["labels"] for r in got} == {0: "apache-2.0", 1: "bsd-2-clause", 2: "bsd-2-clause", 3: "apache-1.1"}
    assert {r["doc_id"]: r["score"] for r in got} == {0: 0.95, 1: 0.9, 2: 0.95, 3: 0.85}


def test_against_brute_force_without_keywords(spark, monkeypatch):
    rows = list(enumerate([*TEXTS, *statements()]))
    got = {r["doc_id"]: tuple(r)[1:] for r in licenses.scanned(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()}
    every = tuple((priority, label, "", sure, form) for priority, label, _, sure, form in licenses.rules())
    monkeypatch.setattr(licenses, "rules", lambda: every)
    for k, text in rows:
        assert got[k] == brute(text), text
