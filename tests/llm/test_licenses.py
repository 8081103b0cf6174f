import regex as re
from pyspark.sql import functions as F

from larkspur.llm import licenses
from tests.llm.conftest import edge_rows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(licenses.UPPER, licenses.LOWER)

TEXTS = [
    "This work is licensed under the GNU General Public License, version 3.",
    "Licensed under CC BY-NC 4.0. And again: CC  BY, cc\nby\ncc by.",
    "MIT License mit license MIT-LICENSE",
    "Released under the MIT License.\nSPDX-License-Identifier: Apache-2.0\nAll rights reserved.",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "Permission is hereby granted, free of charge, to any person obtaining a copy; see the license",
    "the creative commons attribution share alike 4.0 international license",
    "dedicated to the public domain under CC0 1.0 Universal",
    "an accby word, commit licensed, submit license",
    "gnu general public license gnu general public license version 2 of the license",
    "LGPL v2.1 license; Mozilla Public License 2.0; Eclipse Public License 1.0; licence: BSD",
    "É MIT LICENSE ﬁn K LICENSE",
    "licensed under the terms of the gnu lesser general public license version 3 0",
]


def brute(text):
    words = WORD.findall((text or "").translate(LOWER))
    starts = {}
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        starts[label] = [k for k in range(len(words) - len(p) + 1) if words[k : k + len(p)] == p]
    places = sorted(k for v in starts.values() for k in v)
    base = sorted(label for label, v in starts.items() if v)
    low = "| " + " ".join(words) + " "
    found = []
    if words and re.search(licenses.GATE, " ".join(words), re.A | re.I):
        for priority, label, keyword, sure, form in licenses.rules():
            if f" {keyword}" in low:
                for m in re.finditer(f"(?<= )({form})(?= )", low):
                    first = low[: m.start()].count(" ") - 1
                    found.append((first, -(first + m[0].count(" ") + 1), priority, label, sure))
    kept = []
    for m in sorted(found, key=lambda m: (m[2], m[0] + m[1], m[0])):  # any two of all, not only neighbours
        if not any(set(range(m[0], -m[1])) & set(range(k[0], -k[1])) for k in kept):
            kept.append(m)
    labels = sorted({*base, *(m[3] for m in kept)})
    score = max([0.6 * bool(base), *(m[4] for m in kept)])
    return (len(words), len(places), places[0] if places else None, places[-1] if places else None, ",".join(base), ",".join(labels), score)


def test_some_hundred_rules_compile():
    assert len(licenses.rules()) > 300
    assert len({r[4] for r in licenses.rules()}) > 250
    for r in licenses.rules():
        re.compile(r[4])


def test_against_brute_force(spark, edge_docs):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(100 + k, " ".join(TEXTS[k:] + TEXTS[:k])) for k in range(0, len(TEXTS), 3)] + [(200, (TEXTS[0] + " " + TEXTS[3] + "\n") * 300)]
    got = {r["doc_id"]: tuple(r)[1:] for r in licenses.scanned(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, t in rows:
        assert got[k] == brute(t), t[:200]
    got = sorted((tuple(r) for r in licenses.scanned(edge_docs).collect()), key=str)
    assert got == sorted(((r[0], *brute(r[1])) for r in edge_rows()), key=str)


SAID = {
    "licensed under GPLv3": "gpl-3.0", "see GPL-3.0-only": "gpl-3.0", "BSD-3-Clause": "bsd-3-clause", "https://creativecommons.org/licenses/by-sa/4.0/legalcode": "cc-by-sa-4.0",
    "you may not use this file except in compliance with the License": "apache", "This program is free software; you can redistribute it": "gpl", "Apache-2.0 OR MIT": "apache-2.0,mit",
    "MIT AND (BSD-2-Clause OR MPL-2.0)": "bsd-2-clause,mit,mpl-2.0", "MIT OR GPL-2.0-or-later": "gpl-2.0,mit", "http://www.apache.org/licenses/LICENSE-2.0": "apache-2.0", "LGPLv2.1+ and AGPLv3": "agpl-3.0,lgpl-2.1",
    "https://opensource.org/licenses/MIT": "mit", "This is free and unencumbered software released into the public domain.": "unlicense", "https://www.gnu.org/licenses/gpl-3.0.html": "gpl-3.0", "the MIT student": "", "apache helicopter": "", "an epl match": "",
    "You should have received a copy of the GNU Affero General Public License": "agpl", "Unauthorized copying of this file, via any medium is strictly prohibited": "proprietary", "MPL2 or EPL v2": "mpl-2.0",
}


def test_hand_written_rules(spark):
    rows = list(enumerate(SAID))
    got = {r["doc_id"]: r["labels"] for r in licenses.scanned(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    said = {text: got[k] for k, text in rows}
    assert said == SAID
    for k, text in rows:
        assert tuple(licenses.scanned(spark.createDataFrame([(k, text)], "doc_id long, text string")).first())[1:] == brute(text)


def test_plain_strings_before_the_gate_lose_nothing():
    parts = re.split(r"\|(?![^(]*\))", licenses.GATE)
    texts = [*TEXTS, *SAID, "covered with x", "redistributed according to", "MS-PL", "Ofl 1.1", "proprietary and confidential"]
    for text in texts:
        words = " ".join(WORD.findall(text.translate(LOWER)))
        if re.search(licenses.GATE, words):
            assert any(x in f" {words} " for x in licenses.GATE_STRINGS), text
    assert len(parts) > 20


def test_resolution_is_by_priority(spark):
    matches = [(0, -10, 5, "a", 0.1), (2, -4, 6, "b", 0.2), (8, -12, 1, "c", 0.3), (20, -30, 2, "d", 0.4), (21, -22, 3, "e", 0.5), (29, -40, 4, "f", 0.6), (30, -35, 9, "g", 0.7), (40, -41, 8, "h", 0.8)]
    rows = spark.createDataFrame([(matches,)], f"m array<{licenses.MATCH}>")
    labels, score = rows.select(licenses._resolved(F.array_sort("m")).alias("r")).select("r.*").first()
    assert sorted(labels) == ["b", "c", "d", "g", "h"] and score == 0.8
    assert rows.select(licenses._resolved(F.array_sort(F.slice("m", 1, 0))).alias("r")).select("r.*").first() == ([], 0.0)


def test_labels_name_the_version(spark):
    rows = [(k, t) for k, t in enumerate(TEXTS)]
    got = {r["doc_id"]: r["labels"].split(",") for r in licenses.scanned(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == ["gpl", "gpl-3.0"] and got[1] == ["cc-by", "cc-by-nc-4.0"] and "apache-2.0" in got[3]
    assert got[6] == ["cc-by-sa-4.0"] and got[4] == ["mit"] and got[8] == [""]


def test_native_and_without_shuffle(spark, edge_docs, no_docs):
    plan = licenses.scanned(edge_docs.select("*", F.lit(1).alias("found")))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan.split("InMemoryTableScan")[0])
    assert licenses.scanned(no_docs).count() == 0
