"""License scans with ordered signature rules, as DataFrame functions only.

A text becomes its lower-cased words joined by one space. Fixed base phrases
are counted wherever their words stand consecutively. Beside them a table of
some hundred regular expressions is applied: families of licenses, each with
names and versions, times the forms in which texts state them; and hand-written
rules for SPDX ids and expressions, glued versions (GPLv3), license addresses
and the words of notices. A rule is only tried on texts that have its keyword.
Detections are word intervals; taken by the rule's priority, longer before
shorter, one stays unless it lies inside, around or across one that stays
already. Only detections that hang together in the text are compared.

The whole scan is a narrow projection: no shuffle, no Python on the executors.
Texts without any of the gate's words skip the rules.

Null and empty texts have no words: counts 0, no first and last word, empty
labels, score 0. Repeated rows each give a row. Other columns do not matter.
"""

from __future__ import annotations

import json
from functools import lru_cache, reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import texts_of

#: Phrase and label.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: What stands between words of a text that is not lower-cased yet.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A text with none of these has no license statement; every rule and every
#: base phrase contains one.
GATE = (
    "licen[cs]e|(?:^| )cc |(?:^| )cc0(?: |$)|spdx|rights reserved|creative commons|public domain|permission is hereby|permission to use|redistribution and use|"
    "(?:released|distributed|available|published|provided|redistributed|covered) (?:under|by|with|according to) |"
    r"(?:^| )(?:[al]?gpl|mpl|epl|apache|eupl)v?(?: ?[0-9])|(?:^| )bsd [2-4] clause|(?:^| )(?:bsl|cddl|ofl|odbl|gfdl|artistic) [0-9]|(?:^| )ms pl |creativecommons org|opensource org|unlicense org|sil org|"
    "free software you can|use this file except|copy of the gnu|advertising materials|endorse or promote|provided as is|copyright holders and contributors|permission notice|"
    "not be misrepresented|unencumbered software|confidential and proprietary|proprietary and confidential|unauthori[sz]ed copying|may be reproduced"
)
#: Each text that the gate lets through has one of these in lower case after a
#: space before it; to look for plain strings first costs far less than the gate.
GATE_STRINGS = [
    "licen", " cc ", " cc0", "spdx", "rights reserved", "creative commons", "public domain", "permission is hereby", "permission to use", "redistribution and use",
    "released ", "distributed ", "available ", "published ", "provided ", "covered ", " gpl", " lgpl", " agpl", " mpl", " epl", " apache", " eupl", " bsd ", " bsl ", " cddl ", " ofl ", " odbl ", " gfdl ",
    " artistic ", " ms pl ", "creativecommons org", "opensource org", "unlicense org", "sil org", "free software you can", "use this file except", "copy of the gnu", "advertising materials",
    "endorse or promote", "copyright holders and contributors", "permission notice", "not be misrepresented", "unencumbered software", "confidential and proprietary", "proprietary and confidential",
    "unauthori", "may be reproduced",
]

#: Families: label, keyword (every name has it at the start of a word), names in words, versions ("" is no version).
FAMILIES = [
    ("apache", "apache", ["apache", "apache software"], ["", "1.0", "1.1", "2.0"]),
    ("apache", "asl", ["asl"], ["", "1.0", "1.1", "2.0"]),
    ("mit", "mit", ["mit", "mit x11", "mit expat"], [""]),
    ("bsd-2-clause", "bsd", ["bsd 2 clause", "simplified bsd", "two clause bsd"], [""]),
    ("bsd-2-clause", "freebsd", ["freebsd"], [""]),
    ("bsd-3-clause", "bsd", ["bsd 3 clause", "new bsd", "modified bsd", "revised bsd", "three clause bsd"], [""]),
    ("bsd-4-clause", "bsd", ["bsd 4 clause", "original bsd"], [""]),
    ("bsd", "bsd", ["bsd", "bsd style"], [""]),
    ("isc", "isc", ["isc"], [""]),
    ("gpl", "gpl", ["gpl", "gnu gpl"], ["", "1.0", "2.0", "3.0"]),
    ("gpl", "gnu", ["gnu general public"], ["", "1.0", "2.0", "3.0"]),
    ("lgpl", "lgpl", ["lgpl", "gnu lgpl"], ["", "2.0", "2.1", "3.0"]),
    ("lgpl", "gnu", ["gnu lesser general public", "gnu library general public"], ["", "2.0", "2.1", "3.0"]),
    ("agpl", "agpl", ["agpl", "gnu agpl"], ["", "1.0", "3.0"]),
    ("agpl", "affero", ["gnu affero general public", "affero general public"], ["", "1.0", "3.0"]),
    ("gfdl", "gnu", ["gnu free documentation", "gnu fdl"], ["", "1.1", "1.2", "1.3"]),
    ("mpl", "mozilla", ["mozilla public"], ["", "1.0", "1.1", "2.0"]),
    ("mpl", "mpl", ["mpl"], ["", "1.0", "1.1", "2.0"]),
    ("epl", "eclipse", ["eclipse public"], ["", "1.0", "2.0"]),
    ("cddl", "development and distribution", ["common development and distribution"], ["", "1.0", "1.1"]),
    ("eupl", "union public", ["european union public"], ["", "1.0", "1.1", "1.2"]),
    ("artistic", "artistic", ["artistic", "perl artistic"], ["", "1.0", "2.0"]),
    ("zlib", "zlib", ["zlib", "zlib libpng"], [""]),
    ("bsl", "boost", ["boost software"], ["", "1.0"]),
    ("ofl", "open font", ["sil open font", "open font"], ["", "1.0", "1.1"]),
    ("ms-pl", "microsoft public", ["microsoft public"], [""]),
    ("psf", "python", ["python software foundation"], ["", "2.0"]),
    ("odbl", "open database", ["open data commons open database", "open database"], ["", "1.0"]),
    ("unlicense", "unlicense", ["the unlicense", "unlicense"], [""]),
    ("wtfpl", "wtfpl", ["wtfpl"], ["", "2.0"]),
    ("postgresql", "postgresql", ["postgresql"], [""]),
]

#: Creative Commons: label's parts, words, and the same in full.
COMMONS = [
    ("by", "by", "attribution"),
    ("by-sa", "by sa", "attribution share ?alike"),
    ("by-nd", "by nd", "attribution no ?deriv(?:ative)?s"),
    ("by-nc", "by nc", "attribution non ?commercial"),
    ("by-nc-sa", "by nc sa", "attribution non ?commercial share ?alike"),
    ("by-nc-nd", "by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s"),
]
COMMONS_VERSIONS = ["", "1.0", "2.0", "2.5", "3.0", "4.0"]

#: Forms of a statement: how sure it is, and the expression around the name.
VERB = "(?:licensed|released|distributed|available|published|provided|redistributed|covered|made available|dual licensed)"
FORMS = [
    (0.98, "spdx license identifier {name}(?: only| or later)?"),
    (0.95, VERB + " (?:under|by|with|according to) (?:the )?(?:terms (?:and conditions )?of (?:the )?)?{name}"),
    (0.90, "{name} (?:license|licence)"),
    (0.85, "(?:license|licence) (?:is |type )?{name}"),
]
OTHERS = [
    ("cc0", "cc0", 0.95, "cc0(?: 1 0)?(?: universal)?(?: public domain dedication)?"),
    ("cc0", "zero", 0.95, "creative commons zero(?: v?1 0)?"),
    ("public-domain", "public domain", 0.8, "(?:dedicated to|released (?:in)?to|placed in|in) the public domain"),
    ("proprietary", "rights reserved", 0.7, "all rights reserved"),
    ("mit", "permission", 0.95, "permission is hereby granted free of charge to any person obtaining a copy(?: of this software)?"),
    ("bsd", "redistribution", 0.9, "redistribution and use in source and binary forms with or without modification are permitted"),
    ("isc", "permission", 0.9, "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
]

#: SPDX ids that say enough by themselves, as words.
SPDX_IDS = {
    "apache-1.1": "apache 1 1", "apache-2.0": "apache 2 0", "agpl-3.0": "agpl 3 0", "artistic-1.0": "artistic 1 0", "artistic-2.0": "artistic 2 0",
    "bsd-2-clause": "bsd 2 clause", "bsd-3-clause": "bsd 3 clause", "bsd-4-clause": "bsd 4 clause", "bsl-1.0": "bsl 1 0", "cc0": "cc0 1 0", "cddl-1.0": "cddl 1 0", "cddl-1.1": "cddl 1 1",
    "epl-1.0": "epl 1 0", "epl-2.0": "epl 2 0", "eupl-1.1": "eupl 1 1", "eupl-1.2": "eupl 1 2", "gfdl-1.2": "gfdl 1 2", "gfdl-1.3": "gfdl 1 3", "gpl-1.0": "gpl 1 0", "gpl-2.0": "gpl 2 0", "gpl-3.0": "gpl 3 0",
    "lgpl-2.0": "lgpl 2 0", "lgpl-2.1": "lgpl 2 1", "lgpl-3.0": "lgpl 3 0", "mpl-1.1": "mpl 1 1", "mpl-2.0": "mpl 2 0", "ms-pl": "ms pl", "odbl-1.0": "odbl 1 0", "ofl-1.1": "ofl 1 1",
}
#: SPDX ids that are plain words: only beside one of the above in an expression.
SPDX_WORDS = {"mit": "mit", "isc": "isc", "zlib": "zlib", "unlicense": "unlicense"}
#: Names that versions are glued to, as in GPLv3, LGPLv2.1 or Apache2.
GLUED = {"gpl": ["1.0", "2.0", "3.0"], "lgpl": ["2.0", "2.1", "3.0"], "agpl": ["3.0"], "mpl": ["1.1", "2.0"], "apache": ["2.0"], "epl": ["1.0", "2.0"], "eupl": ["1.1", "1.2"]}
#: Addresses of license texts, as words: label, keyword, expression.
ADDRESSES = [
    ("apache-2.0", "apache org", "apache org licenses license 2 0"), ("apache-1.1", "apache org", "apache org licenses license 1 1"),
    ("mit", "opensource org", "opensource org licenses? mit(?: license)?"), ("bsd-2-clause", "opensource org", "opensource org licenses? bsd 2 clause"), ("bsd-3-clause", "opensource org", "opensource org licenses? bsd 3 clause"),
    ("isc", "opensource org", "opensource org licenses? isc(?: license)?"), ("zlib", "opensource org", "opensource org licenses? zlib(?: license)?"), ("apache-2.0", "opensource org", "opensource org licenses? apache 2 0"),
    ("gpl-2.0", "gnu org", "gnu org (?:licenses|copyleft)(?: old licenses)? gpl 2 0"), ("gpl-3.0", "gnu org", "gnu org (?:licenses|copyleft) gpl 3 0"), ("gpl", "gnu org", "gnu org (?:licenses|copyleft) gpl"),
    ("lgpl-2.1", "gnu org", "gnu org (?:licenses|copyleft)(?: old licenses)? lgpl 2 1"), ("lgpl-3.0", "gnu org", "gnu org (?:licenses|copyleft) lgpl 3 0"), ("lgpl", "gnu org", "gnu org (?:licenses|copyleft) lgpl"),
    ("agpl-3.0", "gnu org", "gnu org licenses agpl 3 0"), ("gfdl", "gnu org", "gnu org (?:licenses|copyleft) fdl(?: 1 [23])?"), ("mpl-1.1", "mozilla org", "mozilla org mpl(?: mpl)? 1 1"), ("mpl-2.0", "mozilla org", "mozilla org(?: en us| media)? mpl(?: mpl)? 2 0"),
    ("epl-1.0", "eclipse org", "eclipse org legal epl v?1 ?0"), ("epl-2.0", "eclipse org", "eclipse org legal epl (?:v?2 ?0|2 0)"), ("bsl-1.0", "boost org", "boost org license 1 0"), ("ofl-1.1", "sil org", "sil org ofl"),
    ("unlicense", "unlicense org", "unlicense org"), ("cc0", "creativecommons org", "creativecommons org publicdomain zero 1 0"), ("public-domain", "creativecommons org", "creativecommons org publicdomain mark 1 0"),
]
#: What license texts and file headers say: label, keyword, sureness, expression.
NOTICES = [
    ("apache", "you may not use", 0.9, "you may not use this file except in compliance with the license"),
    ("apache", "licensed to the", 0.9, "licensed to the apache software foundation(?: asf)? under one or more contributor license agreements"),
    ("gpl", "this program", 0.9, "this (?:program|file|software) is free software you can redistribute it(?: and or modify it)?(?: under the terms of the gnu general public license)?"),
    ("lgpl", "this library", 0.9, "this library is free software you can redistribute it(?: and or modify it)?(?: under the terms of the gnu (?:lesser|library) general public license)?"),
    ("gpl", "received a copy", 0.9, "received a copy of the gnu general public license(?: along with this program)?"),
    ("lgpl", "received a copy", 0.9, "received a copy of the gnu (?:lesser|library) general public license(?: along with this library)?"),
    ("agpl", "received a copy", 0.9, "received a copy of the gnu affero general public license(?: along with this program)?"),
    ("mpl-2.0", "this source code form", 0.95, "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("epl", "this program and", 0.9, "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("cddl", "subject to the terms", 0.9, "subject to the terms of the common development and distribution license"),
    ("bsd-3-clause", "contributors may be", 0.9, "names? of (?:its|the|their) contributors may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", "all advertising", 0.9, "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd", "this software is provided", 0.8, "this software is provided by the copyright holders and contributors as is"),
    ("mit", "the software is provided", 0.8, "the software is provided as is without warranty of any kind express or implied"),
    ("mit", "the above copyright", 0.9, "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("zlib", "this software is provided", 0.9, "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("zlib", "the origin of", 0.9, "the origin of this software must not be misrepresented"),
    ("unlicense", "this is free", 0.95, "this is free and unencumbered software released into the public domain"),
    ("bsl", "permission", 0.95, "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("isc", "permission", 0.9, "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted"),
    ("proprietary", "confidential and", 0.7, "(?:proprietary and confidential|confidential and proprietary)"),
    ("proprietary", "copying of this file", 0.8, "unauthori[sz]ed copying of this file via any medium is strictly prohibited"),
    ("proprietary", "no part of", 0.7, "no part of this (?:publication|book|work|document) may be reproduced"),
]


def _hand_written() -> list[tuple[bool, float, str, str, float, str]]:
    tail = "(?: only| or later)?"
    beside = "|".join(i + t for i in SPDX_IDS.values() for t in ("", " only", " or later"))
    found = [(False, -0.9, label, words, 0.9, words + tail) for label, words in SPDX_IDS.items()]
    for label, word in SPDX_WORDS.items():
        found.append((True, -0.9, label, word, 0.9, f"{word}(?= (?:or|and) (?:{beside}) )"))
        # the word first: what stands before it is looked at only where it occurs
        found.append((True, -0.9, label, word, 0.9, f"{word}(?<= (?:{beside}) (?:or|and) {word})"))
    for name, versions in GLUED.items():
        for version in versions:
            major, minor = version.split(".")
            found.append((False, -0.9, f"{name}-{version}", name, 0.9, f"{name}v?{major}" + ("(?: 0|(?! [0-9] ))" if minor == "0" else f" {minor}") + tail))
    found += [(False, -0.97, label, keyword, 0.97, form) for label, keyword, form in ADDRESSES]
    for part, words, _ in COMMONS:
        for version in COMMONS_VERSIONS[1:]:
            found.append((False, -0.97, f"cc-{part}-{version}", "creativecommons org", 0.97, f"creativecommons org licenses {words} {version.replace('.', ' ')}(?: (?:deed|legalcode))?"))
    return found + [(True, -sure, label, keyword, sure, form) for label, keyword, sure, form in NOTICES]


def _version(version: str) -> str:
    """Words of a version after a name; 2.0 is also 2, but not the start of 2.1."""
    if not version:
        return ""
    major, minor = version.split(".")
    return f" (?:version |v |ver )?v?{major}" + ("(?: 0|(?! [0-9] ))" if minor == "0" else f" {minor}")


@lru_cache(1)
def rules() -> tuple[tuple[int, str, str, float, str], ...]:
    """Priority (less is better), label, keyword, sureness, expression. Rules
    with a version come before those without, surer forms before others."""
    found = []
    for label, keyword, names, versions in FAMILIES:
        name = "(?:" + "|".join(names) + ")(?: public)?"
        for version in versions:
            full = f"{label}-{version}" if version else label
            for sure, form in FORMS:
                plain = form.format(name=name + _version(version))
                found.append((not version, -sure, full, keyword, sure, plain))
                if version and form.startswith(("{name}", VERB)):  # "name license, version 2.0"
                    found.append((not version, -sure, full, keyword, sure, form.format(name=name + " (?:license|licence)").removesuffix(" (?:license|licence)") + _version(version)))
    for part, words, full_name in COMMONS:
        for version in COMMONS_VERSIONS:
            label = f"cc-{part}" + (f"-{version}" if version else "")
            for sure, keyword, name in ((0.95, "cc by", "cc " + words), (0.95, "creative commons", "creative commons " + full_name)):
                found.append((not version, -sure, label, keyword, sure, f"(?:{VERB} under )?(?:an? |the )?{name}(?: international| unported)?" + _version(version) + "(?: international| unported)?(?: license| licence)?"))
    for label, keyword, sure, form in OTHERS:
        found.append((True, -sure, label, keyword, sure, form))
    found += _hand_written()
    found.sort(key=lambda x: (x[0], x[1], -len(x[5]), x[2], x[5]))
    return tuple((k, label, keyword, sure, form) for k, (_, _, label, keyword, sure, form) in enumerate(found))


def _rule_table() -> Column:
    """The rules as one constant array."""
    table = [{"priority": p, "label": label, "keyword": f" {keyword}", "sure": sure, "form": f"(?<= )({form})(?= )"} for p, label, keyword, sure, form in rules()]
    return F.from_json(F.lit(json.dumps(table)), "array<struct<priority: int, label: string, keyword: string, sure: double, form: string>>")


def _spaces(text: Column) -> Column:
    return (F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def _intervals(words: Column, rule: Column) -> Column:
    """Start and end word (from 0, end not included) of a rule's matches.
    words: the marked text's words after a first one that is no word."""
    first = F.filter(F.transform(words, lambda w, i: F.when(F.startswith(w, F.lit("<")), i - 1)), lambda i: i.isNotNull())
    last = F.filter(F.transform(words, lambda w, i: F.when(F.endswith(w, F.lit(">")), i)), lambda i: i.isNotNull())
    return F.zip_with(first, last, lambda a, b: F.struct(a.alias("start"), (-b).alias("minus_end"), rule["priority"].alias("priority"), rule["label"].alias("label"), rule["sure"].alias("sure")))


MATCH = "struct<start: int, minus_end: int, priority: int, label: string, sure: double>"
RANKED = "struct<priority: int, minus_length: int, start: int, minus_end: int, label: string, sure: double>"


def _kept(cluster: Column) -> Column:
    """Of detections that hang together, by priority, those that overlap none
    that was kept before."""
    ranked = F.array_sort(F.transform(cluster, lambda x: F.struct(x["priority"], (x["start"] + x["minus_end"]).alias("minus_length"), x["start"], x["minus_end"], x["label"], x["sure"])))
    meets = lambda x, y: (x["start"] < -y["minus_end"]) & (y["start"] < -x["minus_end"])
    return F.aggregate(ranked, F.array().cast(f"array<{RANKED}>"), lambda kept, x: F.when(F.exists(kept, lambda y: meets(x, y)), kept).otherwise(F.concat(kept, F.array(x))))


def _resolved(matches: Column) -> Column:
    """labels and score of the detections that stay. matches: sorted by start."""
    state = lambda cluster, end, labels, score: F.struct(cluster.alias("cluster"), end.alias("end"), labels.alias("labels"), score.alias("score"))
    none = F.array().cast(f"array<{MATCH}>")

    def closed(s: Column) -> tuple[Column, Column]:
        """labels and score with those of the open cluster."""
        one, kept = s["cluster"][0], _kept(s["cluster"])
        labels = F.when(F.size(s["cluster"]) == 0, s["labels"]).when(F.size(s["cluster"]) == 1, F.array_union(s["labels"], F.array(one["label"]))).otherwise(F.array_union(s["labels"], F.transform(kept, lambda x: x["label"])))
        score = F.when(F.size(s["cluster"]) == 0, s["score"]).when(F.size(s["cluster"]) == 1, F.greatest(s["score"], one["sure"])).otherwise(F.greatest(s["score"], F.array_max(F.transform(kept, lambda x: x["sure"]))))
        return labels, score

    def step(s: Column, m: Column) -> Column:
        more = state(F.concat(s["cluster"], F.array(m)), F.greatest(s["end"], -m["minus_end"]), s["labels"], s["score"])
        return F.when(m["start"] < s["end"], more).otherwise(state(F.array(m), -m["minus_end"], *closed(s)))

    def finish(s: Column) -> Column:
        labels, score = closed(s)
        return F.struct(labels.alias("labels"), score.alias("score"))

    return F.aggregate(matches, state(none, F.lit(0), F.array().cast("array<string>"), F.lit(0.0)), step, finish)


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score (the surest detection; a base phrase alone gives 0.6)."""
    out = texts_of(docs, id_col, text_col)
    out = out.select("doc_id", F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), SEPARATORS, " ")).alias("words"))
    low = F.concat(F.lit("| "), F.translate("words", UPPER, LOWER), F.lit(" "))
    out = out.select("doc_id", "words", F.concat(F.lit(" "), F.lower("words"), F.lit(" ")).alias("plain"))
    near = reduce(or_, [F.contains(F.col("plain"), F.lit(x)) for x in GATE_STRINGS])
    out = out.select("doc_id", F.when(F.col("words") == "", F.lit(0).cast("long")).otherwise(_spaces(F.col("words")) + 1).alias("n_words"), F.when(near & F.rlike("words", F.lit("(?i)" + GATE)), low).alias("low"))
    # each piece after the first starts with the phrase
    pieces = [F.split("low", f"(?= {phrase} )", -1).alias(f"p{k}") for k, phrase in enumerate(BASE)]
    tried = F.filter(_rule_table(), lambda r: F.contains(F.col("low"), r["keyword"]) & F.rlike(F.col("low"), r["form"]))
    marked = lambda r: F.split(F.regexp_replace(F.col("low"), r["form"], F.lit("<$1>")), " ")
    matches = F.array_sort(F.flatten(F.transform(tried, lambda r: _intervals(marked(r), r))))
    out = out.select("doc_id", "n_words", *pieces, F.when(F.col("low").isNotNull(), _resolved(matches)).alias("found"))
    n = len(BASE)
    count = [F.coalesce(F.size(f"p{k}") - 1, F.lit(0)) for k in range(n)]
    count = [F.when(F.col(f"p{k}").isNull(), 0).otherwise(F.size(f"p{k}") - 1) for k in range(n)]
    first = [F.when(count[k] > 0, _spaces(F.get(f"p{k}", F.lit(0)))) for k in range(n)]
    last = [F.when(count[k] > 0, F.col("n_words") + 1 - _spaces(F.element_at(f"p{k}", -1))) for k in range(n)]
    base = F.filter(F.array(*[F.when(c > 0, F.lit(label)) for c, label in zip(count, BASE.values(), strict=True)]), lambda x: x.isNotNull())
    own = F.coalesce(F.col("found.labels"), F.array().cast("array<string>"))
    return out.select(
        "doc_id",
        "n_words",
        sum(count[1:], count[0]).cast("long").alias("n_base"),
        F.least(*first).alias("first_word"),
        F.greatest(*last).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, own)), ",").alias("labels"),
        F.greatest(F.coalesce(F.col("found.score"), F.lit(0.0)), F.when(F.size(base) > 0, 0.6).otherwise(0.0)).alias("score"),
    )
