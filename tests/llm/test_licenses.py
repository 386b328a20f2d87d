import random
import re
from re import _parser as widths

from gitloom.llm import licenses, scan_queries
from tests.llm import brute

SAMPLES = [
    "Licensed under CC BY-NC 4.0.", "cc by nc cc by nc, CC-BY-NC-SA", "Released under the MIT License.",
    "under the MIT license under the mit license", "Licensed under the Apache License, Version 2.0.",
    "GNU Lesser General Public License v2.1 or (at your option) any later version",
    "licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-or-later",
    "https://creativecommons.org/licenses/by-nc-sa/4.0/", "Dieses Werk steht mit Creative Commons BY",
    "This is free and unencumbered software released into the public domain.", "mit license", "submit licenses",
    "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "Alle Rechte vorbehalten", "tous droits réservés", "(c) 2020. All rights reserved.", "GPLv3", "the gpl v 3 or later",
]


def expected(text):
    """All rules over the whole line, and suppression by looking at every pair."""
    words = brute.benchmark_words(text)
    line = "".join(f" {w} " for w in words)
    found = []
    for i, rule in enumerate(licenses.RULES):
        for m in re.finditer(rule.regex, line):
            first = line.count(" ", 0, m.start()) // 2
            found.append((first, first + m.group().count(" ") // 2, i))
    stay = [
        (a, b, i)
        for a, b, i in found
        if licenses.RULES[i].kind == "base" or not any(j < i and c <= a and d >= b for c, d, j in found)
    ]
    return len(words), sorted(stay)


def base_places(words):
    """Places of the base phrases, by comparing words."""
    places = []
    for label, phrase in licenses.BASE:
        p = phrase.split()
        places += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    return sorted(places)


def _texts():
    rng = random.Random(11)
    fill = "the mit und mit license of public domain by nc version 2 3 gnu x é1 cc apache under".split()
    texts = [None, "", "...", *SAMPLES]
    for _ in range(120):
        parts = [rng.choice(SAMPLES) if rng.random() < 0.3 else rng.choice(fill) for _ in range(rng.randint(1, 40))]
        texts.append(rng.choice([" ", "\n", ", "]).join(parts).swapcase() if rng.random() < 0.3 else " ".join(parts))
    texts += ["word " * 400_000 + SAMPLES[0] + " tail " * 300 + SAMPLES[2], "mit " * 5000 + "license", "x" * 300_000]
    return texts


def test_equals_every_rule_over_the_whole_text(spark):
    texts = _texts()
    rows = [(i % 50, t, "clash") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Licenses string")
    found = licenses.scan_licenses(docs).collect()
    assert len(found) == len(texts) and found[0].asDict().keys() == {"doc_id", "text", "n_words", "licenses"}
    for r in found:
        n, stay = expected(r["text"])
        assert r["n_words"] == n
        got = [(d["first_word"], d["first_word"] + d["n_words"], d["rule"]) for d in r["licenses"]]
        assert sorted(got) == stay, r["text"][:300]
        words = brute.benchmark_words(r["text"])
        for d in r["licenses"]:
            covered = brute.benchmark_words(r["text"][d["start"] : d["end"]])
            assert covered == words[d["first_word"] : d["first_word"] + d["n_words"]]
            assert d["label"] == licenses.RULES[d["rule"]].label
        base = sorted((d["first_word"], d["label"]) for d in r["licenses"] if d["kind"] == "base")
        assert base == base_places(words)
    assert licenses.scan_licenses(docs.limit(0)).count() == 0
    nothing = licenses.scan_licenses(docs, rules=())
    assert nothing.where("size(licenses) > 0").isEmpty() and nothing.count() == len(texts)


def test_rules_are_bounded_and_hold_a_keyword():
    assert len(licenses.RULES) > 300
    for rule in licenses.RULES:
        assert widths.parse(rule.regex.encode()).getwidth()[1] < licenses.REACH, rule
    # Keywords decide nothing: whatever a rule finds in the samples has one of them.
    lines = [licenses.spaced((t or "").encode()).decode() for t in _texts()[:150]]
    for rule in licenses.RULES:
        for line in lines:
            for m in re.finditer(rule.regex, line):
                assert any(k.replace(" ", "  ") in m.group() for k in rule.keywords), rule


def test_labels_of_notices():
    scanner = licenses.Scanner(licenses.RULES)

    def labels(text):
        return {licenses.RULES[i].label for _, _, i in scanner.detections(licenses.spaced(text.encode()))}

    assert labels(SAMPLES[0]) == {"cc-by-nc"}
    assert labels("Licensed under CC BY-NC-ND 4.0") == {"cc-by-nc", "cc-by-nc-nd"}  # the base phrase stays
    assert labels(SAMPLES[5]) == {"lgpl-2.1-or-later"}
    assert labels(SAMPLES[6]) == {"gpl-3"}
    assert labels(SAMPLES[10]) == {"unlicense"}
    assert labels("He came with the by law to submit an old licence plate.") == set()


def test_query_without_rows(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert scan_queries.op11_license_scans(spark, str(tmp_path)).count() == 0
    assert scan_queries.op12_periodic_runs(spark, str(tmp_path)).count() == 0
