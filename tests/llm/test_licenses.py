"""License scan: hand-made notices, odd texts against a plain scan in Python, and long texts."""

import random
import re

import pytest
from pyspark.sql import functions as F

from hammerline.llm import license_rules
from hammerline.llm.license_rules import BASE, BASE_PHRASES, build_rules, longest
from hammerline.llm.license_scan import op12_license_scan, scan_licenses

NAMES = "doc_id n_words n_base first_word last_word base_labels labels score".split()


def brute(doc_id, text, rules):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    base, found = [], []
    for phrase, label in BASE_PHRASES:
        own = phrase.split()
        base += [(i, label) for i in range(len(words)) if words[i : i + len(own)] == own]
    reach = longest(rules)
    for i, word in enumerate(words):
        ahead = " ".join(words[i : i + reach]) + " "
        for r in rules:
            if r.keyword == word and (m := re.match(r.regex, ahead)):
                found.append((i, i + m.group().count(" "), r))
    kept = []
    for start, end, r in found:
        others = [(s, e, o) for s, e, o in found if s <= start and e >= end]
        better = any(o.priority < r.priority or o.priority == r.priority and (e - s > end - start or (s, e) == (start, end) and o.number < r.number) for s, e, o in others)
        if r.priority == BASE or not better:
            kept.append(r)
    starts = [i for i, _ in base]
    labels = ",".join(sorted({r.label for r in kept}))
    score = max((r.weight for r in kept), default=0.0)
    return (doc_id, len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in base})), labels, score)


def check(spark, rows):
    rules = build_rules()
    found = op12_license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((tuple(r[n] for n in NAMES) for r in found), key=repr) == sorted((brute(d, t, rules) for d, t in rows), key=repr)


def labels(spark, texts):
    rows = op12_license_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return [r["labels"] for r in sorted(rows, key=lambda r: r["doc_id"])]


def test_notices(spark):
    texts = {
        "Licensed under the Apache License, Version 2.0.": "apache-2.0",
        "Released under the MIT License.": "mit",
        "Licensed under CC BY-NC 4.0.": "cc-by,cc-by-nc-4.0",
        "This work is licensed under the GNU General Public License, version 3.": "gpl,gpl-3.0",
        "All rights reserved.": "reserved",
        "// SPDX-License-Identifier: GPL-2.0-or-later": "gpl-2.0-or-later",
        "SPDX-License-Identifier: BSD-3-Clause": "bsd-3-clause",
        "License: MPL 2.0": "mpl-2.0",
        "GNU Lesser General Public License v2.1": "gpl,lgpl-2.1",
        "see https://creativecommons.org/licenses/by-sa/4.0/ for it": "cc-by-sa-4.0",
        "a walk in the park with mit and isc students under the apache tree": "",
        "the general public was there, all of them": "",
        "Dies ist ein Text über Rechte und Lizenzen": "",
    }
    assert dict(zip(texts, labels(spark, list(texts)))) == texts


def test_containment_and_priority(spark):
    text = "Licensed under the Apache License, Version 2.0 (the License)"
    row = scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    kept = [(d["start"], d["end"], d["label"]) for d in row["detections"] if d["kept"]]
    assert kept == [(0, 8, "apache-2.0")] and len(row["detections"]) > 1


def test_random_texts(spark):
    """Words of the rules in random order and places, whole notices between them."""
    some = random.Random(11)
    rules = build_rules()
    vocabulary = sorted({w.rstrip("?") for label, p, _ in license_rules.NOTICES for t in p.split() for w in t.split("|")} - {"*"})
    names = [n.replace("?", "").split("|")[0] for _, _, n in license_rules.LICENSES] + [p for p, _ in BASE_PHRASES]
    texts = []
    for _ in range(150):
        parts = [some.choice([some.choice(vocabulary), some.choice(names), "Licensed under the " + some.choice(names), "É KK", "all rights"]) for _ in range(some.randint(1, 25))]
        texts.append("".join(p.upper() + some.choice([" ", ", ", "-\n", "."]) if some.random() < 0.2 else p + " " for p in parts))
    assert len(rules) > 300 and all(len(re.findall(r.regex, "")) == 0 for r in rules)
    check(spark, list(enumerate(texts)))


def test_odd_texts(spark):
    long_text = "cc by " * 30_000 + "word " * 100_000 + "licensed under the mit license " * 3000
    check(spark, [(1, None), (2, ""), (3, " .,;\x00"), (4, "cc"), (4, "cc by"), (4, "cc by"), (None, "CC-BY"), (5, "x,all\nRights  reserved"), (6, "cc by "), (7, "ccby cc by")])
    row = op12_license_scan(spark.createDataFrame([(1, long_text)], "doc_id long, text string")).first()
    assert (row["n_words"], row["n_base"], row["last_word"], row["labels"]) == (175_000, 30_000, 59_998, "cc-by,mit")


def test_empty_and_extra_columns(spark):
    assert op12_license_scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    docs = spark.createDataFrame([(1, "MIT License")], "doc_id long, text string").withColumns({c: F.lit("own") for c in ("n_words", "words", "detections", "label", "_scan")})
    row = scan_licenses(docs).first()
    assert row["n_words"] == 2 and row["words"] == "own" and row["detections"][0]["label"] == "mit"


@pytest.mark.parametrize("pattern, text, hit", [("a b? c|d", "a c ", True), ("a b? c|d", "a b d ", True), ("a b? c|d", "a b ", False), ("x *? y", "x q y ", True), ("x 19*", "x 1987 ", True)])
def test_patterns(pattern, text, hit):
    assert bool(re.match(license_rules.compiled(pattern), text)) is hit


def test_no_python_in_the_plan(spark):
    plan = op12_license_scan(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
