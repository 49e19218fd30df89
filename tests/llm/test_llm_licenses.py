"""License scan against plain Python, the edge cases of its docstring, and its signature rules."""

import re

import pytest
from pyspark.sql import functions as F

from recordsync.llm import license_scan
from recordsync.llm.license_rules import CONFIDENCE, REACH, rules

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def plain_spans(words):
    found = []
    for at, w in enumerate(words):
        before = words[max(0, at - REACH):at]
        said = " " + " ".join(before + [">" + w] + words[at + 1:at + 1 + REACH]) + " "
        for r in rules():
            m = re.search(r.pattern, said) if r.keyword == w else None
            if m:
                start = at - len(before) + said[:m.start()].count(" ")
                found.append((start, start + m.group().count(" ") - 1, r.level, r.order, r.label, r.base))
    return found


def plain(text):
    words = WORD.findall((text or "").translate(LOWER))
    found = plain_spans(words)
    kept = [a for a in found if not any(
        b[0] <= a[0] and b[1] >= a[1] and b[2] <= a[2] and (b[1] - b[0] > a[1] - a[0] or b[2] < a[2] or b[3] < a[3])
        for b in found)]
    base = [f for f in found if f[5]]
    starts = [f[0] for f in base]
    return (len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted({f[4] for f in base})),
            ",".join(sorted({f[4] for f in base + kept})), max((CONFIDENCE[f[2]] for f in kept), default=0.0))


TEXTS = [None, "", " \n.", "MIT License", "mit-license, Apache license; General  Public License!", "the mit license mit license",
         "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
         "with the License.", "SPDX-License-Identifier: GPL-3.0-or-later", "SPDX-License-Identifier: MIT\nmit license",
         "This work is licensed under the GNU General Public License, version 3.", "GNU Lesser General Public License v2.1",
         "licensed under CC BY-NC 4.0", "Wir gehen mit der Lizenz. mit licenses", "license", "émit license mité license",
         "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
         "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote",
         "MİT LICENSE", "general public", "x " * 5000 + "mit license " * 3000 + "general public license"]


def test_scan_is_plain_python(spark):
    rows = [(i if i % 3 else None, t) for i, t in enumerate(TEXTS + TEXTS[3:6])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash")).withColumn("own", F.lit(1))
    out = license_scan.scan(df)
    assert out.columns == ["doc_id", "own", *license_scan.MADE]
    got = sorted((tuple(r) for r in out.drop("own").collect()), key=repr)
    assert got == sorted(((d, *plain(t)) for d, t in rows), key=repr)


def test_base_labels_stay_and_lesser_ones_are_suppressed(spark):
    df = spark.createDataFrame([(1, "under the GNU Lesser General Public License v2.1 or later")], "doc_id long, text string")
    row = license_scan.scan(df).first()
    assert (row.base_labels, row.labels) == ("gpl", "gpl,lgpl-2-1")
    told = license_scan.detections(license_scan.detected(df))
    assert {r.label for r in told.where("kept").collect()} == {"lgpl-2-1"} and told.where("NOT kept").count() >= 2


def test_empty_table(spark):
    assert license_scan.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_rules_are_ordered_and_within_reach():
    table = rules()
    assert len(table) > 300 and [r.order for r in table] == list(range(len(table)))
    assert [r.level for r in table] == sorted(r.level for r in table)
    for r in table:
        widest = re.sub(r"\(\?: \[\^ \]\+\)\{\d,(\d)\}", lambda m: " w" * int(m.group(1)), r.pattern)
        assert all(side.count(" ") <= REACH for side in widest.split(">")), r


@pytest.mark.parametrize("text,label", [
    ("Redistribution and use in source and binary forms, with or without modification, are permitted", "bsd"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
    ("http://creativecommons.org/licenses/by-nc-sa/4.0", "cc-by-nc-sa"), ("under the Mozilla Public License, v. 2.0", "mpl"),
    ("the GNU Affero General Public License version 3", "agpl-3"), ("all rights reserved. Unauthorized copying", "proprietary"),
    ("the Elastic License 2.0", "elastic"), ("Eclipse Public License v2.0", "epl-2"), ("GPLv3", "gpl-3"), ("3-Clause BSD", "bsd-3")])
def test_known_notices(text, label):
    assert label in plain(text)[5].split(",")
