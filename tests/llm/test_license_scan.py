"""Licence finds in made-up texts, and accuracy on notices that were kept out of training."""

import random

import pytest

from closeworks.llm import license_scan as L

SCHEMA = "doc_id long, text string"


def plain_texts():
    r = random.Random(2)
    words = "river stone walk evening light paper window garden under with the and of a market train letter winter".split()
    return [(i, "\n".join(" ".join(r.choice(words) for _ in range(12)) + "." for _ in range(6))) for i in range(80)]


@pytest.fixture(scope="module")
def model(spark):
    return L.fit(spark.createDataFrame(plain_texts(), SCHEMA))


def test_finds(spark, model):
    docs = [
        (1, "A walk.\n\nThis software is released under the MIT License, see the file.\nThe end of the walk."),
        (2, "LICENSED UNDER THE APACHE LICENSE, VERSION 2.0."),
        (3, "Licensed under CC BY-NC 4.0.\r\nthe river and the stone"),
        (4, "under the window with the letter of the market"),
        (5, None),
        (6, ""),
        (None, "All rights reserved."),
        (2, "All rights reserved."),
        (2, "All rights reserved."),
    ]
    rows = L.find_licences(spark.createDataFrame(docs, SCHEMA), classifier=model).collect()
    got = sorted((str(r["doc_id"]), r["paragraph"], r["family"], r["confirmed"]) for r in rows)
    assert got == [
        ("1", 2, "mit", True),
        ("2", 0, "apache-2.0", True),
        ("2", 0, "reserved", True),
        ("2", 0, "reserved", True),
        ("3", 0, "cc-by-nc", True),
        ("None", 0, "reserved", True),
    ]


def test_held_out_notices(spark, model):
    said = {
        "mit": ["The code is licensed under the MIT license.", "Distributed under the terms of the MIT License."],
        "gpl": ["Licensed under the GNU General Public License v3.", "It is covered by the GNU General Public License."],
        "apache-2.0": ["Available under the Apache License.", "You may obtain it under the Apache License Version 2.0 terms."],
        "mpl-2.0": ["Subject to the Mozilla Public License.", "Under the Mozilla Public License, v. 2.0."],
    }
    docs = [(i, line) for i, line in enumerate(x for lines in said.values() for x in lines)]
    expected = [family for family, lines in said.items() for _ in lines]
    rows = L.find_licences(spark.createDataFrame(docs, SCHEMA), classifier=model).collect()
    found = {r["doc_id"]: r["family"] for r in rows}
    assert sum(found.get(i) == f for i, f in enumerate(expected)) >= 7


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at"""
GPL = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
SAID = [
    ("mit", MIT.replace("\n", " ")),
    ("apache-2.0", APACHE.replace("\n#", "")),
    ("gpl", GPL),
    ("mit", "Copyright 2021 Some Body. Released under the MIT License. See LICENSE in the root of the project for details."),
    ("reserved", "Copyright (c) 1998-2024 The Very Long Name of Some Company and its Subsidiaries Ltd. All rights reserved."),
    ("mit", MIT),
    ("apache-2.0", "# " + APACHE),
    ("mit", "the river and the stone\nReleased under the\nMIT License.\nthe window and the letter"),
]


def test_notices_in_long_lines_and_over_several_lines_are_confirmed(spark, model):
    rows = L.find_licences(spark.createDataFrame([(i, t) for i, (_, t) in enumerate(SAID)], SCHEMA), classifier=model).collect()
    assert {i for i, (family, _) in enumerate(SAID) if (i, family, True) in {(r["doc_id"], r["family"], r["confirmed"]) for r in rows}} == set(range(len(SAID))), rows


def test_plain_paragraphs_are_unknown(spark, model):
    others = [(i, t.replace("river", "bridge")) for i, t in plain_texts()]
    assert L.find_licences(spark.createDataFrame(others, SCHEMA), classifier=model).count() == 0


def test_no_rows(spark):
    assert L.find_licences(spark.createDataFrame([], SCHEMA)).collect() == []
