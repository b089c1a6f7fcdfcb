"""Persons behind several identifiers, against a plain union of sets."""

import random

import pytest

from closeworks.operators import persons
from tests.helpers import rows


def plainly(arrays):
    groups = []
    for ids in arrays:
        met = [g for g in groups if g & set(ids)]
        groups = [g for g in groups if not g & set(ids)] + [set(ids).union(*met)]
    return {i: min(g) for g in groups for i in g}


@pytest.mark.parametrize("seed", [1, 2])
def test_as_sets_that_are_joined(spark, seed):
    r = random.Random(seed)
    several = [[f"C:{r.randrange(60):03d}", f"M:{r.randrange(70):03d}"][: r.choice([1, 2, 2])] for _ in range(70)] + [[], ["X:1"]]
    chain = [[f"K:{(k * 7) % 41:02d}", f"K:{((k + 1) * 7) % 41:02d}"] for k in range(40)] + [["K:00", "K:00"]]
    star = [["S:0", f"S:{k}"] for k in range(1, 60)]
    want = plainly([*several, *chain, *star])
    first = spark.createDataFrame(list(enumerate(several)), "n int, ids array<string>")
    second = spark.createDataFrame(list(enumerate(chain + star)), "n int, ids array<string>")
    for frame, arrays in zip(persons.with_person([first, second], "ids"), (several, chain + star)):
        assert frame.columns == ["n", "ids", "PESSOA"]
        assert sorted(rows(frame.select("n", "PESSOA"))) == [(k, want[ids[0]] if ids else None) for k, ids in enumerate(arrays)]


def test_nothing_to_link(spark):
    empty = spark.createDataFrame([], "n int, ids array<string>")
    alone = spark.createDataFrame([(1, ["a"]), (1, ["a"]), (2, None)], "n int, ids array<string>")
    got = persons.with_person([empty, alone], "ids")
    assert rows(got[0]) == [] and sorted(rows(got[1].select("n", "PESSOA"))) == [(1, "a"), (1, "a"), (2, None)]
