"""Eligibility rules found from answers, against the gates planted in them."""

from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from panelloom.operators import gates as GT

SCHEMA = "role string, manager boolean, colour string, a1 string, a2 string, b1 string, c1 string"
BLOCKS = {"a": ["a1", "a2"], "b": ["b1"], "c": ["c1"]}
GATES = ["role", "manager", "colour"]


def survey(n=3000, noise=0.0, seed=1):
    """Block a is closed to interns and blank roles, block b to managers, block c to whoever did not answer a."""
    r = random.Random(seed)
    people = []
    for _ in range(n):
        role, manager, colour = r.choice(["dev", "ops", "intern", None]), r.choice([True, False, None]), r.choice(["red", "blue"])
        a = role in ("dev", "ops") and r.random() < 0.9 or r.random() < noise
        b = manager is not True and r.random() < 0.8
        c = a and r.random() < 0.7
        people.append((role, manager, colour, "1" if a and r.random() < 0.5 else None, "0" if a else None, "1" if b else None, "x" if c else None))
    return people


def plain_rules(people, support, confidence):
    blanks = {b: [] for b in BLOCKS}
    for p in people:
        for b, answered in zip(BLOCKS, (p[3] or p[4], p[5], p[6])):
            blanks[b].append(not answered)
    found = []
    for b, blank in blanks.items():
        for g, name in enumerate(GATES):
            per = {}
            for p, x in zip(people, blank):
                value = None if p[g] is None else str(p[g]).lower() if isinstance(p[g], bool) else p[g]
                per.setdefault(value, []).append(x)
            if not any(len(x) >= support and sum(x) / len(x) < confidence for x in per.values()):
                continue
            found += [(b, name, v, len(x), sum(x) / len(x), sum(x) / sum(blank)) for v, x in per.items() if len(x) >= support and sum(x) / len(x) >= confidence]
    return found


@pytest.mark.parametrize(("noise", "confidence"), [(0.0, 0.99), (0.004, 0.99), (0.05, 0.99), (0.05, 0.9)])
def test_rules_are_the_planted_gates(spark, noise, confidence):
    people = survey(noise=noise)
    counts = GT.answered_counts(spark.createDataFrame(people, SCHEMA).repartition(5), GATES, BLOCKS)
    got = rows(GT.gate_rules(counts, GATES, list(BLOCKS), 30, confidence))
    assert got == sorted(plain_rules(people, 30, confidence), key=lambda x: tuple((v is not None, str(v)) for v in x))
    if noise < 0.01 or confidence < 0.95:
        assert {x[:3] for x in got} == {("a", "role", "intern"), ("a", "role", None), ("b", "manager", "true"), ("c", "role", "intern"), ("c", "role", None)}


def test_implications(spark):
    people = survey()
    counts = GT.answered_counts(spark.createDataFrame(people, SCHEMA), GATES, BLOCKS)
    got = GT.block_implications(counts, list(BLOCKS)).collect()
    both = [p for p in people if p[6]]
    assert [(r["block"], r["implied"], r["support"], r["confidence"]) for r in got] == [("c", "a", len(both), 1.0)]


def test_rows_are_told_apart_by_the_rules(spark):
    df = spark.createDataFrame(survey(), SCHEMA)
    rules = GT.rules_of(GT.gate_rules(GT.answered_counts(df, GATES, BLOCKS), GATES, list(BLOCKS)), "a")
    assert rules == [("role", None), ("role", "intern")] or rules == [("role", "intern"), ("role", None)]
    assert df.where(GT.shown(rules)).where("role is null or role = 'intern'").count() == 0
    assert df.where(~GT.shown(rules)).where(F.col("a2").isNotNull()).count() == 0
    assert df.where(GT.shown([])).count() == df.count()


def test_few_rows_and_no_rows_give_no_rule(spark):
    df = spark.createDataFrame(survey(20), SCHEMA)
    assert GT.gate_rules(GT.answered_counts(df, GATES, BLOCKS), GATES, list(BLOCKS)).count() == 0
    assert GT.gate_rules(GT.answered_counts(df.where("false"), GATES, BLOCKS), GATES, list(BLOCKS)).count() == 0
    with pytest.raises(ValueError):
        GT.answered_counts(df, GATES, {f"b{i}": ["a1"] for i in range(63)})
