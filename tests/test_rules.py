"""Rules found by their literals equal the plain join by pattern."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from agentlake.operators.rules import match_rules, required_literals


@pytest.mark.parametrize(
    "pattern,literals",
    [
        ("(?i)OOMKilled|out of memory", ["oomkilled", "out of memory"]), (r"\bdb-17\b", ["db-17"]), ("a+bcd?", ["bc"]), ("(ab|c)?x", ["x"]),
        ("(foo|ba+r)[0-9]", ["foo", "b"]), ("[ab]*", []), ("", []), ("a|", []), (r"\p{L}+", []), (r"\Qa.b\E", []), ("(?:ab){2,}c", ["ab"]),
        ("(?!secret)plain", ["plain"]), ("STRASSE", ["strasse"]),
    ],
)
def test_literals_that_a_match_must_hold(pattern, literals):
    assert sorted(required_literals(pattern)) == sorted(literals)


@pytest.mark.parametrize("letters", [4_000_000, 200])
def test_rules_equal_the_plain_join(spark, letters):
    rng = random.Random(2)
    words = ["error", "ERROR", "db-7", "db-77", "OOMKilled", "pod", "Σίσυφος", "ok", "a.b", "warn"]
    lines = [(i, " ".join(rng.choices(words, k=rng.randint(0, 6)))) for i in range(150)] + [(900, None), (901, "db-7"), (901, "db-7")]
    patterns = [r"(?i)\berror\b", r"db-7\b", r"db-7[0-9]", "OOMKilled|out of memory", r"\p{L}+-\d", "a.b", r"\Qa.b\E", "(?i)ΣΊΣΥΦΟΣ", "^$", "(ok|pod) +warn", None]
    patterns += [f"db-{k}( |$)" for k in range(60)] + ["db-7"] * 2
    rules = spark.createDataFrame([(f"r{i}", p) for i, p in enumerate(patterns)], "category string, pattern string").repartition(3)
    table = spark.createDataFrame(lines, "line_no long, line string").repartition(4)
    plain = table.join(rules, F.expr("line rlike pattern")).select("line_no", "line", "category", "pattern")
    found = match_rules(table, rules, automaton_letters=letters)
    assert found.columns == plain.columns and Counter(map(tuple, found.collect())) == Counter(map(tuple, plain.collect()))


def test_no_rules_and_no_lines(spark):
    table = spark.createDataFrame([("a",)], "line string")
    rules = spark.createDataFrame([("c", "a")], "category string, pattern string")
    assert match_rules(table, rules.filter("false")).collect() == []
    assert match_rules(table.filter("false"), rules).collect() == []
