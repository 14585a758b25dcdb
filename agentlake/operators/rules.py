"""Many rules against many lines: a join by pattern without comparing each pair.

Every match of a pattern holds some literal that the pattern requires. One
automaton finds the literals of all rules in a line at once; only rules of which
a literal was found are matched, in the JVM, by their pattern. Patterns that
require none are matched with every line.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from math import ceil

import ahocorasick
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agentlake.session import written

#: Letters of the literals in one automaton, which every task holds.
AUTOMATON_LETTERS = 4_000_000

_parser = re._parser


def required_literals(pattern: str) -> list[str]:
    """Literals of which every match holds at least one, case folded.

    An empty list means that none is known: the pattern may match without any,
    or says something that Python does not read.
    """
    try:
        return _needed(_parser.parse(pattern, re.IGNORECASE))
    except (re.error, RecursionError, OverflowError):
        return []


def _needed(parsed) -> list[str]:
    """The choice of literals whose shortest one is longest."""
    choices, run = [], []

    def end_run() -> None:
        if run:
            choices.append(["".join(run).casefold()])
            run.clear()

    for op, value in parsed:
        name = str(op)
        if name == "LITERAL":
            run.append(chr(value))
            continue
        end_run()
        if name == "SUBPATTERN":
            choices.append(_needed(value[-1]))
        elif name == "BRANCH":
            branches = [_needed(b) for b in value[1]]
            choices.append([x for b in branches for x in b] if all(branches) else [])
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and value[0] > 0:
            choices.append(_needed(value[2]))
        elif name == "ATOMIC_GROUP":
            choices.append(_needed(value))
    end_run()
    return max((c for c in choices if c and all(c)), key=lambda c: min(map(len, c)), default=[])


def _finder(literals: list[tuple[str, int]], always: list[int]) -> Callable[[str], list[int]]:
    """A function line -> numbers of the rules that may match it."""
    owners: dict[str, list[int]] = {}
    for literal, number in literals:
        owners.setdefault(literal, []).append(number)
    automaton = ahocorasick.Automaton()
    for literal, numbers in owners.items():
        automaton.add_word(literal, numbers)
    if owners:
        automaton.make_automaton()

    def find(line: str) -> list[int]:
        found = set(always)
        if owners:
            for _, numbers in automaton.iter(line.casefold()):
                found.update(numbers)
        return sorted(found)

    return find


def _candidates(shared: Broadcast):
    @F.pandas_udf("array<long>")
    def candidates(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        find = _finder(*shared.value)
        for texts in batches:
            yield texts.map(find)

    return candidates


def match_rules(
    lines: DataFrame, rules: DataFrame, line: str = "line", pattern: str = "pattern", automaton_letters: int = AUTOMATON_LETTERS
) -> DataFrame:
    """Every rule that each line meets: the line's columns, then the rule's.

    Equal to a join on ``line rlike pattern``. Lines are scanned where they are
    read. The literals are measured first; beyond ``automaton_letters`` the rules
    are cut into parts, each with an automaton of its own. NULL lines and
    patterns meet nothing; repeated lines and rules each count.
    """

    @F.pandas_udf("array<string>")
    def needed(patterns: pd.Series) -> pd.Series:
        return patterns.map(required_literals)

    own = rules.filter(F.col(pattern).isNotNull()).select("*", F.monotonically_increasing_id().alias("_rule"))
    table, _, some = written(own.withColumn("_literals", needed(pattern)), "rules")
    named = lines.select(F.struct("*").alias("_row")).filter(F.col(f"_row.{line}").isNotNull())
    if not some:
        return named.join(table.limit(0), F.lit(False), "inner").select("_row.*", *rules.columns)
    letters = F.aggregate("_literals", F.lit(1).cast("long"), lambda n, x: n + F.char_length(x))
    parts = max(1, ceil(table.agg(F.sum(letters)).first()[0] / automaton_letters))
    whole = None
    for part in range(parts):
        chosen = table.filter(F.pmod(F.xxhash64("_rule"), F.lit(parts)) == part)
        # About ``automaton_letters`` letters at a time.
        rows = chosen.select("_rule", "_literals").collect()
        shared = lines.sparkSession.sparkContext.broadcast(
            ([(x, r["_rule"]) for r in rows for x in r["_literals"]], [r["_rule"] for r in rows if not r["_literals"]])
        )

        found = named.select("_row", F.explode(_candidates(shared)(f"_row.{line}")).alias("_rule"))
        hits = found.join(chosen.drop("_literals"), "_rule").filter(F.expr(f"_row.`{line}` rlike `{pattern}`"))
        hits = hits.select("_row.*", *[F.col(f"`{c}`") for c in rules.columns])
        whole = hits if whole is None else whole.unionByName(hits)
    return whole
