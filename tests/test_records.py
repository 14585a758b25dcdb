from __future__ import annotations

import random
import re

from agentlake.operators.records import ANY, log_records, log_templates, with_records

PYTHON = [
    "start", "Traceback (most recent call last):", '  File "a.py", line 1', "    x()", "KeyError: 'k'", "",
    "During handling of the above exception, another exception occurred:", "", "Traceback (most recent call last):",
    '  File "b.py", line 2', "ValueError: bad", "next line",
]
JAVA = [
    "ERROR boom", "java.lang.RuntimeException: a", "\tat x.Y.z(Y.java:1)", "Caused by: java.io.IOException: b",
    "\tat x.Y.w(Y.java:2)", "\t... 3 more", "INFO goes on",
]

KEYED = "namespace string, pod string, container string, line_no long, line string"


def lines(spark, *texts, extra=()):
    rows = [("n", f"p{i}", "c", at, line) for i, text in enumerate(texts) for at, line in enumerate(text, 1)]
    return spark.createDataFrame([*rows, *extra], KEYED)


def plain_records(text):
    """The rule of ``with_records``, one line after the other."""
    found, before, after_inner = [], "", False
    for at, line in enumerate(text, 1):
        line = line or ""
        inner = line == "" or line[0].isspace()
        if inner:
            kind = None
        elif line.startswith("Traceback"):
            kind = "trace"
        elif line.startswith(("During handling of the above", "The above exception was the direct")):
            kind = "link"
        elif line.startswith(("Caused by:", "Suppressed:")):
            kind = "cause"
        else:
            kind = "plain"
        closes = before == "trace" and after_inner
        if at == 1 or (kind == "plain" and not closes) or (kind == "trace" and before != "link"):
            found.append([])
        found[-1].append(at)
        before, after_inner = kind or before, inner
    return {at: record[0] for record in found for at in record}


def test_traces_are_one_record(spark):
    found = {(r.pod, r.first_line): r for r in log_records(lines(spark, PYTHON, JAVA)).collect()}
    assert sorted(found) == [("p0", 1), ("p0", 2), ("p0", 12), ("p1", 1), ("p1", 2), ("p1", 7)]
    chained = found["p0", 2]
    assert (chained.last_line, chained.lines, chained.frames, chained.severity) == (11, 10, 3, "stack_trace")
    assert chained.head.startswith("Traceback") and chained.cause == "ValueError: bad"
    java = found["p1", 2]
    assert (java.lines, java.frames, java.cause) == (5, 3, "Caused by: java.io.IOException: b")
    assert found["p1", 1].severity == "error" and found["p1", 7].severity == "info"


def test_records_do_not_depend_on_blocks(spark):
    draw = random.Random(5)
    pieces = [*PYTHON, *JAVA, None, "plain", "  inner"]
    texts = [[draw.choice(pieces) for _ in range(draw.randint(1, 60))] for _ in range(12)]
    # One pod owns most lines.
    texts.append([draw.choice(pieces) for _ in range(900)])
    expected = {(f"p{i}", at): head for i, text in enumerate(texts) for at, head in plain_records(text).items()}
    table = lines(spark, *texts).repartition(7)
    for block_rows in (1, 3, 100_000):
        got = with_records(table, block_rows=block_rows).collect()
        assert {(r.pod, r.line_no): r.record for r in got} == expected
        assert len(got) == len(expected)


def test_records_of_odd_tables(spark):
    assert log_records(lines(spark, [])).count() == 0
    null_key = [(None, None, None, 1, "a"), (None, None, None, 2, None), (None, None, None, 3, "b")]
    found = log_records(lines(spark, extra=null_key).selectExpr("*", "'x' as record", "1 as head"), block_rows=1)
    assert sorted((r.first_line, r.lines, r.frames, r.cause) for r in found.collect()) == [(1, 2, 0, "a"), (3, 1, 0, "b")]


def plain_templates(texts, depth, most):
    """Words of every line, merged level by level with plain sets."""
    masked = [re.sub(r"[0-9]+(\.[0-9]+)*", "<n>", t).strip().split() or [""] for t in texts]
    variants = {}
    for words in masked:
        variants.setdefault(tuple(words), 0)
        variants[tuple(words)] += 1
    rows = {words: [list(words), n] for words, n in variants.items()}
    for level in range(depth):
        below = {}
        for words, _ in rows.values():
            if len(words) > level:
                below.setdefault((len(words), *words[:level]), set()).add(words[level])
        for words, _ in rows.values():
            if len(words) > level and len(below[(len(words), *words[:level])]) > most:
                words[level] = ANY
    places = {}
    for words, _ in rows.values():
        for at in range(depth, len(words)):
            places.setdefault((len(words), *words[:depth], "at", at), set()).add(words[at])
    counted = {}
    for words, n in rows.values():
        whole = [
            ANY if at >= depth and len(places[(len(words), *words[:depth], "at", at)]) > most else word
            for at, word in enumerate(words)
        ]
        have = counted.setdefault(" ".join(whole), [0, 0])
        have[0] += n
        have[1] += 1
    return {key: tuple(have) for key, have in counted.items()}


def test_templates_of_unequal_values_merge(spark):
    names = ["ann", "bob", "cy", "dan", "eve"]
    texts = [f"login of {n} from host-{i}" for i, n in enumerate(names)] + ["login ok", "login ok", "logout ok"]
    found = log_templates(spark.createDataFrame([(t,) for t in texts], "line string"), max_children=3)
    assert sorted(tuple(r) for r in found.collect()) == [
        ("login of <*> from host-<n>", 5, 5), ("login ok", 2, 1), ("logout ok", 1, 1),
    ]


def test_templates_equal_plain_version(spark):
    draw = random.Random(3)
    words = ["a", "b", "c", "d", "e", "f", "7", "x9"]
    texts = [" ".join(draw.choice(words[: draw.randint(1, 8)]) for _ in range(draw.randint(1, 6))) for _ in range(400)]
    texts += ["hot " + draw.choice(words)] * 300 + ["", "  "]
    table = spark.createDataFrame([(t,) for t in texts], "line string").repartition(5)
    for depth, most in ((0, 2), (2, 3), (4, 1), (3, 100)):
        got = {r.template: (r.lines, r.variants) for r in log_templates(table, depth=depth, max_children=most).collect()}
        assert got == plain_templates(texts, depth, most)


def test_templates_of_odd_tables(spark):
    empty = spark.createDataFrame([], "pod string, line string, template string, lines long")
    assert log_templates(empty, ["pod"]).count() == 0
    odd = spark.createDataFrame([(None, None), (None, ""), ("p", "x 1"), ("p", "x 2")], "pod string, line string")
    found = log_templates(odd, ["pod"]).collect()
    assert sorted((r.pod or "", r.template, r.lines, r.variants) for r in found) == [("", "", 2, 1), ("p", "x <n>", 2, 1)]
