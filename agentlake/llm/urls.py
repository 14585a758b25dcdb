"""URL filter: rules by host and path, and a character language-model ratio.

Two smoothed variable-order Markov models, of accepted and of rejected URLs,
give a log-likelihood difference per character. Its cut is calibrated on
labelled URLs that the models have not seen.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from math import log2

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agentlake.llm.text import ascii_lower, row_of

#: Longest context in characters, and labelled URLs of each side that are fitted.
ORDER = 5
FIT_URLS = 10_000
#: Smallest number of labelled URLs of a side; with fewer the models say allow.
LEAST = 20
ALPHABET = 256


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z) and path; both empty without ``://``."""
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + F.lit(3), F.char_length(text))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.char_length(host) + F.lit(1), F.char_length(rest)), "^[^?#]*", 0)
    return ascii_lower(host), path


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(pattern, verdict) of the longest rule that fits, else NULLs.

    A rule (verdict, "host/path") fits its host and every subdomain where the
    path starts with the rule's. Of equally long ones the first in code-point
    order wins.
    """
    pattern, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for word, text in sorted(rules, key=lambda r: (len(r[1]), r[1][::-1])):
        name, slash, tail = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + tail))
        pattern, verdict = F.when(fits, F.lit(text)).otherwise(pattern), F.when(fits, F.lit(word)).otherwise(verdict)
    return pattern, verdict


class Markov:
    """Variable-order character model with Witten-Bell backoff.

    P(c | context) = (n(context c) + kinds(context) * P(c | shorter)) /
    (n(context) + kinds(context)); the empty context backs off to uniform.
    """

    def __init__(self, order: int = ORDER):
        self.order = order
        self.counts: dict[str, dict[str, int]] = defaultdict(dict)
        self.totals: dict[str, int] = defaultdict(int)

    def learn(self, url: str) -> None:
        padded = "\x02" * self.order + url + "\x03"
        for i in range(self.order, len(padded)):
            for k in range(self.order + 1):
                context, char = padded[i - k : i], padded[i]
                row = self.counts[context]
                row[char] = row.get(char, 0) + 1
                self.totals[context] += 1

    def bits(self, url: str) -> float:
        """log2 likelihood of a URL and its end."""
        padded, total = "\x02" * self.order + url + "\x03", 0.0
        counts, totals = self.counts, self.totals
        for i in range(self.order, len(padded)):
            char, p = padded[i], 1.0 / ALPHABET
            for k in range(self.order + 1):
                row = counts.get(padded[i - k : i])
                if row is None:
                    break
                kinds = len(row)
                p = (row.get(char, 0) + kinds * p) / (totals[padded[i - k : i]] + kinds)
            total += log2(p)
        return total


def calibrated(accepted: np.ndarray, rejected: np.ndarray) -> float:
    """The cut with the best mean of both recalls; midway among equals."""
    values = np.unique(np.concatenate([accepted, rejected]))
    cuts = np.concatenate([[values[0] - 1.0], (values[1:] + values[:-1]) / 2, [values[-1] + 1.0]])
    kept = 1 - np.searchsorted(np.sort(accepted), cuts, "left") / len(accepted)
    gone = np.searchsorted(np.sort(rejected), cuts, "left") / len(rejected)
    score = kept + gone
    best = np.flatnonzero(score >= score.max() - 1e-12)
    return float(cuts[best[len(best) // 2]])


def fit(labelled: DataFrame, fit_urls: int = FIT_URLS, order: int = ORDER, least: int = LEAST) -> dict | None:
    """Models and cut from rows (url, verdict), or None with fewer than ``least``
    URLs of a side.

    About ``fit_urls`` distinct URLs of each verdict are chosen by hash, that
    bound being the only data that reaches the driver. Every fifth of them
    calibrates the cut and is not learned.
    """
    rows = labelled.filter(F.col("url").isNotNull() & F.col("verdict").isNotNull()).distinct()
    sizes = {r["verdict"]: r["n"] for r in rows.groupBy("verdict").agg(F.count(F.lit(1)).alias("n")).collect()}
    if min(sizes.get("allow", 0), sizes.get("block", 0)) < max(least, 1):
        return None
    draw = F.pmod(F.xxhash64("url", F.lit("fit")), F.lit(1 << 20))
    rate = F.when(F.col("verdict") == "allow", fit_urls / sizes["allow"]).otherwise(fit_urls / sizes["block"])
    chosen = rows.filter(draw < rate * (1 << 20)).select(
        "url", "verdict", (F.pmod(F.xxhash64("url", F.lit("held")), F.lit(5)) == 0).alias("held")
    ).collect()
    models = {"allow": Markov(order), "block": Markov(order)}
    for r in sorted(chosen, key=lambda r: (r["verdict"], r["url"])):
        if not r["held"]:
            models[r["verdict"]].learn(r["url"])
    model = {"allow": models["allow"], "block": models["block"], "cut": 0.0}
    held = {v: np.array([ratio(model, r["url"]) for r in chosen if r["held"] and r["verdict"] == v]) for v in models}
    if len(held["allow"]) and len(held["block"]):
        model["cut"] = calibrated(held["allow"], held["block"])
    return model


def ratio(model: dict, url: str) -> float:
    """Log-likelihood difference per character, in bits."""
    return (model["allow"].bits(url) - model["block"].bits(url)) / (len(url) + 1)


def filter_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]],
    url: str = "url",
    out: str = "url_filter",
    fit_urls: int = FIT_URLS,
    order: int = ORDER,
    least: int = LEAST,
) -> DataFrame:
    """Add ``out``: a struct (host, path, rule, score, verdict) per row.

    The longest fitting rule decides; all other URLs are allowed where the
    models' difference ``score`` reaches the calibrated cut. The rules' own
    verdicts are what the models learn from. A NULL URL is scored as an empty
    one. With fewer than ``least`` labelled URLs of a side there is no score and
    the verdict is allow. No shuffle over all rows; a column already named ``out`` is
    replaced.
    """
    host, path = host_and_path(F.col(url))
    pattern, verdict = matching_rule(host, path, rules)
    model = fit(pages.select(F.col(url).alias("url"), verdict.alias("verdict")), fit_urls, order, least)
    if model is None:
        score, said = F.lit(None).cast("double"), F.lit("allow")
    else:
        shared = pages.sparkSession.sparkContext.broadcast(model)

        @F.pandas_udf("double")
        def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            known = shared.value
            for urls in batches:
                yield pd.Series([ratio(known, u or "") for u in urls], dtype=float)

        score = scored(F.coalesce(F.col(url), F.lit("")))
        said = F.when(F.col("_score") >= model["cut"], F.lit("allow")).otherwise(F.lit("block"))
    named = {"_host": host, "_path": path, "_rule": pattern, "_said": verdict, "_score": score}
    ready = pages.select(row_of(pages).alias("_row"), *[value.alias(name) for name, value in named.items()])
    result = F.struct(
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("_rule").alias("rule"),
        F.col("_score").alias("score"),
        F.coalesce("_said", said).alias("verdict"),
    )
    columns = [F.col("_row")[c].alias(c) for c in pages.columns if c != out]
    return ready.select("_row", result.alias("_result")).select(*columns, F.col("_result").alias(out))
