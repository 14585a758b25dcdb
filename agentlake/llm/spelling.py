"""Spelling variants: words one edit apart, by asymmetric chunks.

The shorter word of a pair (the earlier one, if both are as long) contributes its
two halves, which are disjoint: one edit leaves one of them as it is. The other
word contributes its positional grams of that size, at shift nought and one, for
the lengths that a partner may have. Halves alone can be common, so a half is
joined together with either half of the rest, of which one edit leaves one as
well. Joined pairs are verified in the join itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agentlake.llm.text import ascii_lower
from agentlake.session import written

#: Fixed value: the letters of a word, after A-Z became a-z.
LETTERS = "[a-zÀ-ÿ]+"

#: One run in so many loses a letter; least letters and occurrences of a word;
#: how many times as frequent a word's form is.
EVERY = 199
LEAST_LETTERS = 6
LEAST_COUNT = 5
TIMES = 5


def count_words(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    every: int = EVERY,
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """(word, n) of all texts: lower-cased (A-Z) runs of ``LETTERS``.

    Where ``every`` divides the crc32 of ``<doc_id>:<run>``, the run loses the
    letter that the crc32 modulo its length names. A NULL id counts as empty.
    """
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("key")
    lowered = ascii_lower(F.coalesce(F.col(text), F.lit("")))
    runs = docs.select(key, F.explode(F.regexp_extract_all(lowered, F.lit(LETTERS), F.lit(0))).alias("run"))
    code = F.crc32(F.concat("key", F.lit(":"), "run").cast("binary")).alias("code")
    coded = runs.filter(F.char_length("run") >= least_letters).select("run", code)
    at = (F.col("code") % F.char_length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    words = coded.select(F.when(F.col("code") % every == 0, less).otherwise(F.col("run")).alias("word"))
    counts = words.filter(F.char_length("word") >= least_letters).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") >= least_count)


def _grams(word: Column, size: Column, shift: int) -> Column:
    """What a partner of ``size`` letters must share: (kind, gram) four times.

    Kinds 0 and 1 keep the partner's second half, ``shift`` further on, and a
    half of its first half; kinds 2 and 3 keep its first half and a half of the
    second. ``size`` tells where a gram falls apart, so it is part of the key.
    """
    half = F.floor(size / 2).cast("int")
    first, second = F.floor(half / 2).cast("int"), half + F.floor((size - half) / 2).cast("int")

    def part(begin: Column, end: Column) -> Column:
        return F.substring(word, begin + 1, end - begin)

    zero = F.lit(0)
    grams = [
        F.concat(part(first + shift, half + shift), part(half + shift, size + shift)),
        F.concat(part(zero, first), part(half + shift, size + shift)),
        F.concat(part(zero, half), part(second + shift, size + shift)),
        F.concat(part(zero, half), part(half, second)),
    ]
    return F.array(*[F.struct(F.lit(kind).alias("kind"), gram.alias("gram")) for kind, gram in enumerate(grams)])


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n): each pair of words exactly one insertion,
    deletion or replacement apart once, the shorter or earlier first."""
    size = F.char_length("word")

    def keyed(partner: Column, shift: int) -> DataFrame:
        grams = words.select("word", "n", partner.alias("size"), F.explode(_grams(F.col("word"), partner, shift)).alias("g"))
        return grams.select("word", "n", "size", "g.kind", "g.gram", F.lit(shift).alias("shift"))

    chunks = keyed(size, 0).drop("shift")
    grams = keyed(size, 0).unionByName(keyed(size - 1, 1)).withColumnsRenamed({"word": "other", "n": "other_n"})
    keys = ["size", "kind", "gram"]
    left, right = chunks.alias("l"), grams.alias("r")
    joined = left.join(
        right,
        [
            *[F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys],
            (F.col("shift") == 1) | (F.col("word") < F.col("other")),
            F.levenshtein("word", "other", 1) == 1,
        ],
    )
    # Where a letter is doubled, an insertion leaves more than one kind whole.
    return joined.select("word", "n", "other", "other_n").distinct()


def spelling_groups(words: DataFrame, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a table (word, n) of distinct words.

    A word's form is its near word of largest n (ties: the smallest in
    code-point order), if that is at least ``times`` (2 or more) its own n. The
    root is the last word that following forms reaches. n grows from form to
    form, so there are no circles, and doubling steps reach every root in as
    many rounds as the longest way's length has bits. No words give no rows.
    """
    words, _, _ = written(words.select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    pairs, _, _ = written(near_pairs(words), "spelling-pairs")
    back = pairs.select(F.col("other").alias("word"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    both = pairs.select("word", "other", "other_n").unionByName(back)
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other"))
    near = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    form_n = -F.col("best.less")
    formed = F.coalesce(form_n >= times * F.col("n"), F.lit(False))
    judged, _, _ = written(
        words.join(near, "word", "left").select(
            "word",
            F.when(formed, F.col("best.other")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(formed, form_n).alias("form_n"),
        ),
        "spelling-forms",
    )
    ways, more = judged.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), True
    while more:
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = ways.join(further, "root", "left")
        moved = step.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        ways, _, more = written(moved, "spelling-roots", where=F.col("moved"))
        ways = ways.drop("moved")
    rooted = judged.join(ways, "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", times: int = TIMES, **limits: int) -> DataFrame:
    """``spelling_groups`` of ``count_words``.

    NULL and empty texts hold no words; rows that share an id or a text each
    count; only the two named columns are read. No rows give no rows.
    """
    return spelling_groups(count_words(docs, doc_id, text, **limits), times)
