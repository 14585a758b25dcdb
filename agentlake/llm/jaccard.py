"""N-gram Jaccard join with a prefix tree.

Every set of n-grams is put in one global order, the rarest last. Two sets that
are similar enough share one of their last elements, which brings them into a
common bucket. In a bucket the sets form a trie, common elements first; a set
walks it from the root, keeps the overlap with all sets of a branch at once, and
leaves a branch when the elements that remain cannot reach the overlap needed.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, log

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agentlake.llm.components import components
from agentlake.llm.text import WordHashes, as_bytes, joined, packed, unpacked, words
from agentlake.operators.paging import skew_join
from agentlake.session import written

#: Counters of the sketch of n-gram frequencies, and elements of one trie task;
#: a set counts as SET_COST elements more.
SKETCH = 1 << 25
SKETCH_PARTS = 64
TASK_ELEMENTS = 500_000
SET_COST = 64
#: Bits of the filter that keeps texts without a bucket out of the shuffle, and
#: of an n-gram's hash inside a bucket.
FILTER_BITS = 1 << 24
BUCKET_BITS = np.uint64((1 << 48) - 1)


def distinct(codes: np.ndarray) -> np.ndarray:
    codes = np.sort(codes)
    first = np.ones(len(codes), bool)
    first[1:] = codes[1:] != codes[:-1]
    return codes[first]


def ngrams(raw: bytes, n: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-grams of words; a shorter text is
    one n-gram, a text without words none."""
    tokens = words(raw)
    if not tokens:
        return np.empty(0, np.uint64)
    h = hashes.of(tokens)
    size = min(n, len(h))
    code = h[: len(h) - size + 1]
    for k in range(1, size):
        code = joined(code, h[k : len(h) - size + 1 + k])
    return distinct(code)


def needed(size, percent: int):
    """Least overlap that a set needs with any partner."""
    return -(-percent * size // 100)


def bands(size: int, percent: int) -> list[tuple[int, int]]:
    """(size band, how many of the rarest elements) under which a set is listed.

    Sizes of linked sets differ by at most percent / 100, which is the width of
    a band, so partners are in one band or in neighbouring ones. A set is listed
    in its own band with what partners from the band below need, and in the next
    band with what the larger partners there need: the larger they are, the
    larger the overlap, and the fewer elements suffice.
    """
    if percent >= 100:
        return [(size, 1)]
    width = log(100 / percent) * (1 + 1e-9)
    band = int(log(size) / width)
    listed = [(band, size - needed(size, percent) + 1)]
    partner = max(size, int(exp((band + 1) * width) * (1 - 1e-6)))
    overlap = -(-percent * (size + partner) // (100 + percent))
    if overlap <= size:
        listed.append((band + 1, size - overlap + 1))
    return listed


def set_name(codes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(codes.tobytes())


def set_number(codes: np.ndarray) -> int:
    return int.from_bytes(set_name(codes)[:8], "little", signed=True)


def _planes(values: np.ndarray) -> bytes:
    """Whole numbers byte by byte, so that high zero bytes compress away."""
    return packed(np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T)


def _unplaned(raw: bytes, kind) -> np.ndarray:
    planes = unpacked(raw, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def short_set(codes: np.ndarray) -> bytes:
    """A set for a bucket: the gaps between its shortened hashes."""
    return _planes(np.diff(distinct(codes & BUCKET_BITS), prepend=np.uint64(0)))


def long_set(raw: bytes) -> np.ndarray:
    return np.cumsum(_unplaned(raw, np.uint64), dtype=np.uint64)


def ordered(codes: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """A set in the global order: falling frequency by the sketch, then hash."""
    return codes[np.lexsort((codes, 255 - sketch[(codes & np.uint64(len(sketch) - 1)).astype(np.int64)]))]


class Trie:
    """Compressed trie over ordered sets: the sets sorted, so that a branch is a
    range of them. Nodes are rows of arrays, children of a node side by side."""

    def __init__(self, sets: list[np.ndarray]):
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u4").tobytes())
        own = [sets[i] for i in self.order]
        self.sets = own
        shared = np.zeros(len(own), np.int64)
        for i in range(1, len(own)):
            k = min(len(own[i - 1]), len(own[i]))
            off = np.flatnonzero(own[i - 1][:k] != own[i][:k])
            shared[i] = off[0] if len(off) else k
        # (first set, end, depth of the parent, depth to which its sets agree,
        # first child, number of children)
        nodes, ranges = [], [(0, len(own), 0)]
        for low, high, above in ranges:
            if high - low == 1:
                nodes.append((low, high, above, len(own[low]), 0, 0))
                continue
            inner = shared[low + 1 : high]
            depth = int(inner.min())
            cuts = [low, *(np.flatnonzero(inner == depth) + low + 1).tolist(), high]
            nodes.append((low, high, above, depth, len(ranges), len(cuts) - 1))
            ranges += [(x, y, depth) for x, y in zip(cuts[:-1], cuts[1:])]
        self.low, self.high, self.above, self.depth, self.child, self.children = np.array(nodes, np.int64).T
        runs = [own[n[0]][n[2] : n[3]] for n in nodes]
        self.run = np.concatenate(runs)
        self.start = np.cumsum([0, *(len(r) for r in runs)])[:-1]
        self.last = np.array([own[n[0]][n[3] - 1] if n[3] else -1 for n in nodes], np.int64)
        sizes = np.array([len(s) for s in own])
        self.least = np.array([sizes[n[0] : n[1]].min() for n in nodes])
        self.most = np.array([sizes[n[0] : n[1]].max() for n in nodes])


def spans(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The whole numbers of all ranges, one range after the other."""
    end = np.cumsum(length)
    return np.repeat(start - end + length, length) + np.arange(end[-1] if len(end) else 0)


class Classes:
    """Union-find over 0..n-1; the smallest member stands for a class."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.members = {i: [i] for i in range(n)}

    def join(self, a: int, b: int) -> None:
        a, b = int(self.label[a]), int(self.label[b])
        if a == b:
            return
        if len(self.members[a]) < len(self.members[b]):
            a, b = b, a
        self.label[self.members[b]] = a
        self.members[a] += self.members.pop(b)


def linked_pairs(ranks: list[np.ndarray], percent: int, merge: Classes) -> int:
    """Find a spanning set of links among ordered sets by their trie.

    ``merge`` holds the classes found so far. A set walks the branches that hold
    sets after it, all nodes of one level at once, each with the overlap of its
    prefix. A branch is left when even its best size cannot reach the overlap
    needed with what remains, or when its sets all are in the walker's class, as
    their links would join nothing. Returns the number of pairs compared to the
    end.
    """
    trie, compared = Trie(ranks), 0
    number = np.array(trie.order)
    held = np.zeros(1 + max(int(s[-1]) for s in trie.sets), bool)
    label, changes = np.empty(0), np.empty(0)
    stale = True
    for at, own in enumerate(trie.sets):
        if stale:
            label = merge.label[number]
            changes = np.concatenate([[0], np.cumsum(label[1:] != label[:-1])])
            stale = False
        me, size = int(number[at]), len(own)
        least, most = needed(size, percent), 100 * size // percent
        held[own] = True
        level, overlap = np.zeros(1, np.int64), np.zeros(1, np.int64)
        while len(level):
            low, high = trie.low[level], trie.high[level]
            alike = (changes[high - 1] == changes[low]) & (label[low] == label[at])
            smallest, largest = np.maximum(trie.least[level], least), np.minimum(trie.most[level], most)
            on = (high - 1 > at) & ~alike & (smallest <= largest)
            level, overlap, smallest, largest = level[on], overlap[on], smallest[on], largest[on]
            length = trie.depth[level] - trie.above[level]
            hit = np.concatenate([[0], np.cumsum(held[trie.run[spans(trie.start[level], length)]])])
            end = np.cumsum(length)
            overlap = overlap + hit[end] - hit[end - length]
            # What is left of mine beyond this prefix, and the size for which
            # that is worth most.
            mine = size - np.searchsorted(own, trie.last[level], "right")
            best = np.clip(trie.depth[level] + mine, smallest, largest)
            possible = overlap + np.minimum(best - trie.depth[level], mine)
            on = 100 * possible >= percent * (size + best - possible)
            level, overlap = level[on], overlap[on]
            whole = trie.children[level] == 0
            compared += int(whole.sum())
            # For a whole set nothing remains, so the bound was the similarity.
            for other in number[trie.low[level[whole]]].tolist():
                merge.join(me, other)
                stale = True
            count = trie.children[level]
            overlap = np.repeat(overlap, count)
            level = spans(trie.child[level], count)
        held[own] = False
    return compared


def frequency_sketch(texts: DataFrame, n: int, sketch: int = SKETCH) -> np.ndarray:
    """How many texts hold an n-gram of each of ``sketch`` hash classes.

    One array per task is added up by Spark in parts; the driver gets one byte
    per class, a rising step of the count, whatever the table. The sketch only
    orders the n-grams.
    """
    part = sketch // SKETCH_PARTS

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, counts = WordHashes(300_000), np.zeros(sketch, np.int32)
        for batch in batches:
            for raw in batch["text"]:
                np.add.at(counts, (ngrams(raw, n, hashes) & np.uint64(sketch - 1)).astype(np.int64), 1)
        if counts.any():
            yield pd.DataFrame({"part": range(SKETCH_PARTS), "counts": [_planes(counts[i * part : (i + 1) * part]) for i in range(SKETCH_PARTS)]})

    def added(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, key = np.zeros(part, np.int64), None
        for frame in frames:
            for key, raw in zip(frame["part"], frame["counts"]):
                total += _unplaned(raw, np.int32)
        level = np.minimum(np.rint(12 * np.log2(1.0 + total)), 255).astype(np.uint8)
        yield pd.DataFrame({"part": [key], "counts": [packed(level)]})

    partial = texts.mapInPandas(counted, "part int, counts binary")
    rows = partial.groupBy("part").applyInPandas(added, "part int, counts binary").collect()
    whole = np.zeros(sketch, np.uint8)
    for r in rows:
        whole[r["part"] * part : (r["part"] + 1) * part] = unpacked(r["counts"], np.uint8)
    return whole


def jaccard_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    n: int = 3,
    percent: int = 90,
    task_elements: int = TASK_ELEMENTS,
    sketch: int = SKETCH,
) -> tuple[DataFrame, DataFrame]:
    """Documents grouped by links, and the links that were found between sets.

    Two documents link when 100 * intersection >= percent * union of their
    n-gram sets. Returns (doc_id, n_shingles, set_id, component_id) per row and
    (a, b): class representatives that a bucket's trie has joined, a spanning
    set of all links. Equal sets are one class, represented by their least
    id. Texts without words (or NULL) link with nothing and are their own
    component. Rows that share an id are one node: what links with any of them
    is in its component. A row with a NULL id takes the component of its set,
    NULL if no other row has that set, and makes no links.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), as_bytes(F.col(text)).alias("text"))
    order = spark.sparkContext.broadcast(frequency_sketch(rows.select("text"), n, sketch))

    def postings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A row per document, and one (token, s) per band and last element of a set s."""
        hashes, table = WordHashes(300_000), order.value
        for batch in batches:
            keys, made, last = [], [], {}
            for key, raw in zip(batch["doc_id"], batch["text"]):
                codes = ngrams(raw, n, hashes)
                keys.append(None if key is None else int(key))
                made.append((set_name(codes), set_number(codes), len(codes)))
                if keys[-1] is not None and len(codes) and made[-1][1] not in last:
                    rising = ordered(codes, table)
                    last[made[-1][1]] = np.concatenate(
                        [joined(rising[len(rising) - k :], np.array([b], np.uint64)) for b, k in bands(len(codes), percent)]
                    ).view(np.int64)
            yield pd.DataFrame(
                {"doc_id": pd.array(keys, "Int64"), "set_id": [m[0] for m in made], "s": [m[1] for m in made], "n": [m[2] for m in made]}
            )
            if last:
                numbers = np.repeat(np.array(list(last), np.int64), [len(t) for t in last.values()])
                yield pd.DataFrame({"doc_id": None, "set_id": None, "s": numbers, "n": None, "token": np.concatenate(list(last.values()))})

    def aligned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in postings(batches):
            if "token" not in frame:
                frame["token"] = pd.array([None] * len(frame), "Int64")
            yield frame.astype({"doc_id": "Int64", "n": "Int64"})

    made, _, _ = written(
        # Ids go in as text, as pandas would round the numbers of a column with a NULL.
        rows.select(F.col("doc_id").cast("string"), "text").mapInPandas(aligned, "doc_id long, set_id binary, s long, n long, token long"),
        "postings",
    )
    listed = made.filter("set_id IS NOT NULL").select("doc_id", "set_id", "s", "n")
    posted = made.filter("token IS NOT NULL").select("token", "s")

    # An element held by several sets names a bucket, after the least of them.
    leaders = (
        posted.groupBy("token")
        .agg(F.min("s").alias("leader"), F.max("s").alias("high"))
        .filter("leader <> high")
        .select("token", "leader")
    )
    met = skew_join(posted, leaders, ["token"]).select("leader", "s").distinct()
    classes = listed.filter("n > 0 AND doc_id IS NOT NULL").groupBy("s").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"))
    members, _, some = written(skew_join(met, classes, ["s"]), "members")
    if not some:
        links = spark.createDataFrame([], "a long, b long")
    else:
        links = _bucket_links(rows, members, n, percent, order, task_elements)
    links, _, _ = written(links, "set-links")

    names = listed.filter("n > 0").groupBy("set_id").agg(F.min("doc_id").alias("name"))
    joined_names = names.join(components(links), F.col("name") == F.col("node"), "left").select(
        "set_id", F.coalesce("component", "name").alias("component")
    )
    result = skew_join(listed, joined_names, ["set_id"], "left")
    return (
        result.select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            "set_id",
            F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
        ),
        links,
    )


def _bucket_links(rows: DataFrame, members: DataFrame, n: int, percent: int, order, task_elements: int) -> DataFrame:
    """(a, b): a spanning set of the links inside all buckets."""
    # Buckets that fit a task are one group. Larger ones are cut into chunks;
    # members that link with the leader are one class, so only pairs of chunks
    # with a member that does not are compared.
    chunks = F.ceil(F.sum(F.col("n") + SET_COST) / F.lit(task_elements)).cast("int")
    sized, _, any_big = written(members.groupBy("leader").agg(chunks.alias("chunks")), "buckets", F.col("chunks") > 1)
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    bits = members.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 AS int))")).alias("bits")
    )
    taken = np.zeros(FILTER_BITS // 64, np.int64)
    for r in bits.toLocalIterator():
        taken[r["word"]] = r["bits"]
    in_bucket = rows.sparkSession.sparkContext.broadcast(taken)

    def asked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = in_bucket.value
        for batch in batches:
            at = batch["slot"].to_numpy(np.int64)
            yield batch[(held[at >> 6] >> (at & 63)) & 1 == 1]

    texts = rows.filter("doc_id IS NOT NULL").withColumn("slot", slot).mapInPandas(asked, "doc_id long, text binary, slot long")
    wanted = skew_join(members, sized, ["leader"]).groupBy("doc_id").agg(F.collect_list(F.struct("leader", "chunks", "s")).alias("buckets"))

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes(300_000)
        for batch in batches:
            codes = [ngrams(raw, n, hashes) for raw in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "own": [set_number(c) for c in codes], "codes": [short_set(c) for c in codes], "buckets": batch["buckets"]})

    bucket = "array<struct<leader:long,chunks:int,s:long>>"
    full = (
        skew_join(texts, wanted, ["doc_id"])
        .select("doc_id", "text", "buckets")
        .mapInPandas(sets, f"doc_id long, own long, codes binary, buckets {bucket}")
        .select("doc_id", "own", "codes", F.explode("buckets").alias("b"))
        .filter("own = b.s")
        .select("b.leader", "doc_id", "codes", "b.chunks", "own")
    )
    small = full.filter("chunks <= 1").select("leader", F.lit("").alias("pair"), "doc_id", "codes")
    found = _trie_join(small, percent, order)
    if not any_big:
        return found

    big, _, _ = written(full.filter("chunks > 1"), "large-buckets")
    heads = big.filter("own = leader").select("leader", F.col("codes").alias("head"), F.col("doc_id").alias("first")).dropDuplicates(["leader"])

    @F.pandas_udf("boolean")
    def near(codes: pd.Series, head: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(codes, head):
            a, b = long_set(x), long_set(y)
            same = len(np.intersect1d(a, b, assume_unique=True))
            out.append(100 * same >= percent * (len(a) + len(b) - same))
        return pd.Series(out, dtype=bool)

    marked, _, _ = written(
        skew_join(big, heads, ["leader"]).withColumn("near", near("codes", "head")).drop("head"), "marked"
    )
    starred = marked.filter("near").select(F.col("doc_id").alias("a"), F.col("first").alias("b")).filter("a <> b")
    counts = marked.groupBy("leader").agg(F.count_if(~F.col("near")).alias("far"), F.count(F.lit(1)).alias("all"))
    cut = skew_join(marked, counts, ["leader"]).withColumns(
        {
            "fars": F.greatest(F.ceil(F.col("chunks") * F.col("far") / F.col("all")), F.lit(1)).cast("int"),
            "chunk": F.pmod(F.xxhash64("doc_id"), F.col("chunks")).cast("int"),
        }
    ).filter("far > 0")
    far_chunk = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("fars")).cast("int")
    # A far member meets every chunk of near ones and every chunk of far ones.
    as_near = cut.filter("near").select(
        "leader", "doc_id", "codes", F.col("chunk").alias("i"), F.explode(F.sequence(F.lit(0), F.col("fars") - 1)).alias("j")
    ).withColumn("kind", F.lit("n"))
    as_far = cut.filter("NOT near").withColumn("own", far_chunk)
    far_near = as_far.select(
        "leader", "doc_id", "codes", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("i"), F.col("own").alias("j")
    ).withColumn("kind", F.lit("n"))
    far_far = as_far.select(
        "leader", "doc_id", "codes", "own", F.explode(F.sequence(F.lit(0), F.col("fars") - 1)).alias("other")
    ).select(
        "leader", "doc_id", "codes", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    ).withColumn("kind", F.lit("f"))
    pairs = as_near.unionByName(far_near).unionByName(far_far)
    large = pairs.select("leader", F.concat_ws("-", "kind", "i", "j").alias("pair"), "doc_id", "codes")
    return found.unionByName(starred).unionByName(_trie_join(large, percent, order))


def _trie_join(buckets: DataFrame, percent: int, order) -> DataFrame:
    """Links inside each (leader, pair), as stars around the least member of a class."""

    def join(ids: list[int], codes: list[bytes], table: np.ndarray) -> list[tuple[int, int]]:
        own = sorted(set(zip(ids, codes)))
        sets = [long_set(c) for _, c in own]
        # Ranks in the global order turn the sets into rising whole numbers.
        elements = ordered(distinct(np.concatenate(sets)), table)
        by_hash = np.argsort(elements)
        sorted_hashes = elements[by_hash]
        merge = Classes(len(own))
        linked_pairs([np.sort(by_hash[np.searchsorted(sorted_hashes, s)]) for s in sets], percent, merge)
        return [(own[i][0], own[m[0]][0]) for m in map(sorted, merge.members.values()) for i in m[1:]]

    def joins(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, ids, codes, found = None, [], [], []
        for batch in batches:
            for leader, pair, key, raw in zip(batch["leader"], batch["pair"], batch["doc_id"], batch["codes"]):
                if (leader, pair) != now:
                    if len(ids) > 1:
                        found += join(ids, codes, order.value)
                    now, ids, codes = (leader, pair), [], []
                ids.append(int(key))
                codes.append(bytes(raw))
            if found:
                yield pd.DataFrame(found, columns=["a", "b"])
                found = []
        if len(ids) > 1:
            yield pd.DataFrame(join(ids, codes, order.value), columns=["a", "b"])

    sorted_buckets = buckets.repartition("leader", "pair").sortWithinPartitions("leader", "pair")
    return sorted_buckets.mapInPandas(joins, "a long, b long")
