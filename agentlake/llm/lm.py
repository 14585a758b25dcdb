"""N-gram language-model scoring with Elias-Fano tries.

Documents become blocks of token numbers. What a block asks (its distinct words,
then its distinct n-grams with their counts in training) goes to the shard that
owns it; a shard adds up the counts of all blocks, builds its trie, and answers
each block. No task holds more than a block or a shard, and no model is sent
whole to anyone.

p(w | c) = max(n(c w) - D, 0) / n(c) + backoff(c) * p(w | shorter c), where
backoff(c) is the share of n(c) that its children do not get; the shortest
context backs off to equal shares among all known words and one unknown.
"""

from __future__ import annotations

import mmap
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agentlake.llm.elias_fano import Level
from agentlake.llm.text import WordHashes, as_bytes, crc_rest, mixed, packed, unpacked, words
from agentlake.session import written

#: Longest n-gram, its discount, least count of a context above two words,
#: tokens of a block, and distinct entries of a shard.
ORDER = 2
DISCOUNT = 0.75
LEAST_CONTEXT = 2
BLOCK_TOKENS = 1_000_000
SHARD_ENTRIES = 2_000_000
END = np.uint64(0xFFFFFFFFFFFFFFFF)

_BLOCK = (
    "block long, doc_ids array<string>, held array<boolean>, sizes array<int>, tokens binary, vocabulary binary, counts binary, "
    "n_distinct long, n_train long"
)


def _blocks(batches: Iterator[pd.DataFrame], most: int) -> Iterator[pd.DataFrame]:
    """Blocks of whole documents: token numbers count into the block's sorted hashes."""
    hashes, number = WordHashes(300_000), TaskContext.get().partitionId() << 32
    keys, held, codes = [], [], []

    def made() -> pd.DataFrame:
        flat = np.concatenate(codes) if codes else np.empty(0, np.uint64)
        vocabulary, at = np.unique(flat, return_inverse=True)
        sizes = [len(c) for c in codes]
        train = np.repeat(~np.array(held, bool), sizes)
        counts = np.bincount(at, weights=train, minlength=len(vocabulary)).astype(np.uint32)
        row = (number, keys, held, sizes, packed(at.astype(np.uint32)), packed(vocabulary), packed(counts), len(vocabulary), int(train.sum()))
        return pd.DataFrame([row], columns=[c.split()[0] for c in _BLOCK.split(", ")])

    total = 0
    for batch in batches:
        for key, test, raw in zip(batch["doc_id"], batch["held"], batch["text"]):
            own = np.append(hashes.of(words(raw)), END)
            if total and total + len(own) > most:
                yield made()
                keys, held, codes, total, number = [], [], [], 0, number + 1
            keys.append(key)
            held.append(bool(test))
            codes.append(own)
            total += len(own)
    if keys:
        yield made()


def _by_group(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Runs of equal ``key`` in a sorted stream of small frames of blobs."""
    now, rows = None, []
    for batch in batches:
        for row in batch.to_dict("records"):
            if row[key] != now and rows:
                yield pd.DataFrame(rows)
                rows = []
            now = row[key]
            rows.append(row)
    if rows:
        yield pd.DataFrame(rows)


def _narrow(values: np.ndarray) -> tuple[bytes, str]:
    """Whole numbers in the fewest bytes, by planes, so that they compress."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width]
    return packed(planes.T), str(width)


def _pack_all(*arrays: np.ndarray) -> bytes:
    parts = [_narrow(a) for a in arrays]
    head = ",".join(f"{len(p)}:{w}:{len(a)}" for (p, w), a in zip(parts, arrays)).encode() + b";"
    return head + b"".join(p for p, _ in parts)


def _unpack_all(raw: bytes) -> list[np.ndarray]:
    raw = bytes(raw)
    head, at, out = raw[: raw.index(b";")].decode(), raw.index(b";") + 1, []
    for item in head.split(","):
        size, width, n = map(int, item.split(":"))
        planes = unpacked(raw[at : at + size], np.uint8).reshape(width, n)
        full = np.zeros((n, 8), np.uint8)
        full[:, :width] = planes.T
        out.append(full.reshape(-1).view("<u8"))
        at += size
    return out


def _gaps(rising: np.ndarray) -> np.ndarray:
    return np.diff(rising, prepend=rising.dtype.type(0))


def _shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def _word_answers(frame: pd.DataFrame, shards: int) -> pd.DataFrame:
    """Sum the counts of a shard's words and number the known ones: the more
    frequent, the smaller; 0 is unknown."""
    shard = int(frame["shard"].iloc[0])
    asked = [_unpack_all(r) for r in frame["ask"]]
    keys = [np.cumsum(a[0], dtype=np.uint64) for a in asked]
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(at, weights=np.concatenate([a[1] for a in asked]).astype(float), minlength=len(distinct)).astype(np.int64)
    rank = np.empty(len(distinct), np.int64)
    rank[np.lexsort((distinct, -total))] = np.arange(len(distinct))
    ids = np.where(total > 0, rank * shards + shard + 1, 0)
    out, start = [], 0
    for key in keys:
        own = at[start : start + len(key)]
        out.append(_pack_all(ids[own], total[own]))
        start += len(key)
    return pd.DataFrame({"block": frame["block"], "shard": shard, "answer": out, "known": int((total > 0).sum())})


def _mapped(raw: bytes):
    """A file of this task only, mapped and gone once it is closed."""
    with tempfile.TemporaryFile() as file:
        file.write(raw)
        file.flush()
        return mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)


def build_level(contexts: np.ndarray, words_: np.ndarray, counts: np.ndarray, sizes: np.ndarray, discount: float) -> bytes:
    """Trie level of the n-grams (context, word), sorted, with their counts and
    those of their contexts."""
    own, context_at = np.unique(contexts, return_inverse=True)
    vocabulary, word_at = np.unique(words_, return_inverse=True)
    share = np.log10(np.maximum(counts - discount, 1e-9) / sizes)
    return Level.encode(own, vocabulary, context_at, word_at, share)


def _gram_answers(frame: pd.DataFrame, shards: int, discount: float, more: bool) -> pd.DataFrame:
    """Sum the counts of a shard's n-grams, build its trie, and answer by it."""
    shard = int(frame["shard"].iloc[0])
    lists = []
    for raw in frame["ask"]:
        gaps, sizes, children, followers, counts = _unpack_all(raw)
        lists.append((np.cumsum(gaps, dtype=np.uint64), sizes, children.astype(np.int64), followers, counts))
    contexts = np.concatenate([np.repeat(c, n) for c, _, n, _, _ in lists])
    followers = np.concatenate([f for *_, f, _ in lists])
    counts = np.concatenate([n for *_, n in lists]).astype(float)
    own_context, c_at = np.unique(contexts, return_inverse=True)
    own_word, w_at = np.unique(followers, return_inverse=True)
    all_contexts, first = np.unique(np.concatenate([c for c, *_ in lists]), return_index=True)
    all_sizes = np.concatenate([s for _, s, *_ in lists])[first].astype(float)
    pairs, at = np.unique(c_at * max(len(own_word), 1) + w_at, return_inverse=True)
    total = np.bincount(at, weights=counts, minlength=len(pairs))
    kept = total > 0
    pair_context, pair_word = own_context[pairs[kept] // max(len(own_word), 1)], own_word[pairs[kept] % max(len(own_word), 1)]
    size_of = all_sizes[np.searchsorted(all_contexts, pair_context)]
    asked_context, asked_word = own_context[pairs // max(len(own_word), 1)], own_word[pairs % max(len(own_word), 1)]
    del contexts, followers, counts, pairs
    level = Level(_mapped(build_level(pair_context, pair_word, total[kept], size_of, discount)))
    given = np.bincount(
        np.searchsorted(all_contexts, pair_context), weights=np.maximum(total[kept] - discount, 0), minlength=len(all_contexts)
    )
    total = total[kept].astype(np.int64)
    # The level is searched once, for all that any block asks; ``at`` hands it out.
    places = level.find(asked_context, asked_word)
    out, start = [], 0
    for own, _, _, asked, _ in lists:
        place = places[at[start : start + len(asked)]]
        start += len(asked)
        codes = np.where(place >= 0, level.codes[np.maximum(place, 0)].astype(np.int64) + 1, 0) if len(total) else np.zeros(len(asked))
        # In fixed point, so that parts of a hot context add up exactly.
        share = np.rint(given[np.searchsorted(all_contexts, own)] * 4).astype(np.uint64)
        answer = [codes.astype(np.uint64), share]
        if more:
            often = np.where(place >= 0, total[np.maximum(place, 0)], 0) if len(total) else np.zeros(len(asked), np.int64)
            node = np.where(often >= LEAST_CONTEXT, place * shards + shard + 1, 0)
            answer += [node.astype(np.uint64), np.where(node > 0, often, 0).astype(np.uint64)]
        out.append(_pack_all(*answer))
    return pd.DataFrame({"block": frame["block"], "shard": shard, "answer": out, "floor": level.floor, "step": level.step})


def _word_ask(row: dict, shards: int) -> Iterator[tuple[int, bytes]]:
    vocabulary, counts = unpacked(row["vocabulary"], np.uint64), unpacked(row["counts"], np.uint32)
    cuts = np.searchsorted(_shard_of(vocabulary, shards), np.arange(shards + 1))
    for s in range(shards):
        a, b = cuts[s], cuts[s + 1]
        if a < b:
            yield s, _pack_all(_gaps(vocabulary[a:b]), counts[a:b])


def _positions(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document of each position, whether it starts one, whether it is held out)."""
    sizes = np.array(row["sizes"], np.int64)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.zeros(len(doc), bool)
    starts[np.cumsum(sizes) - sizes] = True
    return doc, starts, np.repeat(np.array(row["held"], bool), sizes)


def _gram_pairs(row: dict, shards: int, n_train: int) -> dict:
    """The distinct (context, word) of a block and where each is asked."""
    node, size, word = (unpacked(row[k], np.int64) for k in ("node", "size", "word"))
    tail = unpacked(row["tail"], np.int64)
    _, starts, held = _positions(row)
    before = np.concatenate([[0], node[:-1]])
    before[starts] = 0
    sizes = np.concatenate([[0], size[:-1]])
    usable = np.flatnonzero((before > 0) & (tail > 0) & (word > 0))
    c, w = before[usable], word[usable]
    order = np.lexsort((w, c))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(c[order]) != 0) | (np.diff(w[order]) != 0)
    pair = np.cumsum(new) - 1
    pair_of = np.empty(len(order), np.int64)
    pair_of[order] = pair
    counts = np.bincount(pair_of, weights=~held[usable], minlength=int(new.sum())).astype(np.int64)
    first = usable[order[new]]
    context, follower, context_size = before[first], word[first], sizes[first]
    # A context with more than its part of all tokens is spread over shards.
    split = 1 + context_size * shards // max(n_train, 1)
    sub = (mixed(follower.astype(np.uint64)) % split.astype(np.uint64)).astype(np.int64)
    home = (mixed(context.astype(np.uint64)) % np.uint64(shards)).astype(np.int64)
    shard = (home + sub) % shards
    return {
        "usable": usable, "pair_of": pair_of, "counts": counts, "context": context, "follower": follower,
        "context_size": context_size, "split": split, "home": home, "shard": shard,
    }


def _gram_lists(p: dict, shards: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per shard: its pairs, and all contexts it is asked about. A context that
    is spread is named to each of its shards, so that the parts can be added."""
    heads = np.flatnonzero(np.diff(p["context"], prepend=-1))
    times = np.minimum(p["split"][heads], shards)
    head = np.repeat(heads, times)
    sub = np.arange(len(head)) - np.repeat(np.cumsum(times) - times, times)
    at = (p["home"][head] + sub) % shards
    by_shard, by_head = np.argsort(p["shard"], kind="stable"), np.argsort(at, kind="stable")
    cuts = np.searchsorted(p["shard"][by_shard], np.arange(shards + 1))
    head_cuts = np.searchsorted(at[by_head], np.arange(shards + 1))
    for s in range(shards):
        if head_cuts[s] < head_cuts[s + 1]:
            yield s, by_shard[cuts[s] : cuts[s + 1]], np.sort(head[by_head[head_cuts[s] : head_cuts[s + 1]]])


def _gram_ask(row: dict, shards: int, n_train: int) -> Iterator[tuple[int, bytes]]:
    p = _gram_pairs(row, shards, n_train)
    for s, pairs, heads in _gram_lists(p, shards):
        contexts = p["context"][heads]
        n = np.bincount(np.searchsorted(contexts, p["context"][pairs]), minlength=len(heads))
        yield s, _pack_all(_gaps(contexts.astype(np.uint64)), p["context_size"][heads], n, p["follower"][pairs], p["counts"][pairs])


def _with_words(row: dict, answers: pd.DataFrame, n_train: int, n_words: int, discount: float) -> dict:
    """The block's tokens as word numbers, with base score and unigram probability."""
    got = [_unpack_all(a) for a in answers.sort_values("shard")["answer"]]
    ids = np.concatenate([g[0] for g in got]).astype(np.int64)
    counts = np.concatenate([g[1] for g in got]).astype(np.int64)
    at = unpacked(row["tokens"], np.uint32)
    doc, _, _ = _positions(row)
    n_docs = len(row["sizes"])
    base = np.log10((counts + 0.5) / (n_train + 0.5 * (n_words + 1)))
    spare = discount * n_words / n_train if n_train else 1.0
    p = (np.maximum(counts - discount, 0) / max(n_train, 1) + spare / (n_words + 1))[at]
    return row | {
        "base": np.bincount(doc, weights=base[at], minlength=n_docs),
        "known": np.bincount(doc, weights=counts[at] > 0, minlength=n_docs),
        "p": p,
        "word": packed(ids[at]),
        "node": packed(ids[at]),
        "tail": packed(np.ones(len(at), np.int64)),
        "size": packed(counts[at]),
    }


def _with_level(row: dict, answers: pd.DataFrame, shards: int, n_train: int, more: bool) -> dict:
    """Probabilities and nodes one word longer."""
    pairs = _gram_pairs(row, shards, n_train)
    by_shard = {int(r["shard"]): r for r in answers.to_dict("records")}
    share, value = np.zeros(len(pairs["context"])), np.zeros(len(pairs["context"]))
    nodes, often = np.zeros(len(value), np.int64), np.zeros(len(value), np.int64)
    for s, own, heads in _gram_lists(pairs, shards):
        r = by_shard[s]
        codes, given, *rest = _unpack_all(r["answer"])
        value[own] = np.where(codes > 0, 10.0 ** (r["floor"] + r["step"] * (codes.astype(float) - 1)), 0.0)
        share[heads] += given / 4.0
        if more:
            nodes[own], often[own] = rest[0], rest[1]
    heads = np.flatnonzero(np.diff(pairs["context"], prepend=-1))
    total = np.repeat(share[heads], np.diff(np.append(heads, len(share))))
    backoff = 1.0 - total / pairs["context_size"] if len(total) else total
    p, at = row["p"].copy(), pairs["pair_of"]
    p[pairs["usable"]] = value[at] + backoff[at] * p[pairs["usable"]]
    out = row | {"p": p}
    if more:
        node, size = np.zeros(len(p), np.int64), np.zeros(len(p), np.int64)
        node[pairs["usable"]], size[pairs["usable"]] = nodes[at], often[at]
        out |= {"node": packed(node), "size": packed(size), "tail": packed(node)}
    return out


def score_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    parts: int = 5,
    held: int = 1,
    order: int = ORDER,
    discount: float = DISCOUNT,
    block_tokens: int = BLOCK_TOKENS,
    shard_entries: int = SHARD_ENTRIES,
) -> DataFrame:
    """Score every document, learning from those whose crc32(id) mod ``parts``
    is not ``held``.

    Returns one row per row: (doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score). Tokens are lower-cased words and one end.
    A NULL or empty text is its end alone; a NULL id counts as empty text in
    the split. Repeated rows each count. Without training rows all words are
    unknown, and ``base_score`` takes N and V as 0. N-grams above two words need
    a context seen ``LEAST_CONTEXT`` times. Words are told apart by 64-bit
    hashes; stored probabilities have 256 steps per shard.
    """
    spark = docs.sparkSession
    rows = docs.select(
        # Text, as pandas would round the numbers of a column with a NULL.
        F.col(doc_id).cast("long").cast("string").alias("doc_id"),
        (crc_rest(F.col(doc_id), parts) == held).alias("held"),
        as_bytes(F.col(text)).alias("text"),
    )
    blocks, _, some = written(rows.mapInPandas(lambda it: _blocks(it, block_tokens), _BLOCK), "blocks")
    if not some:
        return rows.select(
            F.col("doc_id").cast("long"), F.col("held").alias("held_out"), F.lit(0).cast("long").alias("n_tokens"), F.lit(0).cast("long").alias("n_known"),
            F.lit(0).cast("long").alias("train_tokens"), F.lit(0.0).alias("base_score"), F.lit(0.0).alias("score"),
        )
    sums = blocks.agg(F.sum("n_train").alias("train"), F.sum("n_distinct").alias("asked"), F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)).alias("tokens")).first()
    n_train = int(sums["train"])
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    word_shards = max(least, -(-int(sums["asked"]) // shard_entries))
    gram_shards = max(least, -(-int(sums["tokens"]) // shard_entries))

    def word_asks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                got = list(_word_ask(row, word_shards))
                yield pd.DataFrame({"block": row["block"], "shard": [s for s, _ in got], "ask": [a for _, a in got]})

    def word_replies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _by_group(batches, "shard"):
            yield _word_answers(frame, word_shards)

    asks = blocks.select("block", "vocabulary", "counts").mapInPandas(word_asks, "block long, shard int, ask binary")
    replies = (
        asks.repartitionById(word_shards, F.col("shard"))
        .sortWithinPartitions("shard")
        .mapInPandas(word_replies, "block long, shard int, answer binary, known long")
    )
    replies, _, _ = written(replies, "word-answers")
    n_words = int(replies.groupBy("shard").agg(F.max("known").alias("n")).agg(F.sum("n")).first()[0] or 0)

    with_words = _merged(blocks.drop("vocabulary", "counts"), replies.drop("known"))
    state = lambda row, levels: _state(row, levels, n_train, n_words, discount, gram_shards, order)
    sources = [with_words]
    for level in range(2, order + 1):
        more = level < order

        def gram_asks(batches: Iterator[pd.DataFrame], depth: int = level) -> Iterator[pd.DataFrame]:
            for row, answers in _grouped(batches):
                got = list(_gram_ask(state(row, answers), gram_shards, n_train))
                yield pd.DataFrame({"block": row["block"], "shard": [s for s, _ in got], "ask": [a for _, a in got]})

        def gram_replies(batches: Iterator[pd.DataFrame], more: bool = more) -> Iterator[pd.DataFrame]:
            for frame in _by_group(batches, "shard"):
                yield _gram_answers(frame, gram_shards, discount, more)

        grams = sources[-1].mapInPandas(gram_asks, "block long, shard int, ask binary")
        got = (
            grams.repartitionById(gram_shards, F.col("shard"))
            .sortWithinPartitions("shard")
            .mapInPandas(gram_replies, "block long, shard int, answer binary, floor double, step double")
        )
        if more:
            got, _, _ = written(got, "gram-answers")
        replies = replies.drop("known").withColumn("level", F.lit(1)) if level == 2 else replies
        replies = replies.unionByName(got.withColumn("level", F.lit(level)), allowMissingColumns=True)
        sources.append(_merged(blocks.drop("vocabulary", "counts"), replies))

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for row, answers in _grouped(batches):
            end = state(row, answers)
            doc, _, _ = _positions(row)
            score = np.bincount(doc, weights=np.log10(end["p"]), minlength=len(row["sizes"]))
            yield pd.DataFrame(
                {
                    "doc_id": pd.array([None if k is None else int(k) for k in row["doc_ids"]], "Int64"),
                    "held_out": np.array(row["held"], bool),
                    "n_tokens": np.array(row["sizes"], np.int64),
                    "n_known": end["known"].astype(np.int64),
                    "train_tokens": n_train,
                    "base_score": end["base"],
                    "score": score,
                }
            )

    return sources[-1].mapInPandas(
        scored, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )


def _merged(blocks: DataFrame, answers: DataFrame) -> DataFrame:
    """Blocks and their answers in one stream, sorted so that a block comes
    before its answers; a task holds one block at a time."""
    both = blocks.unionByName(answers, allowMissingColumns=True)
    return both.repartition("block").sortWithinPartitions("block", F.col("shard").asc_nulls_first())


def _grouped(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[dict, pd.DataFrame]]:
    for frame in _by_group(batches, "block"):
        whole = frame["tokens"].notna()
        row = frame[whole].iloc[0].to_dict()
        yield row, frame[~whole]


def _state(row: dict, answers: pd.DataFrame, n_train: int, n_words: int, discount: float, shards: int, order: int) -> dict:
    """A block with the answers of all levels so far worked in."""
    level = answers["level"] if "level" in answers else pd.Series(1, index=answers.index)
    out = _with_words(row, answers[level == 1], n_train, n_words, discount)
    for depth in range(2, order + 1):
        own = answers[level == depth]
        if not len(own):
            break
        out = _with_level(out, own, shards, n_train, depth < order)
    return out
