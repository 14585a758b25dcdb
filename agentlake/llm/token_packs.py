"""Token-id packs: best-fit-decreasing packing into rows of a fixed length.

Texts become token ids, overlong documents are split without loss, and the
pieces of a block are packed, longest first, each into the fullest row that
still takes it. A segment tree over free capacities finds that row.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agentlake.llm.text import as_bytes

#: Ids per row, rows' filler, end mark of a document, ids packed at a time, and
#: the 50,256 ids of the vocabulary leave these free for both.
LENGTH = 2_048
END = 50_256
BLOCK_IDS = 4_000_000

#: Fixed value: the pattern that splits text before merging, as published with
#: the vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Bytes encoded at a time; an odd multiplier and its inverse modulo 2**64.
BATCH_BYTES = 4_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

SCHEMA = (
    "block long, pack long, ids binary, n_ids int, cu_seqlens array<int>, positions binary, "
    "doc_ids array<long>, offsets array<long>"
)


def load_ranks(spark, path: str) -> dict[bytes, int]:
    """A rank file (token in base64, rank) read through Spark."""
    rows = spark.read.text(path).filter("value <> ''").collect()
    return {base64.b64decode(a): int(b) for a, b in (r["value"].split() for r in rows)}


class Encoder:
    """Byte-level BPE of many texts at a time.

    No piece of ``SPLIT`` reaches over a space before a visible character, so
    texts may be cut there. Equal stretches of a batch are found by a hash of
    their bytes, compared byte by byte, and merged once: they are encoded as one
    text, whose ids the byte lengths of tokens cut apart again.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str = SPLIT):
        import tiktoken

        self.encode = tiktoken.Encoding(
            "packs", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self.bytes_of = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.bytes_of[rank] = len(token)
        self.held = (np.empty(0, np.uint64),) * 2
        # A space is cut before unless white space, perhaps of several bytes, follows.
        self.visible = np.ones(256, bool)
        self.visible[[*b" \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f", 0xC2, 0xE1, 0xE2, 0xE3]] = False

    def __call__(self, raws: list[bytes]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        at, size = 0, 0
        for i, raw in enumerate(raws):
            size += len(raw)
            if size >= BATCH_BYTES or i == len(raws) - 1:
                out += self.batch(raws[at : i + 1])
                at, size = i + 1, 0
        return out

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Powers of the multiplier and of its inverse, modulo 2**64."""
        if len(self.held[0]) < n:
            self.held = tuple(np.cumprod(np.full(n, base, np.uint64)) for base in (_BASE, _INVERSE))
        return self.held[0][:n], self.held[1]

    def plain(self, raw: bytes) -> np.ndarray:
        return np.array(self.encode(raw.decode("utf-8", "replace")), np.uint16)

    def batch(self, raws: list[bytes]) -> list[np.ndarray]:
        sizes = np.array([len(r) for r in raws], np.int64)
        borders = np.concatenate([[0], np.cumsum(sizes)])
        whole = b"".join(raws)
        if len(raws) == 1 and len(whole) > 4 * BATCH_BYTES or not whole:
            return [self.plain(r) for r in raws]
        buffer = np.frombuffer(whole + b" ", np.uint8)
        spaces = np.flatnonzero(buffer[:-1] == 32)
        spaces = spaces[self.visible[buffer[spaces + 1]]]
        first, cut = np.zeros(len(buffer), bool), np.zeros(len(buffer), bool)
        first[borders[:-1][sizes > 0]] = True
        cut[spaces] = True
        cut[borders[1:][sizes > 0] - 1] = False
        cuts = np.flatnonzero(cut | first)
        is_first = first[cuts]
        ends = np.append(cuts[1:], borders[-1])
        power, inverse = self.powers(len(buffer))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(buffer * power)])
        codes = (sums[ends] - sums[cuts]) * inverse[cuts]
        del sums
        codes[is_first] = np.arange(is_first.sum())
        number, _ = pd.factorize(codes)
        # The first of each kind stands for it; a first stretch has no space before it.
        stands = np.full(number.max() + 1, -1, np.int64)
        stands[number[::-1]] = np.arange(len(number) - 1, -1, -1)
        lengths = ends - cuts
        if not (lengths == lengths[stands[number]]).all():
            return [self.plain(r) for r in raws]
        like = np.arange(borders[-1]) + np.repeat(cuts[stands[number]] - cuts, lengths)
        if not (buffer[:-1] == buffer[like]).all():
            return [self.plain(r) for r in raws]
        del like
        alone = is_first[stands]
        kinds = np.flatnonzero(~alone)
        parts = [whole[a:b] for a, b in zip(cuts[stands[kinds]], ends[stands[kinds]])]
        ids = [np.array(self.encode(b"".join(parts).decode("utf-8", "replace")), np.uint16)]
        begins, counts = np.zeros(len(stands), np.int64), np.zeros(len(stands), np.int64)
        if len(kinds):
            reach = np.searchsorted(np.cumsum(self.bytes_of[ids[0]]), np.cumsum([len(p) for p in parts])) + 1
            begins[kinds] = np.concatenate([[0], reach[:-1]])
            counts[kinds] = np.diff(np.concatenate([[0], reach]))
        filled = len(ids[0])
        for kind in np.flatnonzero(alone):
            own = self.plain(whole[cuts[stands[kind]] : ends[stands[kind]]])
            ids.append(own)
            begins[kind], counts[kind] = filled, len(own)
            filled += len(own)
        flat, n = np.concatenate(ids), counts[number]
        goes = np.cumsum(n)
        result = flat[np.arange(goes[-1]) + np.repeat(begins[number] - goes + n, n)]
        edges = np.concatenate([[0], goes])[np.searchsorted(cuts, borders)]
        return [result[a:b] for a, b in zip(edges[:-1], edges[1:])]


class FreeRows:
    """Segment tree over capacities 0..length: the least one, at least a given
    size, that some open row has left."""

    def __init__(self, length: int):
        self.leaves = 1 << length.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(self.leaves)]

    def put(self, capacity: int, row: int) -> None:
        self.rows[capacity].append(row)
        at = capacity + self.leaves
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """(capacity, row) with the least capacity of at least ``size``."""
        count, at = self.count, size + self.leaves
        if not count[at]:
            while at > 1 and (at & 1 or not count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if count[2 * at] else 2 * at + 1
        capacity = at - self.leaves
        while at:
            count[at] -= 1
            at >>= 1
        return capacity, self.rows[capacity].pop()


def best_fit_decreasing(sizes: list[int], length: int) -> list[list[int]]:
    """Rows of piece numbers; no row holds more than ``length``."""
    free, rows = FreeRows(length), []
    for piece in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[piece]
        found = free.take(size)
        if found is None:
            rows.append([piece])
            left, row = length - size, len(rows) - 1
        else:
            capacity, row = found
            rows[row].append(piece)
            left = capacity - size
        if left:
            free.put(left, row)
    return rows


def pack_tokens(
    docs: DataFrame,
    ranks: dict[bytes, int],
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    end: int = END,
    block_ids: int = BLOCK_IDS,
    encoder: Callable[[dict], Callable[[list[bytes]], list[np.ndarray]]] = Encoder,
) -> DataFrame:
    """Pack documents into rows of ``length`` ids.

    Returns (block, pack, ids, n_ids, cu_seqlens, positions, doc_ids, offsets):
    ``ids`` and ``positions`` are little-endian uint16 rows of ``length``
    entries, filled up with ``end`` and 0; ``cu_seqlens`` are the borders of the
    pieces and ``n_ids`` the last of them; positions restart at 0 at each piece;
    ``doc_ids`` and ``offsets`` tell whose ids a piece holds and from where, so
    all pieces of a document put together are its ids and an end mark. A NULL or
    empty text is its end mark alone; rows that share an id are documents of
    their own; a NULL id stays NULL. No rows give no rows.

    Packing is per block of about ``block_ids`` ids of one partition, without a
    shuffle: memory is bounded, and the loss against packing everything at once
    is the last rows of a block.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def packs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(shared.value)
        block = TaskContext.get().partitionId() << 32
        pieces: list[np.ndarray] = []
        owner: list[int | None] = []
        offset: list[int] = []

        def flushed() -> Iterator[pd.DataFrame]:
            out = []
            for number, row in enumerate(best_fit_decreasing([len(p) for p in pieces], length)):
                ids = np.full(length, end, "<u2")
                where = np.zeros(length, "<u2")
                borders = [0]
                for i in row:
                    a, b = borders[-1], borders[-1] + len(pieces[i])
                    ids[a:b] = pieces[i]
                    where[a:b] = np.arange(b - a)
                    borders.append(b)
                out.append(
                    (block, number, ids.tobytes(), borders[-1], borders, where.tobytes(), [owner[i] for i in row], [offset[i] for i in row])
                )
                if len(out) == 1_000:
                    yield pd.DataFrame(out, columns=names)
                    out = []
            if out:
                yield pd.DataFrame(out, columns=names)

        held = 0
        for batch in batches:
            encoded = encode([bytes(raw) for raw in batch["text"]])
            for own, key in zip(encoded, batch["doc_id"]):
                ids = np.append(own, np.uint16(end))
                for a in range(0, len(ids), length):
                    pieces.append(ids[a : a + length].astype("<u2"))
                    owner.append(None if key is None else int(key))
                    offset.append(a)
                held += len(ids)
                if held >= block_ids:
                    yield from flushed()
                    pieces, owner, offset, held, block = [], [], [], 0, block + 1
        yield from flushed()

    names = [c.split()[0] for c in SCHEMA.split(", ")]
    # Ids travel as text, as pandas would round the numbers of a column with a NULL.
    rows = docs.select(F.col(doc_id).cast("long").cast("string").alias("doc_id"), as_bytes(F.col(text)).alias("text"))
    return rows.mapInPandas(packs, SCHEMA)


def write_packs(packed: DataFrame, path: str) -> DataFrame:
    """Store the packs as Parquet below ``path`` and read them back."""
    packed.write.parquet(path)
    return packed.sparkSession.read.schema(packed.schema).parquet(path)
