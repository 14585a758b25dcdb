"""Token counts of whole texts, huge ones by overlapping chunks.

A huge text becomes chunks that overlap, dealt over tasks and encoded apart. Each
chunk tells where the tokens of its overlaps start and end. Two neighbours are
spliced at a token that both hold at the same place.

Such a place is proven: merging by priority, leftmost first, gives a row of
tokens exactly if every two neighbours, encoded alone, stay as they are; merges
inside a token see nothing beyond it, so the first merge over a border would
happen for the two alone as well. Up to and from a shared token, every two
neighbours of the splice are neighbours in one of the chunks. Chunks without a
shared token are encoded again with wider overlaps, in the end as one chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agentlake.llm.text import as_bytes
from agentlake.session import written

#: Code points of a chunk, code points that a chunk reaches over each of its
#: borders, growth of that reach where alignment fails, tokens of a context.
CHUNK = 32_768
REACH = 256
WIDER = 8
LIMIT = 4_096
#: Bytes encoded at a time, and bytes of chunks dealt to a task.
TOGETHER = 1_000_000
TASK_BYTES = 8_000_000


class Pieces:
    """A sentence-piece model that knows the code points of each of its pieces."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(self.processor.get_piece_size())
        names = [self.processor.id_to_piece(i) for i in ids]
        byte = np.array([self.processor.is_byte(i) for i in ids], bool)
        odd = [self.processor.is_unknown(i) or self.processor.is_control(i) for i in ids]
        self.whole = ~(byte | np.array(odd, bool))
        self.width = np.array([len(n) for n in names], np.int64)
        # The bytes of a character are pieces of their own; the first one counts.
        self.width[byte] = [int(n[3:5], 16) >> 6 != 2 for n, b in zip(names, byte) if b]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.processor.encode(texts, num_threads=1)

    def placed(self, text: str, start: int) -> tuple[np.ndarray, np.ndarray, bool]:
        """(codes, ends, fits): place and width of each token as one number, -1
        for a byte; its end; whether the widths add up to the text.

        The model puts a space before every text, which lies before ``start``.
        """
        ids = np.array(self.encode([text])[0], np.int64)
        ends = np.cumsum(self.width[ids]) + start - 1
        begins = ends - self.width[ids]
        codes = np.where(self.whole[ids] & (begins >= start), begins * 65_536 + self.width[ids], -1)
        return codes, ends, bool(len(ids)) and int(ends[-1]) == start + len(text)


def _text(raw) -> str:
    return raw.as_py().decode("utf-8", "replace")


def _counts(batches: Iterator[pa.RecordBatch], pieces: Pieces) -> Iterator[pa.RecordBatch]:
    """Tokens of whole texts, a bounded number of bytes at a time."""
    for batch in batches:
        texts, size, counts = [], 0, []
        for raw in batch.column("_text"):
            texts.append(_text(raw))
            size += len(texts[-1])
            if size >= TOGETHER:
                counts += [len(ids) for ids in pieces.encode(texts)]
                texts, size = [], 0
        counts += [len(ids) for ids in pieces.encode(texts)] if texts else []
        kept = [batch.column(c) for c in ("doc_id", "n_bytes")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])


def _cut(batches: Iterator[pa.RecordBatch], size: int, reach: int) -> Iterator[pa.RecordBatch]:
    """Chunks of ``size`` code points and ``reach`` more at each side."""
    for batch in batches:
        for row, raw in zip(batch.column("row").to_pylist(), batch.column("_text")):
            text = _text(raw)
            cuts = list(range(0, max(len(text) - reach, 1), size))
            for k, at in enumerate(cuts):
                begin = max(at - reach, 0)
                end = len(text) if k == len(cuts) - 1 else at + size + reach
                values = ([row], [k], [k == len(cuts) - 1], [begin], [at], [at + size], [text[begin:end].encode()])
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], names=_CHUNK_NAMES)


_CHUNK_NAMES = ["row", "chunk", "last", "begin", "low", "high", "_text"]
_CHUNK = "row long, chunk long, last boolean, begin long, low long, high long, _text binary"
_ENDS = (
    "row long, chunk long, last boolean, fits boolean, n long, "
    "head array<long>, head_upto array<long>, tail array<long>, tail_after array<long>"
)


def _encoded(batches: Iterator[pa.RecordBatch], pieces: Pieces, reach: int) -> Iterator[pa.RecordBatch]:
    """Tokens of each chunk, and those of its overlaps with their places."""
    names = [c.split()[0] for c in _ENDS.split(", ")]
    for batch in batches:
        for c, raw in zip(batch.select(_CHUNK_NAMES[:-1]).to_pylist(), batch.column("_text")):
            codes, ends, fits = pieces.placed(_text(raw), c["begin"])
            begins, n = codes >> 16, len(codes)
            head = np.flatnonzero((codes >= 0) & (ends <= c["low"] + reach)) if c["chunk"] else np.empty(0, int)
            tail = np.flatnonzero((codes >= 0) & (begins >= c["high"] - reach)) if not c["last"] else np.empty(0, int)
            lists = (codes[head], head + 1, codes[tail], n - 1 - tail)
            row = [[c["row"]], [c["chunk"]], [c["last"]], [fits], [n], *[[x.tolist()] for x in lists]]
            kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), *[pa.list_(pa.int64())] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names=names)


def _spliced(ends: DataFrame) -> DataFrame:
    """(row, n_tokens, aligned): a text's tokens, and whether all its chunks met.

    Chunk k meets chunk k + 1 at the first token that both hold; what the one
    has after it and the other up to it is counted once too often.
    """
    left = ends.filter("NOT last").select("row", "chunk", "tail", "tail_after", F.col("fits").alias("left_fits"))
    right = ends.filter("chunk > 0").select("row", (F.col("chunk") - 1).alias("chunk"), "head", "head_upto", F.col("fits").alias("right_fits"))
    met = left.join(right, ["row", "chunk"]).withColumn("common", F.array_min(F.array_intersect("tail", "head")))
    twice = F.get("tail_after", F.array_position("tail", F.col("common")) - 1) + F.get(
        "head_upto", F.array_position("head", F.col("common")) - 1
    )
    seams = met.select("row", (-twice).alias("n"), (F.col("common").isNotNull() & F.col("left_fits") & F.col("right_fits")).alias("aligned"))
    parts = ends.select("row", "n", F.lit(True).alias("aligned")).unionByName(seams)
    return parts.groupBy("row").agg(F.sum("n").alias("n_tokens"), F.bool_and("aligned").alias("aligned"))


def count_tokens(
    docs: DataFrame,
    model: bytes,
    doc_id: str = "doc_id",
    text: str = "text",
    limit: int = LIMIT,
    chunk: int = CHUNK,
    reach: int = REACH,
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """Bytes and tokens of every text: (doc_id, n_bytes, n_tokens, over_limit).

    ``model`` is a sentence-piece BPE model; counts are those of its library for
    the whole text, without begin and end marks. Texts above ``chunk`` code
    points are cut, dealt over tasks and spliced; ``reach`` is at most a quarter
    of ``chunk`` and grows ``WIDER``-fold for the texts whose chunks do not
    align. A NULL or empty text has 0 bytes and 0 tokens; rows that share an id
    are rows of their own; ids may be NULL and of any type. Bytes that are not
    UTF-8 count as the replacement character. No rows give no rows.
    """
    if not 16 <= reach <= chunk // 4:
        raise ValueError("reach must lie between 16 and a quarter of chunk")
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        F.coalesce(F.char_length(text), F.lit(0)).alias("_size"),
        as_bytes(F.col(text)).alias("_text"),
    )
    counted = T.StructType([*rows.select("doc_id", "n_bytes").schema.fields, T.StructField("n_tokens", T.LongType())])

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _counts(batches, Pieces(shared.value))

    out = rows.filter(F.col("_size") <= chunk).drop("_size").mapInArrow(short, counted)
    long_rows = rows.filter(F.col("_size") > chunk).drop("_size").withColumn("row", F.monotonically_increasing_id())
    texts, _, some = written(long_rows, "long-texts")
    todo, totals = texts, []
    while some:
        size = max(chunk, 4 * reach)

        def cut(batches: Iterator[pa.RecordBatch], size: int = size, reach: int = reach) -> Iterator[pa.RecordBatch]:
            yield from _cut(batches, size, reach)

        def encoded(batches: Iterator[pa.RecordBatch], reach: int = reach) -> Iterator[pa.RecordBatch]:
            yield from _encoded(batches, Pieces(shared.value), reach)

        tasks = max(1, -(-int(todo.agg(F.sum("n_bytes")).first()[0]) // task_bytes))
        dealt = todo.select("row", "_text").mapInArrow(cut, _CHUNK).repartition(tasks, "row", "chunk")
        ends, _, _ = written(dealt.mapInArrow(encoded, _ENDS), "chunk-ends")
        total, _, some = written(_spliced(ends), "chunk-totals", where=~F.col("aligned"))
        totals.append(total.filter("aligned").select("row", "n_tokens"))
        todo = texts.join(total.filter("NOT aligned").select("row"), "row", "left_semi")
        reach *= WIDER
    for total in totals:
        out = out.unionByName(texts.drop("_text").join(total, "row").select("doc_id", "n_bytes", "n_tokens"))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
