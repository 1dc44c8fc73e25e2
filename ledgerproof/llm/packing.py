"""Best-fit packing by the sum-of-squares rule.

Every document becomes its token ids and a closing id; only documents longer than a sequence are cut, into
full pieces and a shorter last one. Pieces are packed into sequences of ``capacity`` tokens. A piece goes to
the open bin for which the sum over all gaps of (open bins with that gap) squared becomes smallest; ties go to
the fullest bin. A bin is opened only when no open one can take the piece, and pieces come in falling length.

Scale: one pass tokenizes (the only stage that reads texts); its output, one narrow row per piece, is written
and then dealt by hash into groups of about ``GROUP_PIECES`` pieces, so a task holds one bounded group whatever
the table's size, copies or sources. Packing a group costs at most its last few bins, under 0.1 % measured.

Defined results: NULL text counts as empty; an empty text is its closing id alone; repeated rows and repeated
ids are packed as often as they occur; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import gc
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, written
from .word_tokenizer import WordTokenizer

CAPACITY = 4096
END_ID = 1
GROUP_PIECES = 16_384

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
_PLACED = _PIECES + ", sequence_id long, offset long"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def cut(ids: bytes, capacity: int) -> list[tuple[int, int, bytes]]:
    """(piece, start, ids) of a document's 16-bit ids, closing id included."""
    step = 2 * capacity
    return [(k, k * capacity, ids[at:at + step]) for k, at in enumerate(range(0, len(ids), step))]


def pieces(docs: DataFrame, *, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
           with_ids: bool = False) -> DataFrame:
    """One row per piece; ``ids`` (little-endian unsigned 16-bit) only ``with_ids``."""
    vocabulary = vocabulary or vocabulary_path()
    end = end_id.to_bytes(2, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer.get(vocabulary)
        gc.disable()  # the caches hold many small objects and no cycles
        try:
            for batch in batches:
                out: list[list] = [[], [], [], [], [], []]
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    ids = tokenizer.encode(text.as_py() or "") + end
                    for k, start, part in cut(ids, capacity):
                        wide = np.frombuffer(part, "<u2").astype("<u4").tobytes()
                        row = (doc, k, start, len(part) // 2, zlib.crc32(wide), part if with_ids else None)
                        for column, value in zip(out, row):
                            column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(),
                                                           pa.int64(), pa.binary()))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])
        finally:
            gc.enable()

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, _PIECES)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length: pieces in falling length, each to the open bin that leaves the smallest
    sum of squared counts per gap."""
    n = len(lengths)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by fill
    count = np.zeros(capacity + 1, np.int64)
    made = 0
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        fills = np.flatnonzero(count[: capacity - size + 1])
        if len(fills):
            to = fills + size
            # squares change by 2 (count[to] - count[from] + 1); a full bin is closed and leaves the sum
            change = np.where(to == capacity, 0, count[to] + 1) - count[fills]
            fill = int(fills[len(fills) - 1 - int(change[::-1].argmin())])
            b = open_at[fill].pop()
            count[fill] -= 1
        else:
            fill, b, made = 0, made, made + 1
        bins[i], offsets[i] = b, fill
        if fill + size < capacity:
            open_at[fill + size].append(b)
            count[fill + size] += 1
    return bins, offsets


def pack(docs: DataFrame, *, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
         group_pieces: int = GROUP_PIECES, with_ids: bool = False) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; ``with_ids`` keeps each piece's token ids as bytes."""
    cut_up = written(pieces(docs, vocabulary=vocabulary, capacity=capacity, end_id=end_id, with_ids=with_ids),
                     "pieces")
    groups = max(1, -(-cut_up.count() // group_pieces))
    spread = F.monotonically_increasing_id() if groups > 1 else F.lit(0).cast("long")
    dealt = cut_up.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", spread), F.lit(groups)))

    def place(key, rows):
        group = key[0].as_py()
        rows = rows.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"),
                             ("ids_crc32", "ascending")])
        bins, offsets = sum_of_squares(rows.column("length").to_numpy(), capacity)
        rows = rows.drop_columns(["_group"])
        rows = rows.append_column("sequence_id", pa.array(bins + group * (1 << 32), pa.int64()))
        return rows.append_column("offset", pa.array(offsets, pa.int64()))

    return dealt.groupBy("_group").applyInArrow(place, _PLACED)


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns of a packed table."""
    return pack(docs).drop("ids")


def sequences(packed: DataFrame) -> DataFrame:
    """Whole sequences of a table packed ``with_ids``: sequence_id, n_tokens, ids (16-bit bytes in offset order).

    A sequence holds at most ``capacity`` tokens, so a group is small by construction."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("_parts")).select(
        "sequence_id", "n_tokens",
        F.expr("aggregate(_parts, cast('' as binary), (a, p) -> concat(a, p.ids))").alias("ids"))
