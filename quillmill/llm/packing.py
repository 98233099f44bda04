"""Documents packed into training sequences by the sum-of-squares rule.

A piece goes where the squared counts of open sequences per residual gap become smallest
in sum. Pieces come longest first and a sequence is opened only when no open one has
room, which on mixed lengths leaves about one sequence per task unfilled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quillmill.durable import durable
from quillmill.llm.memory import giving_back
from quillmill.llm.tokens import STORED_WORDS, encode_texts, slices

CAPACITY = 4096
#: Pieces that one task packs. It holds their lengths only.
PIECES_PER_TASK = 100_000


def encode_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 1, id: str = "doc_id", text: str = "text", keep_ids: bool = True, stored_words: int = STORED_WORDS) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and ``ids`` of every document.

    A document is its ids and ``end_id``; a longer one than ``capacity`` is cut into full
    pieces and a rest. Null and empty texts are the end id alone. Repeated rows and null
    ids are documents of their own. Further columns are ignored.
    """

    @giving_back
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4").tobytes()
        for batch in slices(batches):
            keys = batch.column(0).to_pylist()
            rows, parts = [], []
            for key, data in zip(keys, encode_texts(tokenizer, True, batch.column(1).to_pylist(), stored_words)):
                data += end
                for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    rows.append((key, piece, at // 4, len(part) // 4, zlib.crc32(part)))
                    if keep_ids:
                        parts.append(part)
            columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            if keep_ids:
                offsets = np.concatenate(([0], np.cumsum([len(p) // 4 for p in parts], dtype=np.int32))).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), "<i4"))))
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * keep_ids
    return docs.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(encode, schema)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each length, placed in the given order.

    Moving a sequence from gap g to gap g - s changes the sum of squares by
    2 (N[g - s] - N[g] + 1), and closing one (g = s) by 1 - 2 N[s].
    """
    open_at = np.zeros(capacity + 1, dtype=np.int64)
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset, used = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    nowhere = np.iinfo(np.int64).max
    for i, s in enumerate(lengths.tolist()):
        now = open_at[s:capacity]
        change = 2 * (open_at[: capacity - s] - now + 1)
        if s < capacity:
            change[0] = 1 - 2 * now[0]
        change[now == 0] = nowhere
        best = int(change.argmin()) if s < capacity else -1
        if best < 0 or change[best] == nowhere:
            gap, chosen, used = capacity, used, used + 1
        else:
            gap = best + s
            chosen = by_gap[gap].pop()
            open_at[gap] -= 1
        sequence[i], offset[i] = chosen, capacity - gap
        if gap > s:
            by_gap[gap - s].append(chosen)
            open_at[gap - s] += 1
    return sequence, offset


def pack(pieces: DataFrame, capacity: int = CAPACITY, per_task: int = PIECES_PER_TASK) -> DataFrame:
    """``unit, sequence_id, offset`` of a *stored* frame of ``unit, length``.

    Full pieces are sequences already. The others are dealt out to tasks by a hash of
    ``unit``, which must be unique; lengths lie between 1 and ``capacity``.
    """
    full = pieces.where(F.col("length") == capacity)
    rest = pieces.where(F.col("length") < capacity)
    tasks = max(1, -(-rest.count() // per_task))

    def place(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "unit"], ascending=[False, True])
        sequence, offset = sum_of_squares(group["length"].to_numpy(), capacity)
        return pd.DataFrame({"unit": group["unit"], "sequence_id": sequence * tasks + key[0], "offset": offset})

    dealt = rest.select("unit", "length", F.pmod(F.xxhash64("unit"), F.lit(tasks)).alias("task"))
    packed = dealt.groupBy("task").applyInPandas(place, "unit bigint, sequence_id bigint, offset bigint")
    return packed.unionByName(full.select("unit", (-1 - F.col("unit")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 1, id: str = "doc_id", text: str = "text", keep_ids: bool = True, stored_words: int = STORED_WORDS) -> DataFrame:
    """The pieces of ``encode_pieces`` with ``sequence_id`` and ``offset``.

    Sequences are gapless from offset 0 and hold at most ``capacity`` tokens. Texts are
    encoded once: the pieces are written before their places are found. ``stored_words``
    bounds what a worker remembers and changes no result.
    """
    encoded = encode_pieces(docs, tokenizer, capacity, end_id, id, text, keep_ids, stored_words)
    stored = durable(encoded.withColumn("unit", F.monotonically_increasing_id()), "pieces")
    placed = pack(stored.select("unit", "length"), capacity)
    return stored.join(placed, "unit").drop("unit")
