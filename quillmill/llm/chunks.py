"""Documents dealt into chunks of bounded size, and the words and values that a chunk needs.

Looking every word of every text up in a table that is too large to be broadcast would
shuffle all words. A chunk of texts instead fetches each of its distinct words once, and
is then worked on in one task with just that part of the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from quillmill.durable import scratch_path

#: Bytes of text after which a chunk ends; a document is never cut.
CHUNK_BYTES = 24 << 20
#: Rows whose texts are looked at or handed over at once, and rows of a compressed stream.
PIECE_ROWS, ZIPPED_ROWS = 500, 2_000


def gathered(docs: DataFrame, text: str, size: int) -> DataFrame:
    """The rows in so few scan tasks that a chunk of ``size`` bytes can be filled."""
    whole = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("bytes")).first()["bytes"]
    return docs.coalesce(max(docs.sparkSession.sparkContext.defaultParallelism, 1 + whole // size))


def in_chunks(docs: DataFrame, columns: dict[str, Column], text: str = "text", size: int = CHUNK_BYTES) -> DataFrame:
    """``chunk, unit, text`` and ``columns`` of every row, stored.

    A chunk holds neighbouring rows of one scan task; tasks of small splits take several,
    as the fewer the chunks, the fewer words are fetched. ``unit`` numbers the rows, so that
    repeated rows stay apart; a null text is empty.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = gathered(docs, text, size).select(F.monotonically_increasing_id().alias("unit"), body.alias("text"), *[c.alias(name) for name, c in columns.items()])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, first = 0, TaskContext.get().partitionId() << 24
        for batch in batches:
            sizes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = before + np.cumsum(sizes)
            chunk = first + (ends - sizes) // size
            before = int(ends[-1]) if len(ends) else before
            yield from pieces(pa.RecordBatch.from_arrays([pa.array(chunk), *batch.columns], ["chunk", *batch.schema.names]))

    schema = ", ".join(["chunk bigint", *[f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields]])
    dealt, path = rows.mapInArrow(deal, schema), scratch_path(docs.sparkSession, "chunks")
    dealt.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(dealt.schema).parquet(path)


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[pa.RecordBatch]]]:
    """Batches cut where ``chunk`` changes, as ``(chunk, batch)`` pairs in the order they come."""
    for batch in batches:
        chunk = batch.column("chunk").to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(chunk)]
        for start, end in zip(cuts, cuts[1:]):
            if end > start:
                yield int(chunk[start]), batch.slice(start, end - start)


def pieces(batch: pa.RecordBatch | pa.Table, rows: int = PIECE_ROWS) -> Iterator[pa.RecordBatch | pa.Table]:
    """The batch, so many rows at a time."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def texts_of(batch: pa.RecordBatch | pa.Table) -> list[bytes]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def zipped(stored: DataFrame) -> DataFrame:
    """``chunk, rows``: the rows of a chunk, ``ZIPPED_ROWS`` at a time, as compressed Arrow streams.

    Texts so pass a shuffle, and wait in the task behind it, at a fraction of their size.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, batch in runs(batches):
            for piece in pieces(batch, ZIPPED_ROWS):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                    stream.write_batch(piece)
                yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["chunk", "rows"])

    return stored.mapInArrow(pack, "chunk bigint, rows binary")


def unzipped(table: pa.Table) -> Iterator[pa.Table]:
    """The rows of ``zipped``, one stream at a time."""
    for rows in table.column("rows"):
        with pa.ipc.open_stream(rows.as_buffer()) as stream:
            yield stream.read_all()
