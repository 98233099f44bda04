"""Token ids in Arrow files of fixed-size lists, written and read by tasks.

A file holds the ids of a range of documents one after the other, cut into sequences of
equal length; only its last sequence is padded, and the mask says where. All record
batches but the last have the same number of sequences, so sequence ``k`` of a file is
found by arithmetic and is read without a copy from the mapped file. An index file beside
it has the place of each document.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from quillmill.durable import durable
from quillmill.llm.tokens import encode_texts, slices

SEQUENCE = 2048
BATCH = 64
#: Words that a worker keeps: this operator does little besides.
STORED_WORDS = 1_200_000
MANIFEST = "part int, path string, index_path string, documents bigint, tokens bigint"
INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def file_schema(kind: pa.DataType, sequence: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(kind, sequence)), ("mask", pa.list_(pa.bool_(), sequence))])


class SequenceWriter:
    """Cuts a stream of ids into equal sequences and writes them in equal batches."""

    def __init__(self, sink, kind: pa.DataType, sequence: int, batch: int):
        self.kind, self.sequence, self.size = kind, sequence, sequence * batch
        self.schema = file_schema(kind, sequence)
        self.file = pa.ipc.new_file(sink, self.schema)
        self.held: list[np.ndarray] = []
        self.waiting = self.tokens = 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.waiting += len(ids)
        self.tokens += len(ids)
        if self.waiting >= self.size:
            ids = np.concatenate(self.held)
            whole = len(ids) - len(ids) % self.size
            for at in range(0, whole, self.size):
                self._write(ids[at : at + self.size])
            self.held, self.waiting = [ids[whole:]], len(ids) - whole

    def _write(self, ids: np.ndarray) -> None:
        rows = -(-len(ids) // self.sequence)
        padded, mask = np.zeros(rows * self.sequence, ids.dtype), np.zeros(rows * self.sequence, bool)
        padded[: len(ids)], mask[: len(ids)] = ids, True
        arrays = [pa.FixedSizeListArray.from_arrays(pa.array(v), type=t.type) for v, t in zip((padded, mask), self.schema)]
        self.file.write_batch(pa.RecordBatch.from_arrays(arrays, schema=self.schema))

    def close(self) -> None:
        if self.waiting:
            self._write(np.concatenate(self.held))
        self.file.close()


def id_type(tokenizer: str, end_id: int = 0) -> pa.DataType:
    """The narrower type that holds all ids of the tokenizer, added tokens and the end id too."""
    largest = max(Tokenizer.from_file(tokenizer).get_vocab(with_added_tokens=True).values(), default=0)
    return pa.uint16() if max(largest, end_id) < 65_536 else pa.uint32()


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, id: str = "doc_id", text: str = "text", sequence: int = SEQUENCE) -> DataFrame:
    """Write the files under ``path`` (a URI all executors share); returns the manifest.

    Files follow each other by ``part`` in ascending id order, null ids first. Ids take
    two bytes if the tokenizer's largest id allows, else four. Null and empty texts are the end id alone;
    repeated rows are all written; an empty table gives no files. Each attempt of a task
    writes under names of its own and only those in the manifest count.
    """
    kind = id_type(tokenizer, end_id)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4").tobytes()
        files, root = fs.FileSystem.from_uri(path)
        part, writer, places = TaskContext.get().partitionId(), None, []
        name = f"{root}/part-{part:06d}-{uuid.uuid4().hex}"
        for batch in slices(batches):
            if writer is None:
                files.create_dir(root)
                sink = files.open_output_stream(f"{name}.arrow")
                writer = SequenceWriter(sink, kind, sequence, BATCH)
            for key, data in zip(batch.column(0).to_pylist(), encode_texts(tokenizer, False, batch.column(1).to_pylist(), STORED_WORDS)):
                ids = np.frombuffer(data + end, "<u4").astype(kind.to_pandas_dtype())
                places.append((key, writer.tokens, len(ids)))
                writer.add(ids)
        if writer is not None:
            writer.close()
            sink.close()
            with files.open_output_stream(f"{name}.index") as out, pa.ipc.new_file(out, INDEX) as index:
                index.write_table(pa.table([pa.array(c, t) for c, t in zip(zip(*places), INDEX.types)], schema=INDEX))
            row = [[part], [f"{name}.arrow"], [f"{name}.index"], [len(places)], [writer.tokens]]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, (pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64()))], ["part", "path", "index_path", "documents", "tokens"])

    rows = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return durable(ordered.mapInArrow(write, MANIFEST), "token-manifest")


def open_mapped(files: fs.FileSystem, path: str) -> pa.RecordBatchFileReader:
    """Reader on the mapped file where the file system is local, else on a seekable one."""
    return pa.ipc.open_file(pa.memory_map(path) if isinstance(files, fs.LocalFileSystem) else files.open_input_file(path))


def sequences(reader: pa.RecordBatchFileReader, first: int, n: int) -> np.ndarray:
    """Rows ``first`` to ``first + n`` of a file as views; copied only across batches."""
    size, found = reader.get_batch(0).num_rows, []
    while n > 0:
        batch = reader.get_batch(first // size).column(0)
        taken = batch.slice(first % size, n)
        found.append(taken.flatten().to_numpy(zero_copy_only=True).reshape(len(taken), -1))
        first, n = first + len(taken), n - len(taken)
    return found[0] if len(found) == 1 else np.concatenate(found)


def read_documents(manifest: DataFrame, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document from the files.

    ``start`` counts the ids of all documents before it. Files are read one per task.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = fs.FileSystem.from_uri(path)
        for row in (row for batch in batches for row in batch.to_pylist()):
            reader, index = open_mapped(files, row["path"]), open_mapped(files, row["index_path"]).read_all()
            starts, lengths = index.column("start").to_numpy(), index.column("n_tokens").to_numpy()
            crcs = [0] * len(starts)
            batch, at, ids = 0, 0, np.zeros(0, np.uint16)  # the batch at hand and the place of its first id
            for i, (start, n) in enumerate(zip(starts.tolist(), lengths.tolist())):
                while n:
                    while start >= at + len(ids):
                        at += len(ids)
                        ids = reader.get_batch(batch).column(0).flatten().to_numpy(zero_copy_only=True)
                        batch += 1
                    own = ids[start - at : start - at + n]
                    crcs[i] = zlib.crc32(own.astype("<u4"), crcs[i])
                    start, n = start + len(own), n - len(own)
            columns = [index.column("doc_id").combine_chunks(), pa.array(starts + row["base"]), pa.array(lengths), pa.array(crcs, pa.int64())]
            for at in range(0, len(crcs), 10_000):
                yield pa.RecordBatch.from_arrays([c.slice(at, 10_000) for c in columns], ["doc_id", "start", "n_tokens", "ids_crc32"])

    earlier = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    based = manifest.withColumn("base", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)))
    spread = based.repartition(max(1, manifest.count()), "path")
    return spread.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
