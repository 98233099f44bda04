"""What each of several filters removes, alone and in every order, from a document-term matrix.

The documents of a chunk become shards of a sparse matrix in compressed rows (CSR): row
bounds, word numbers and counts. Texts are cut into words once: a chunk numbers its words
as they come, one global dictionary numbers the words of all chunks, and each chunk then
exchanges its own numbers for the global ones. The sum of a row is the number of words and
its number of nonzero entries that of distinct words. With the flags of the other filters,
documents shrink to counts per part and set of failed filters, from which all orders follow.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from quillmill.durable import durable, scratch_path
from quillmill.llm.chunks import gathered, texts_of
from quillmill.llm.tokens import slices

#: Documents of a shard of the matrix, and words of a row of a chunk's dictionary.
SHARD_ROWS, WORD_ROWS = 250, 100_000
#: Bytes of text of a chunk: larger ones name each word less often.
CHUNK_BYTES = 24 << 20
FILTERS = "ABCDE"
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, MARKS = 200, 50, 3, "#$%&*|"
CONTINUED, CAPITALS = bytes(range(0x80, 0xC0)), bytes(range(0x41, 0x5B))


def traits(text: bytes) -> tuple[int, int, int, bytes]:
    """Code points, capitals and marks of a text, and its digest."""
    size = len(text)
    lacks = lambda some: size - len(text.translate(None, some))
    return size - lacks(CONTINUED), lacks(CAPITALS), lacks(MARKS.encode()), hashlib.sha256(text).digest()


class Codes(dict):
    """Number of each word of a chunk, in the order of the texts."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


WORDS = {"chunk": pa.int64(), "first": pa.int64(), "words": pa.list_(pa.binary())}
MATRIX = {"bounds": pa.int64(), "codes": pa.int32(), "counts": pa.int32()}
TRAITS = {"chars": pa.int32(), "capitals": pa.int32(), "marks": pa.int32(), "digest": pa.binary()}
SQL_TYPES = {pa.int64(): "bigint", pa.int32(): "int", pa.binary(): "binary"}


def coded_chunks(docs: DataFrame, columns: dict[str, Column], text: str = "text", size: int = CHUNK_BYTES) -> DataFrame:
    """Chunks of documents with word numbers of their own, stored as rows of two kinds.

    ``first, words`` lists a part of a chunk's words, numbered from ``first``. A shard has
    ``bounds, codes, counts``: row i are the words ``codes`` from ``bounds[i]`` to
    ``bounds[i + 1]``. What the other filters look at comes along, as the texts are read
    here anyway: ``chars, capitals, marks, digest`` and ``columns`` have one entry a document.
    A chunk holds neighbouring rows of one scan task and never a part of a document; a null
    text is empty and has an empty row.
    """
    names = list(columns)
    rows = gathered(docs, text, size).select(F.coalesce(F.col(text), F.lit("")).alias("text"), *[c.alias(name) for name, c in columns.items()])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, read, held, codes, shard, kinds = TaskContext.get().partitionId() << 24, 0, 0, Codes(), [], {}

        def row(first: int, words: list, matrix: tuple, rest: list) -> pa.RecordBatch:
            values = [words, *matrix, *(rest or [[]] * (len(TRAITS) + len(names)))]
            types = [pa.binary(), *MATRIX.values(), *TRAITS.values(), *kinds.values()]
            lists = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v, t)) for v, t in zip(values, types)]
            return pa.RecordBatch.from_arrays([pa.array([chunk + read // size]), pa.array([first]), *lists], [*WORDS, *MATRIX, *TRAITS, *kinds])

        def close_shard() -> Iterator[pa.RecordBatch]:
            if shard:
                found, counts, *rest = zip(*shard)
                bounds = np.cumsum([0, *map(len, found)])
                yield row(0, [], (bounds, np.concatenate(found), np.concatenate(counts)), rest)
                shard.clear()

        def close_chunk() -> Iterator[pa.RecordBatch]:
            yield from close_shard()
            words = list(codes)
            for at in range(0, len(words), WORD_ROWS):
                yield row(at, words[at : at + WORD_ROWS], ([], [], []), [])
            codes.clear()

        for batch in slices(batches):
            kinds = {name: batch.schema.field(name).type for name in names}
            for body, *rest in zip(texts_of(batch), *[batch.column(name).to_pylist() for name in names]):
                if (read + held) // size > read // size:
                    yield from close_chunk()
                    read, held = read + held, 0
                elif len(shard) == SHARD_ROWS:
                    yield from close_shard()
                words = Counter(body.split())  # of bytes: at U+0009 to U+000D and U+0020 alone
                found = np.fromiter(map(codes.__getitem__, words), np.int32, len(words))
                shard.append((found, np.fromiter(words.values(), np.int32, len(words)), *traits(body), *rest))
                held += len(body)
        yield from close_chunk()

    listed = [f"`{name}` array<{SQL_TYPES[kind]}>" for name, kind in (MATRIX | TRAITS).items()]
    carried = [f"`{name}` array<{rows.schema[name].dataType.simpleString()}>" for name in names]
    coded = rows.mapInArrow(deal, ", ".join(["chunk bigint, first bigint, words array<binary>", *listed, *carried]))
    path = scratch_path(docs.sparkSession, "coded")
    # a row is large: row groups are kept small, as a reader holds a whole one
    coded.write.options(**{"compression": "zstd", "parquet.block.size": 32 << 20, "parquet.block.size.row.check.min": 8}).parquet(path)
    return docs.sparkSession.read.schema(coded.schema).parquet(path)


def dictionary(coded: DataFrame) -> DataFrame:
    """``chunk, code, word, term`` where ``term`` is one number for all rows of a word, the least of their row numbers.

    A word has one row per chunk, so no word stands out.
    """
    rows = coded.where(F.size("words") > 0).select("chunk", "first", F.posexplode("words").alias("pos", "word"))
    rows = rows.select("chunk", (F.col("first") + F.col("pos")).alias("code"), "word", F.monotonically_increasing_id().alias("row"))
    return rows.select("chunk", "code", "word", F.min("row").over(Window.partitionBy("word")).alias("term"))


def term_shards(coded: DataFrame) -> DataFrame:
    """The shards of ``coded_chunks`` with ``terms``, the numbers of ``dictionary``, in place of ``codes``."""
    known = dictionary(coded).select("chunk", "code", "term")
    shards = coded.where(F.size("bounds") > 0).drop("first", "words")
    kept = [f for f in shards.schema.fields if f.name not in ("chunk", "codes")]

    def exchange(shards: pa.Table, words: pa.Table) -> pa.Table:
        number = np.zeros(words.num_rows, np.int64)
        number[words.column("code").to_numpy()] = words.column("term").to_numpy()
        codes = shards.column("codes").combine_chunks()
        ends = np.concatenate(([0], np.cumsum(pc.list_value_length(codes).to_numpy()))).astype(np.int32)
        terms = pa.ListArray.from_arrays(pa.array(ends), pa.array(number[codes.flatten().to_numpy()]))
        return shards.select([f.name for f in kept]).append_column("terms", terms)

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], "terms array<bigint>"])
    return shards.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(exchange, schema)


def row_counts(shards: DataFrame) -> DataFrame:
    """``words, distinct`` of every row, its sum and number of nonzero entries, and its other columns."""
    rest = [f for f in shards.schema.fields if f.name not in ("bounds", "terms", "counts")]
    names = ["words", "distinct", *[f.name for f in rest]]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                bounds, counts, *others = (column[i].values for column in batch.columns)
                sums = np.concatenate(([0], np.cumsum(counts.to_numpy(), dtype=np.int64)))
                bounds = bounds.to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(np.diff(sums[bounds])), pa.array(np.diff(bounds)), *others], names)

    schema = ", ".join(["words bigint, distinct bigint", *[f"`{f.name}` {f.dataType.elementType.simpleString()}" for f in rest]])
    return shards.select("bounds", "counts", *[f.name for f in rest]).mapInArrow(count, schema)


def failures(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """``part, mask, documents, good, toxic``: how many documents fail which filters.

    Bit i of ``mask`` is the filter ``FILTERS[i]``. A null text is empty, a null part the
    empty string, and repeated rows count each. The last filter takes every document whose
    text a smaller id has too; a null id is larger than all others and has no labels. Of
    several labels of a document, any 1 counts. No documents give no rows.
    """
    coded = coded_chunks(docs, {"id": F.col(id), "part": F.coalesce(F.col(part), F.lit(""))}, text)
    flags = [
        F.col("words") < LEAST_WORDS,
        100 * F.col("distinct") < DISTINCT_PERCENT * F.col("words"),
        100 * F.col("capitals").cast("bigint") > CAPITAL_PERCENT * F.col("chars").cast("bigint"),
        F.col("marks") > 0,
    ]
    mask = sum((F.when(flag, F.lit(1 << i)).otherwise(F.lit(0)) for i, flag in enumerate(flags)), F.lit(0))
    flagged = row_counts(term_shards(coded)).select("digest", "id", "part", mask.alias("mask"))
    # copies shrink to counts before they are compared, so that no group of them meets in one task
    copies = durable(flagged.groupBy("digest", "id", "part", "mask").agg(F.count(F.lit(1)).alias("n")), "copies")
    first = copies.groupBy("digest").agg(F.min("id").alias("first"))
    named = copies.where(F.col("id").isNotNull()).alias("c")
    named = named.join(first.alias("f"), (F.col("c.digest") == F.col("f.digest")) & (F.col("c.id") == F.col("f.first")), "left")
    named = named.select("c.id", "c.part", "c.mask", "c.n", F.col("f.first").isNull().alias("repeats"))
    nameless = copies.where(F.col("id").isNull()).join(first, "digest").select("id", "part", "mask", "n", F.col("first").isNotNull().alias("repeats"))
    known = labels.groupBy(F.col("doc_id").alias("id")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    labelled = named.unionByName(nameless).join(known.where(F.col("id").isNotNull()), "id", "left")
    full = F.col("mask") + F.when(F.col("repeats"), F.lit(1 << (len(FILTERS) - 1))).otherwise(F.lit(0))
    share = lambda flag: F.sum(F.when(F.col(flag), F.col("n")).otherwise(F.lit(0)))
    return labelled.groupBy("part", full.alias("mask")).agg(F.sum("n").alias("documents"), share("good").alias("good"), share("toxic").alias("toxic"))


def every_order(failed: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from the counts of ``failures``.

    ``kept`` remain after the step and ``removed`` go in it; ``redundant`` fail its filter but
    went before, ``unique_fails`` fail no other; ``shapley`` sums the removed over all orders.
    """
    bit = {f: 1 << i for i, f in enumerate(filters)}
    orders = ["".join(p) for p in itertools.permutations(filters)]
    steps = [(o, k + 1, bit[o[k]], sum(bit[f] for f in o[:k])) for o in orders for k in range(len(o))]
    listed = F.from_json(F.lit(str([list(s) for s in steps]).replace("'", '"')), "array<array<string>>")
    rows = failed.withColumn("s", F.explode(listed)).select("part", "mask", "documents", "good", "toxic", F.col("s")[0].alias("filter_order"), F.col("s")[1].cast("int").alias("step"), F.col("s")[2].cast("int").alias("own"), F.col("s")[3].cast("int").alias("before"))
    mask = F.col("mask")
    fails, gone = mask.bitwiseAND(F.col("own")) > 0, mask.bitwiseAND(F.col("before")) > 0
    total = lambda when, what="documents": F.sum(F.when(when, F.col(what)).otherwise(F.lit(0)))
    turns = F.lit(math.factorial(len(filters))) / F.greatest(F.bit_count(mask), F.lit(1))  # a failed filter comes first of all failed ones so often
    return rows.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone).alias("kept"),
        total(fails & ~gone).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(mask == F.col("own")).alias("unique_fails"),
        total(fails & ~gone, "good").alias("good_lost"),
        total(fails & ~gone, "toxic").alias("toxic_lost"),
        F.sum(F.when(fails, F.col("documents") * turns.cast("bigint")).otherwise(F.lit(0))).alias("shapley"),
    )
