"""Ranked lexical search in buckets of vectors of similar length, after LEMP.

A document is the vector of its impacts, one coordinate per term of the items, and an
item that of its term weights; the score is their inner product. Documents are stored by
descending length. The longest ones are searched first and give each item the score of
its k-th best document. A shorter bucket is left out for an item when the product of both
lengths, the largest possible score (Cauchy-Schwarz), is below that; inside a bucket,
bounds on the items' largest coordinates leave few documents, which are scored exactly in
integers.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from quillmill.durable import durable
from quillmill.operators.positions import number_rows

#: Items searched together: their terms and weights are sent to all tasks.
ITEMS = 1_000
#: Documents of a bucket inside a task, and the share of documents that are searched first.
BUCKET = 4_096
LONGEST = 1 / 64
#: Coordinates of an item that are bounded.
FOCUS = 3
#: Room for rounding in the bounds, which are in doubles.
SLACK = 1e-9
#: Fixed values of the score.
SCALE, SATURATION, LENGTH_SHARE, LENGTH_WEIGHT = 1_000_000_000, 1_000, 50, 20
#: Bytes that part terms become spaces; A-Z are lowered, all bytes of other characters belong to terms.
TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


def term_vectors(docs: DataFrame, numbers: dict[bytes, int], id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n, terms, tfs`` of every document with a term: how often it has the numbered ones."""
    shared = docs.sparkSession.sparkContext.broadcast(numbers)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        for batch in batches:
            ids, lengths, terms, tfs = [], [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                found = terms_of(text or b"")
                if found:
                    had = Counter(found)
                    common = had.keys() & wanted.keys()
                    ids.append(key)
                    lengths.append(len(found))
                    terms.append(list(map(wanted.__getitem__, common)))
                    tfs.append(list(map(had.__getitem__, common)))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))], ["id", "n", "terms", "tfs"])

    return docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).alias("text")).mapInArrow(count, "id bigint, n bigint, terms array<int>, tfs array<bigint>")


def flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column one after the other, and the row of each."""
    sizes = np.diff(column.offsets.to_numpy())
    return column.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(sizes)), sizes)


def document_penalty(n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """``m`` of documents with ``n`` terms, exact beyond 64 bits too."""
    if len(n) and 50 * int(n.max()) * documents >= 1 << 63:
        return np.array([100 - LENGTH_SHARE + (LENGTH_SHARE * int(x) * documents) // total for x in n], np.int64)
    return 100 - LENGTH_SHARE + (LENGTH_SHARE * n * documents) // max(total, 1)


def impact_vectors(vectors: DataFrame, documents: int, total: int) -> DataFrame:
    """``id, norm, terms, impacts`` of the vectors with a coordinate."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("tfs")
            tfs, row = flat(lists)
            m = document_penalty(batch.column("n").to_numpy(), documents, total)
            impacts = (SCALE * tfs) // (SATURATION * tfs + LENGTH_WEIGHT * m[row])
            norm = np.sqrt(np.bincount(row, impacts.astype(np.float64) ** 2, batch.num_rows))
            found = pa.ListArray.from_arrays(pa.array(lists.offsets.to_numpy() - lists.offsets[0].as_py(), pa.int32()), pa.array(impacts))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(norm), batch.column("terms"), found], ["id", "norm", "terms", "impacts"])

    return vectors.where(F.size("terms") > 0).mapInArrow(weigh, "id bigint, norm double, terms array<int>, impacts array<bigint>")


@dataclass
class Items:
    """Term numbers (largest weight first) and weights of each item."""

    terms: list[np.ndarray]
    weights: list[np.ndarray]
    norms: np.ndarray


def first_k(ids: np.ndarray, nameless: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, nameless, -scores))[:k]


def search_bucket(items: Items, floors: np.ndarray, best: list, ids: np.ndarray, nameless: np.ndarray, norms: np.ndarray, terms: np.ndarray, impacts: np.ndarray, row: np.ndarray, k: int) -> None:
    """Merge the bucket's documents into ``best``; raises ``floors`` to the k-th best scores."""
    longest = norms.max()
    active = np.flatnonzero(items.norms * longest * (1 + SLACK) >= floors)
    if not len(active):
        return
    order = np.argsort(terms, kind="stable")
    of_term, rows, values = terms[order], row[order], impacts[order]
    for q in active.tolist():
        starts, ends = np.searchsorted(of_term, items.terms[q]), np.searchsorted(of_term, items.terms[q], "right")
        possible = np.ones(len(ids), bool)
        least = min(floors[q] / (items.norms[q] * longest), 1.0) if items.norms[q] else 0.0
        if least > 0:
            for f in range(min(FOCUS, len(starts))):
                own = items.weights[q][f] / items.norms[q]
                room = math.sqrt(max(1 - own * own, 0.0) * (1 - least * least)) + SLACK
                most = 1 + SLACK if own >= least else own * least + room
                at = slice(starts[f], ends[f])
                share = np.zeros(len(ids))
                share[rows[at]] = values[at] / norms[rows[at]]
                possible &= (share >= own * least - room) & (share <= most)
        scores = np.zeros(len(ids), np.int64)
        for w, a, b in zip(items.weights[q].tolist(), starts.tolist(), ends.tolist()):
            here = rows[a:b]
            inside = possible[here]
            scores[here[inside]] += w * values[a:b][inside]
        found = np.flatnonzero((scores > 0) & (scores >= floors[q]))
        if len(found):
            merged = [np.concatenate(pair) for pair in zip(best[q], (ids[found], nameless[found], scores[found]))]
            top = first_k(*merged, k)
            best[q] = tuple(column[top] for column in merged)
            if len(top) == k:
                floors[q] = max(floors[q], int(best[q][2][-1]))


def search(buckets: DataFrame, items: Items, floors: np.ndarray, k: int) -> DataFrame:
    """``item, id, score``: of each task, the ``k`` best documents of every item that reach its floor."""
    shared = buckets.sparkSession.sparkContext.broadcast((items, floors))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned, reached = shared.value[0], shared.value[1].copy()
        nothing = (np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))
        best = [nothing] * len(reached)
        for whole in batches:
            for at in range(0, whole.num_rows, BUCKET):
                batch = whole.slice(at, BUCKET)
                terms, row = flat(batch.column("terms"))
                impacts, _ = flat(batch.column("impacts"))
                key = batch.column("id")
                search_bucket(learned, reached, best, key.fill_null(0).to_numpy(), key.is_null().to_numpy(zero_copy_only=False), batch.column("norm").to_numpy(), terms, impacts, row, k)
        item = np.repeat(np.arange(len(best)), [len(b[0]) for b in best])
        ids, nameless, scores = (np.concatenate([b[i] for b in best] or [nothing[i]]) for i in range(3))
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(ids, mask=nameless), pa.array(scores)], ["item", "id", "score"])

    return buckets.select("id", "norm", "terms", "impacts").mapInArrow(find, "item int, id bigint, score bigint")


def ranked(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id")))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def term_weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def search_block(docs: DataFrame, block: list[tuple], k: int, id: str, text: str) -> DataFrame:
    spark = docs.sparkSession
    wanted = [sorted(set(terms_of((t or "").encode("utf-8", "replace")))) for _, t in block]
    numbers = {t: i for i, t in enumerate(sorted(set().union(*wanted)))}
    vectors = durable(term_vectors(docs, numbers, id, text), "term-vectors")
    total = vectors.agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    counted = dict(map(tuple, vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect()))  # at most the items' terms
    weight = np.array([term_weight(total.documents, counted.get(i, 0)) for i in range(len(numbers))], np.int64)
    terms = [np.array(sorted((numbers[t] for t in w), key=lambda i: (-weight[i], i)), np.int32) for w in wanted]
    items = Items(terms, [weight[t] for t in terms], np.array([math.sqrt(float((weight[t].astype(float) ** 2).sum())) for t in terms]))
    weighed = impact_vectors(vectors, total.documents, total.terms)
    # range bounds are sampled, so the order is stored once
    buckets = durable(weighed.repartitionByRange(F.desc("norm"), "id").sortWithinPartitions(F.desc("norm")), "norm-buckets")
    cut = buckets.agg(F.percentile_approx("norm", F.lit(1 - LONGEST), 1_000).alias("cut")).first().cut or 0.0
    longest = durable(ranked(search(buckets.where(F.col("norm") >= cut), items, np.ones(len(block), np.int64), k), k), "longest")
    floors = np.ones(len(block), np.int64)
    for r in longest.where(F.col("rank") == k).select("item", "score").collect():  # one row an item
        floors[r["item"]] = r["score"]
    reach = min([f / n for f, n in zip(floors.tolist(), items.norms.tolist()) if n], default=0.0) * (1 - SLACK)
    others = search(buckets.where((F.col("norm") < cut) & (F.col("norm") >= reach)), items, floors, k)
    best = ranked(longest.drop("rank").unionByName(others), k)
    names = spark.createDataFrame([(i, key) for i, (key, _) in enumerate(block)], "item int, item_id bigint")
    return best.join(names, "item").select("item_id", "rank", F.col("id").alias("doc_id"), "score")


def best_documents(docs: DataFrame, items: DataFrame, k: int = 50, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", block: int = ITEMS) -> DataFrame:
    """``item_id, rank, doc_id, score`` of the ``k`` best documents of each item, with scores above 0.

    Equal scores rank by ascending id, null ids last. Repeated documents rank each, and
    rows that agree in item id and text are one item. Null texts have no terms. Items are
    searched in blocks, each against all documents; no rows of either give no rows.
    """
    distinct = items.select(F.col(item_id).cast("bigint").alias("item_id"), F.col(item_text).alias("text")).distinct()
    numbered = durable(number_rows(distinct, ["item_id", "text"], name="place"), "items")
    found = None
    for start in range(0, max(numbered.count(), 1), block):
        rows = numbered.where((F.col("place") >= start) & (F.col("place") < start + block)).collect()
        part = search_block(docs, [(r["item_id"], r["text"]) for r in rows], k, id, text)
        found = part if found is None else found.unionByName(part)
    return found
