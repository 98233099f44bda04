"""Language-model scores by context-tree weighting over bytes, and by single words.

A text is the line of its lower-cased words, a space after each, and a newline as its
end. Each byte is eight binary decisions; a node of the tree is a context of zero to
``DEPTH`` preceding bytes with the bits of the byte decided so far. A node's counts of
zeros and ones give its Krichevsky-Trofimov estimate. Weighting mixes it, half and half,
with the product of what the contexts one byte longer give, from the longest contexts up;
so a node's share in a prediction is known from the training texts alone.

The tree is never in one place. Counts of byte runs are summed by shuffles; subtrees
below contexts of ``TOP`` bytes are folded bucket by bucket, and the levels above by
grouping and joins. The texts of a chunk fetch the values of just the runs and words that
occur in it.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from quillmill.durable import durable
from quillmill.llm.chunks import in_chunks, pieces, runs, texts_of, unzipped, zipped
from quillmill.llm.language_id import held_out
from quillmill.llm.memory import given_back, giving_back

#: Bytes of the longest context, and of the contexts whose subtrees one task folds: such a
#: subtree has at most 2^24 runs, however large the corpus is.
DEPTH, TOP = 5, 3
#: Byte runs of a bucket of subtrees, and bytes of text looked at together.
BUCKET_RUNS, TOGETHER = 500_000, 500_000
#: Rows of a result that a worker hands over at once, and summed numbers that wait to be merged.
HANDED, WAITING = 50_000, 250_000
PAD, END, SPACE = b"\n" * DEPTH, b"\n", b" "
FOLDS = 10
LN2, LNPI = math.log(2), math.log(math.pi)
#: Value of a word that the training texts lack: log10 of the smoothing count alone.
NEVER = -1.0


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()  # of bytes: A-Z alone, and at U+0009 to U+000D and U+0020 alone


def line(words: list[bytes]) -> bytes:
    return (SPACE.join(words) + SPACE + END) if words else END


def byte_runs(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Number of each byte with the ``DEPTH`` bytes before it, line after line, and the lines' sizes."""
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    data = np.frombuffer(b"".join([PAD + x for x in lines]), np.uint8)
    run = np.zeros(len(data) - DEPTH, np.int64)
    for i in range(DEPTH + 1):
        run <<= 8
        run |= data[i : len(data) - DEPTH + i]
    inside = np.ones(len(data), bool)
    starts = np.cumsum(sizes + DEPTH) - (sizes + DEPTH)
    inside[(starts[:, None] + np.arange(DEPTH)).ravel()] = False
    return run[inside[DEPTH:]], sizes


def groups_of_lines(lines: Iterable[bytes]) -> Iterator[list[bytes]]:
    group, held = [], 0
    for x in lines:
        group.append(x)
        held += len(x)
        if held > TOGETHER:
            yield group
            group, held = [], 0
    if group:
        yield group


class Sums:
    """Sorted distinct numbers with their counts; parts are merged when they outgrow the whole."""

    def __init__(self):
        self.keys, self.counts, self.parts, self.held = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

    def add(self, numbers: np.ndarray, weight: int) -> None:
        keys, counts = np.unique(numbers, return_counts=True)
        self.parts.append((keys, counts * weight))
        self.held += len(keys)
        if self.held > max(len(self.keys), WAITING):
            self.total()

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([self.keys, *[p[0] for p in self.parts]])
        counts = np.concatenate([self.counts, *[p[1] for p in self.parts]])
        self.parts, self.held = [], 0
        order = np.argsort(keys)
        keys = keys[order]
        counts = counts[order]
        starts = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1))
        self.keys, self.counts = keys[starts], np.add.reduceat(counts, starts) if len(starts) else counts
        return self.keys, self.counts


def run_counts(stored: DataFrame) -> DataFrame:
    """``chunk, run, n``: how often each run of a chunk occurs in its training texts, 0 if in others only."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = None, Sums()
        for chunk, batch in runs(batches):
            if chunk != now and now is not None:
                yield from listed(now, sums)
                sums = Sums()
            now = chunk
            for learn in (True, False):
                texts = (text for piece in pieces(batch) for text in texts_of(piece.filter(pc.equal(piece.column("learn"), learn))))
                for group in groups_of_lines(map(line, map(words_of, texts))):
                    sums.add(byte_runs(group)[0], int(learn))
        if now is not None:
            yield from listed(now, sums)

    def listed(chunk: int, sums: Sums) -> Iterator[pa.RecordBatch]:
        keys, counts = sums.total()
        yield from pieces(pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), chunk)), pa.array(keys), pa.array(counts)], ["chunk", "run", "n"]), HANDED)

    return stored.select("chunk", "learn", "text").mapInArrow(giving_back(count), "chunk bigint, run bigint, n bigint")


def word_counts(stored: DataFrame) -> DataFrame:
    """``chunk, word, n``, in the same way; the end of a text is the word of one newline."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, learnt, seen = None, Counter(), set()
        for chunk, batch in runs(batches):
            if chunk != now and now is not None:
                yield from listed(now, learnt, seen)
                learnt, seen = Counter(), set()
            now = chunk
            for piece in pieces(batch):
                for text, learn in zip(texts_of(piece), piece.column("learn").to_pylist()):
                    (learnt if learn else seen).update([*words_of(text), END])
        if now is not None:
            yield from listed(now, learnt, seen)

    def listed(chunk: int, learnt: Counter, seen: set) -> Iterator[pa.RecordBatch]:
        seen.difference_update(learnt)
        words = sorted([*learnt, *seen])  # the same order whenever the task runs
        for at in range(0, len(words), HANDED):
            some = words[at : at + HANDED]
            columns = [pa.array(np.full(len(some), chunk)), pa.array(some, pa.binary()), pa.array([learnt[w] for w in some], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["chunk", "word", "n"])

    return stored.select("chunk", "learn", "text").mapInArrow(giving_back(count), "chunk bigint, word binary, n bigint")


def log_gamma(x):
    """ln of the gamma function for x >= 1/2, of arrays or columns, by Stirling's series at x + 8."""
    log = F.log if isinstance(x, Column) else np.log
    product, y = x, x + 8
    for i in range(1, 8):
        product = product * (x + i)
    square = y * y
    return (y - 0.5) * log(y) - y + math.log(2 * math.pi) / 2 + (1 / 12 - (1 / 360 - (1 / 1260 - 1 / (1680 * square)) / square) / square) / y - log(product)


def estimate(zeros, ones):
    """ln of the Krichevsky-Trofimov probability of so many zeros and ones; 0 for none."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - LNPI


def mixed(own: np.ndarray, longer: np.ndarray) -> np.ndarray:
    return np.logaddexp(own, longer) - LN2


def own_share(own: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """Share of a node's own estimate in its prediction; the rest is that of the longer context."""
    return 1 / (1 + np.exp(np.minimum(longer - own, 700)))


def next_is_one(zeros, ones):
    return (ones + 0.5) / (zeros + ones + 1.0)


def shorter(depth: int) -> int:
    """Bits of a node's number that are left when its context has ``depth`` bytes."""
    return (1 << 8 * (depth + 1)) - 1


class Level:
    """Nodes of one context length: number, counts, and ln of what longer contexts give."""

    def __init__(self, numbers: np.ndarray, zeros: np.ndarray, ones: np.ndarray, longer: np.ndarray | None = None):
        self.number, self.place = np.unique(numbers, return_inverse=True)
        size = len(self.number)
        self.zeros, self.ones = np.bincount(self.place, zeros, size), np.bincount(self.place, ones, size)
        self.own = estimate(self.zeros, self.ones)
        self.longer = None if longer is None else np.bincount(self.place, longer, size)
        self.weighted = self.own if longer is None else mixed(self.own, self.longer)

    def above(self, depth: int) -> Level:
        return Level(self.number & shorter(depth), self.zeros, self.ones, self.weighted)

    def predict(self, known: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Adds this level to the probability of a one known so far; ``rest`` is the share still open."""
        share = np.ones(len(self.own)) if self.longer is None else own_share(self.own, self.longer)
        return known + rest * share * next_is_one(self.zeros, self.ones), rest * (1 - share)


def subtree_levels(runs: np.ndarray, counts: np.ndarray, bit: int) -> tuple[list[Level], np.ndarray]:
    """Levels from contexts of ``DEPTH`` bytes to ``TOP`` at one bit of the byte, and that bit of each run."""
    byte = runs & 0xFF
    node = (runs & ~np.int64(0xFF)) | (1 << bit) | (byte >> (8 - bit))
    one = (byte >> (7 - bit)) & 1
    levels = [Level(node, counts * (1 - one), counts * one)]
    for depth in range(DEPTH - 1, TOP - 1, -1):
        levels.append(levels[-1].above(depth))
    return levels, one


def fold_subtrees(table: pa.Table) -> pa.Table:
    """``node, zeros, ones, weighted`` of the contexts of ``TOP`` bytes."""
    runs, counts = table.column("run").to_numpy(), table.column("n").to_numpy()
    tops = []
    for bit in range(8):
        top = subtree_levels(runs, counts, bit)[0][-1]
        tops.append(pa.table([pa.array(x) for x in (top.number, top.zeros, top.ones, top.weighted)], ["node", "zeros", "ones", "weighted"]))
    return pa.concat_tables(tops)


def price_runs(table: pa.Table, top: pa.Table) -> pa.Table:
    """``run, value``: log10 of a byte's probability behind the bytes before it."""
    runs, counts = table.column("run").to_numpy(), table.column("n").to_numpy()
    order = np.argsort(top.column("node").to_numpy())
    nodes, known, rest = (top.column(f).to_numpy()[order] for f in ("node", "known", "rest"))
    value = np.zeros(len(runs))
    for bit in range(8):
        levels, one = subtree_levels(runs, counts, bit)
        at = np.searchsorted(nodes, levels[-1].number)
        a, b = levels[-1].predict(known[at], rest[at])
        for lower, level in zip(levels[-2::-1], levels[:0:-1]):
            a, b = lower.predict(a[level.place], b[level.place])
        a = a[levels[0].place]
        value += np.log10(np.where(one == 1, a, 1 - a))
    return pa.table([pa.array(runs), pa.array(value)], ["run", "value"])


def run_values(counts: DataFrame) -> DataFrame:
    """``run, value`` of the *stored* ``run, n``; runs with n = 0 are priced, not learnt from."""
    buckets = max(1, -(-counts.count() // BUCKET_RUNS))
    top = F.shiftright("run", 8).bitwiseAND(F.lit((1 << 8 * TOP) - 1))
    dealt = counts.withColumn("bucket", F.pmod(F.xxhash64(top), F.lit(buckets)))
    level = durable(dealt.groupBy("bucket").applyInArrow(lambda table: given_back(fold_subtrees(table)), "node bigint, zeros double, ones double, weighted double"), "subtrees")
    nodes, levels = level, []
    for depth in range(TOP - 1, -1, -1):
        grouped = level.groupBy(F.col("node").bitwiseAND(F.lit(shorter(depth))).alias("node")).agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("longer"))
        own = grouped.withColumn("own", estimate(F.col("zeros"), F.col("ones")))
        more = F.greatest("own", "longer") + F.log1p(F.exp(-F.abs(F.col("own") - F.col("longer"))))
        level = durable(own.withColumn("weighted", more - LN2), "levels")
        levels.append((depth, level))
    known = None
    for depth, level in reversed(levels):
        share = 1 / (1 + F.exp(F.least(F.col("longer") - F.col("own"), F.lit(700.0))))
        if known is None:
            before = level.withColumns({"known": F.lit(0.0), "rest": F.lit(1.0)})
        else:
            before = level.withColumn("short", F.col("node").bitwiseAND(F.lit(shorter(depth - 1)))).join(known.withColumnRenamed("node", "short"), "short")
        known = before.select("node", (F.col("known") + F.col("rest") * share * next_is_one(F.col("zeros"), F.col("ones"))).alias("known"), (F.col("rest") * (1 - share)).alias("rest"))
    bucket = F.pmod(F.xxhash64(F.shiftright("node", 8).bitwiseAND(F.lit((1 << 8 * TOP) - 1))), F.lit(buckets))
    tops = nodes.select("node", bucket.alias("bucket"), F.col("node").bitwiseAND(F.lit(shorter(TOP - 1))).alias("short"))
    tops = tops.join(known.withColumnRenamed("node", "short"), "short").select("bucket", "node", "known", "rest")
    return dealt.groupBy("bucket").cogroup(tops.groupBy("bucket")).applyInArrow(lambda runs, top: given_back(price_runs(runs, top)), "run bigint, value double")


class Prices:
    """Values by run: the places of most are found by one look into a table of hashes, the others by bisection."""

    BITS = 21

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        self.hashed = np.zeros(1 << self.BITS, np.int32)
        self.hashed[self.place(self.keys)] = np.arange(len(keys), dtype=np.int32)

    def place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.BITS)).view(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        at = self.hashed[self.place(keys)]
        other = np.flatnonzero(self.keys[at] != keys)
        at[other] = np.searchsorted(self.keys, keys[other])
        return self.values[at]


def prices_of(values: pa.Table) -> tuple[dict[bytes, float], Prices]:
    """The values of a chunk's words, equal ones as one object, and of its runs."""
    price, equal, keys, of_run = {}, {}, [np.zeros(0, np.int64)], [np.zeros(0)]
    for some in pieces(values, HANDED):
        named = pc.is_valid(some.column("word"))
        words, rest = some.select(["word", "value"]).filter(named), some.select(["run", "value"]).filter(pc.invert(named))
        price.update(zip(words.column("word").to_pylist(), [equal.setdefault(x, x) for x in words.column("value").to_pylist()]))
        keys.append(rest.column("run").to_numpy())
        of_run.append(rest.column("value").to_numpy())
    return price, Prices(np.concatenate(keys), np.concatenate(of_run))


def score_chunk(texts: pa.Table, values: pa.Table) -> pa.Table:
    """Scores of the texts of a chunk, zipped, from the values of its runs and words."""
    price, prices = prices_of(values)
    keys, first, tokens, known = [], [], [], []

    def lines() -> Iterator[bytes]:
        for docs in unzipped(texts):
            keys.append(docs.select(["id", "learn"]))
            for piece in pieces(docs):
                for text in texts_of(piece):
                    words = words_of(text)
                    yield line(words)
                    words.append(END)
                    found = np.fromiter(map(price.__getitem__, words), float, len(words))
                    first.append(found.sum())
                    tokens.append(len(words))
                    known.append(int((found > NEVER).sum()))

    scores, sizes = [], []
    for group in groups_of_lines(lines()):
        run, size = byte_runs(group)
        scores.append(np.add.reduceat(prices.find(run), np.cumsum(size) - size))
        sizes.append(size)
    docs = pa.concat_tables(keys)
    columns = [docs.column("id"), docs.column("learn"), tokens, known, first, np.concatenate(scores), np.concatenate(sizes)]
    return pa.table([c if isinstance(c, pa.ChunkedArray) else pa.array(c) for c in columns], ["id", "learn", "n_tokens", "n_known", "base_score", "score", "n_bytes"])


SCORES = "id bigint, learn boolean, n_tokens bigint, n_known bigint, base_score double, score double, n_bytes bigint"


def scores(docs: DataFrame, id: str = "doc_id", text: str = "text", folds: int = FOLDS) -> DataFrame:
    """``id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte`` per row.

    Learns from the texts whose crc32 of the id as text is not divisible by ``folds``; texts
    without an id are learnt from. ``score`` is the log10 probability of the line under the
    tree, ``base_score`` that of its words and end by smoothed counts. Nothing is learnt
    from the scored texts on the way, so the order of rows is of no effect. Null texts are
    the end alone, repeated rows are learnt from and scored each, no rows give no rows;
    further columns are ignored.
    """
    stored = in_chunks(docs, {"id": F.col(id).cast("bigint"), "learn": ~held_out(F.col(id), folds)}, text)
    in_chunk = durable(run_counts(stored), "chunk-runs")
    per_run = durable(in_chunk.groupBy("run").agg(F.sum("n").alias("n")), "runs")
    rows = word_counts(stored).withColumn("row", F.monotonically_increasing_id())
    everywhere = Window.partitionBy("word")  # one row per chunk
    total = F.sum("n").over(everywhere)
    words = durable(rows.select("chunk", "word", "n", total.alias("count"), (F.col("row") == F.min("row").over(everywhere)).alias("first")), "words")
    learnt = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.coalesce(F.sum((F.col("first") & (F.col("count") > 0)).cast("bigint")), F.lit(0)).alias("distinct")).first()
    smooth = F.when(F.col("count") > 0, F.log10(F.col("count") + 0.1)).otherwise(F.lit(NEVER))
    of_words = words.select("chunk", F.lit(None).cast("bigint").alias("run"), "word", smooth.alias("value"))
    of_runs = in_chunk.select("chunk", "run").join(run_values(per_run), "run").select("chunk", "run", F.lit(None).cast("binary").alias("word"), "value")
    texts = zipped(stored.select("chunk", "id", "learn", "text")).groupBy("chunk")
    scored = texts.cogroup(of_words.unionByName(of_runs).groupBy("chunk")).applyInArrow(lambda texts, values: given_back(score_chunk(texts, values)), SCORES)
    smoothed = math.log10(learnt.tokens + 0.1 * (learnt.distinct + 1))
    bits = -F.col("score") * math.log2(10) / F.col("n_bytes")
    return scored.select("id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", F.lit(learnt.tokens).cast("bigint").alias("train_tokens"), (F.col("base_score") - F.col("n_tokens") * smoothed).alias("base_score"), "score", "n_bytes", bits.alias("bits_per_byte"))
