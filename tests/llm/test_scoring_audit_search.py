"""Language-model scores, the filter audit and ranked search against plain versions of their rules."""

import hashlib
import itertools
import math
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillmill.llm import chunks, filter_audit, lexical_search, lm_scoring, queries

from .conftest import SF

SPACES = re.compile(rb"[^\x20\x09-\x0D]+")


def held_out(id):
    return id is not None and zlib.crc32(str(id).encode()) % 10 == 0


class Node:
    """A context of the tree, by its definition: counts, longer contexts, block probabilities."""

    def __init__(self):
        self.n, self.longer = [0, 0], {}

    def add(self, context, bit):
        self.n[bit] += 1
        if context:
            self.longer.setdefault(context[-1], Node()).add(context[:-1], bit)

    def estimate(self):
        a, b = self.n
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(self, depth):
        if not depth:
            return self.estimate()
        own, longer = self.estimate(), sum(x.weighted(depth - 1) for x in self.longer.values())
        return max(own, longer) + math.log1p(math.exp(-abs(own - longer))) - math.log(2)


def tree_by_hand(rows):
    """log10 probability of each line: ratios of weighted block probabilities with and without the bit."""
    tree, lines = {}, [b"".join(w + b" " for w in SPACES.findall((t or "").encode().lower())) + b"\n" for _, t in rows]

    def bits(line):
        padded = b"\n" * lm_scoring.DEPTH + line
        for i, byte in enumerate(line):
            for k in range(8):
                yield (1 << k | byte >> (8 - k)), padded[i : i + lm_scoring.DEPTH], byte >> (7 - k) & 1

    for (id, _), line in zip(rows, lines):
        if not held_out(id):
            for node, context, bit in bits(line):
                tree.setdefault(node, Node()).add(context, bit)

    def chance(node, context, bit):
        root = tree.setdefault(node, Node())
        before = root.weighted(lm_scoring.DEPTH)
        path, current = [root], root
        for c in reversed(context):
            new = c not in current.longer
            path.append(current.longer.setdefault(c, Node()))
            current = path[-1]
            current.new = new
        for x in path:
            x.n[bit] += 1
        after = root.weighted(lm_scoring.DEPTH)
        for x in path:
            x.n[bit] -= 1
        return (after - before) / math.log(10)

    known = {}
    for line in lines:
        yield sum(known[k] if k in known else known.setdefault(k, chance(*k)) for k in bits(line))


def test_tree_scores_are_those_of_the_definition(spark):
    words = "to be or not that is the question whether tis nobler".split()
    rows = [(i, " ".join(words[(i * 7 + j * j + j // 3) % len(words)] for j in range(3 + i % 5))) for i in range(24)]
    rows += [(30, "Über TO\tBE"), (31, None), (32, ""), (None, "to be"), (30, "Über TO\tBE")]
    assert any(held_out(i) for i, _ in rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    got = Counter((r.id, round(r.score, 6)) for r in lm_scoring.scores(docs).collect())
    assert got == Counter((i, round(s, 6)) for (i, _), s in zip(rows, tree_by_hand(rows)))


def test_prices_are_found_by_hash_and_by_bisection(monkeypatch):
    monkeypatch.setattr(lm_scoring.Prices, "BITS", 6)  # most runs lose their place in the table
    keys = np.random.default_rng(1).permutation(np.arange(0, 3_000, 7))
    prices = lm_scoring.Prices(keys, keys / 2)
    assert (prices.find(np.repeat(keys, 2)) == np.repeat(keys, 2) / 2).all()


def test_estimates():
    for a, b in [(0, 0), (1, 0), (0, 3), (7, 2), (1_000_000, 3)]:
        want = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
        assert float(lm_scoring.estimate(np.float64(a), np.float64(b))) == pytest.approx(want, abs=1e-8)


def base_by_hand(rows):
    texts = [[*SPACES.findall((t or "").encode().lower()), b"\n"] for _, t in rows]
    count = Counter(w for (i, _), words in zip(rows, texts) if not held_out(i) for w in words)
    total, distinct = sum(count.values()), len(count)
    for (id, _), words in zip(rows, texts):
        base = sum(math.log10((count[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in words)
        yield id, held_out(id), len(words), sum(count[w] > 0 for w in words), total, round(base, 5)


def test_scoring_query(spark, documents):
    got = queries.QUERIES["op11_lm_scoring"](spark, SF).toPandas()
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    columns = got[["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"]].round(5)
    assert Counter(columns.itertuples(index=False, name=None)) == Counter(base_by_hand(rows))
    assert (got.score < 0).all() and 1 < got[got.held_out].bits_per_byte.mean() < 3


def test_bytes_in_context_beat_single_words_on_unseen_texts(spark):
    got = queries.QUERIES["op11_lm_scoring"](spark, SF.replace("0.001", "0.01")).where("held_out").toPandas()
    assert len(got) > 80 and got.score.sum() > got.base_score.sum()


def test_scores_of_odd_rows(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = lm_scoring.scores(odd).collect()
    assert Counter((r.id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == Counter(base_by_hand(rows))
    assert all(r.score < 0 and r.n_bytes > 0 for r in got)
    assert lm_scoring.scores(empty).count() == 0


def test_counts_do_not_depend_on_the_chunks(spark, documents):
    whole = {r.id: r.score for r in lm_scoring.scores(documents).collect()}
    parts = {r.id: r.score for r in lm_scoring.scores(documents.repartition(5)).collect()}
    assert whole.keys() == parts.keys() and all(parts[i] == pytest.approx(s, rel=1e-9) for i, s in whole.items())


def test_chunks_end_at_their_size(spark):
    docs = spark.createDataFrame([(i, "x" * 40) for i in range(20)], "doc_id bigint, text string").coalesce(1)
    stored = chunks.in_chunks(docs, {"id": F.col("doc_id")}, size=100)
    sizes = [r["count"] for r in stored.groupBy("chunk").count().collect()]
    assert sum(sizes) == 20 and max(sizes) <= 3 and stored.select("unit").distinct().count() == 20


def audit_by_hand(docs, labels):
    good, toxic = ({i for i, *flags in labels if i is not None and flags[k] == 1} for k in (0, 1))
    failed = []
    for id, text, part in docs:
        text = text or ""
        words = SPACES.findall(text.encode())
        same = [i for i, t, _ in docs if (t or "") == text and i is not None]
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": any(id is None or i < id for i in same),
        }
        failed.append((id, part or "", {f for f in fails if fails[f]}))
    orders, rows = list(itertools.permutations("ABCDE")), {}
    for part in {p for _, p, _ in failed}:
        mine = [(i, fails) for i, p, fails in failed if p == part]
        turns = Counter(next(f for f in o if f in fails) for o in orders for _, fails in mine if fails)
        for order in orders:
            left = mine
            for step, f in enumerate(order):
                out = [i for i, fails in left if f in fails]
                redundant = sum(f in fails for _, fails in mine) - len(out)
                left = [(i, fails) for i, fails in left if f not in fails]
                rows[part, "".join(order), step + 1] = (len(left), len(out), redundant, sum(fails == {f} for _, fails in mine), sum(i in good for i in out), sum(i in toxic for i in out), turns[f])
    return rows


def audit(docs, labels):
    rows = filter_audit.every_order(filter_audit.failures(docs, labels)).collect()
    found = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in rows}
    assert len(found) == len(rows)
    return found


def test_audit_of_odd_rows(spark, odd, empty):
    labels = [(0, 1, 0), (8, 1, 1), (8, 0, 0), (9, 0, 1), (None, 1, 1), (100, None, None), (101, 1, None), (900, 1, 1)]
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    shout = spark.createDataFrame([(200, "A" * 30 + " b" * 300, "en"), (201, "a#b c", ""), (202, "word " * 150 + " ".join(map(str, range(150))), "en")], "doc_id bigint, text string, lang string")
    docs = odd.unionByName(shout, allowMissingColumns=True)
    assert audit(docs, known) == audit_by_hand([(r.doc_id, r.text, r.lang) for r in docs.collect()], labels)
    assert audit(empty, known) == {} and len(audit(docs, known.limit(0))) == 600 * 4


def test_shards_hold_the_matrix(spark, odd, empty):
    for size in (filter_audit.CHUNK_BYTES, 100):  # one chunk a task, and many
        coded = filter_audit.coded_chunks(odd, {"id": F.col("doc_id")}, size=size)
        word = {r.term: bytes(r.word) for r in filter_audit.dictionary(coded).collect()}
        rows = []
        for s in filter_audit.term_shards(coded).collect():
            for i, id in enumerate(s.id):
                span = slice(s.bounds[i], s.bounds[i + 1])
                assert len(set(s.terms[span])) == len(s.terms[span])
                rows.append((id, bytes(s.digest[i]), dict(zip(map(word.__getitem__, s.terms[span]), s.counts[span]))))
        texts = [(r.doc_id, (r.text or "").encode()) for r in odd.collect()]
        want = [(id, hashlib.sha256(t).digest(), dict(Counter(SPACES.findall(t)))) for id, t in texts]
        key = lambda r: (r[0] is None, r[0] or 0, r[1])
        assert len(word) == len(set(word.values())) and sorted(rows, key=key) == sorted(want, key=key)
        chunks_found = coded.select("chunk").distinct().count()
        assert chunks_found <= spark.sparkContext.defaultParallelism if size > 100 else chunks_found > 1
    nothing = filter_audit.term_shards(filter_audit.coded_chunks(empty, {"id": F.col("doc_id")}))
    assert filter_audit.row_counts(nothing).count() == 0


def ranks_by_hand(docs, items, k=50):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    found = [(i, Counter(terms(t))) for i, t in docs]
    found = [(i, c, sum(c.values())) for i, c in found if c]
    total, df = sum(n for *_, n in found), Counter(t for _, c, _ in found for t in c)
    weight = {t: math.floor(1000 * math.log((2 * len(found) + 2) / (2 * n + 1))) for t, n in df.items()}
    for item, text in set(items):
        asked = set(terms(text))
        scored = [(-sum(weight[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * (50 + 50 * n * len(found) // total))) for t in asked & c.keys()), i is None, i or 0) for i, c, n in found]
        for rank, (score, nameless, id) in enumerate(sorted(s for s in scored if s[0] < 0)[:k], 1):
            yield item, rank, None if nameless else id, -score


def test_ranks_of_odd_rows(spark, odd, empty):
    items = [(1, "alpha beta gamma"), (1, "alpha beta gamma"), (2, "日本語 🙂"), (3, None), (4, "nothing-there"), (5, "ALPHA don't 123 ω ß"), (None, "word"), (6, "a a a b")]
    asked = spark.createDataFrame([(*r, 3) for r in items], "item_id bigint, text string, score int")
    want = Counter(ranks_by_hand([(r.doc_id, r.text) for r in odd.collect()], items, k=7))
    for block in (3, 100):
        got = lexical_search.best_documents(odd, asked, k=7, block=block)
        assert Counter(map(tuple, got.select("item_id", "rank", "doc_id", "score").collect())) == want
    assert lexical_search.best_documents(empty, asked).count() == 0 == lexical_search.best_documents(odd, asked.limit(0)).count()


def test_search_query(spark, documents):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = Counter(map(tuple, queries.QUERIES["op13_lexical_search"](spark, SF).collect()))
    assert got == Counter(ranks_by_hand([(r.doc_id, r.text) for r in documents.collect()], items))


@pytest.mark.parametrize("floor", [0, 1])
def test_bounds_lose_no_document(floor):
    """Buckets of random vectors: what the bounds leave is what a full product finds."""
    rng = np.random.default_rng(floor)
    size, width, k = 600, 30, 5
    dense = rng.integers(1, 900_000, (size, width)) * (rng.random((size, width)) < 0.2)
    dense[:40] = dense[0]  # ties
    dense = dense[np.argsort(-np.sqrt((dense.astype(float) ** 2).sum(1)), kind="stable")]
    weights = [rng.integers(1, 9_000, width) * (rng.random(width) < 0.2) for _ in range(20)]
    terms = [np.array(sorted(np.flatnonzero(w), key=lambda t: -w[t]), np.int32) for w in weights]
    items = lexical_search.Items(terms, [w[t] for w, t in zip(weights, terms)], np.array([math.sqrt((w.astype(float) ** 2).sum()) for w in weights]))
    scores = dense @ np.array(weights).T
    floors = np.ones(20, np.int64) if not floor else np.maximum(np.sort(scores, 0)[-k], 1)
    best = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))] * 20
    for at in range(0, size, 50):
        part = dense[at : at + 50]
        row, term = np.nonzero(part)
        norms = np.sqrt((part.astype(float) ** 2).sum(1))
        if len(row):
            lexical_search.search_bucket(items, floors, best, np.arange(at, at + len(part)), np.zeros(len(part), bool), norms, term.astype(np.int32), part[row, term], row, k)
    for q in range(20):
        want = sorted(((-s, i) for i, s in enumerate(scores[:, q].tolist()) if s > 0))[:k]
        assert [(-s, i) for i, s in zip(best[q][0].tolist(), best[q][2].tolist())] == want or Counter(best[q][2].tolist()) == Counter(-s for s, _ in want)
        assert sorted(zip((-best[q][2]).tolist(), best[q][0].tolist())) == want


def test_texts_of_a_chunk_travel_compressed(spark):
    from quillmill.llm.chunks import in_chunks, unzipped, zipped

    docs = spark.createDataFrame([(i, None if i == 3 else f"text {i} " + "of many words " * 400) for i in range(200)], "doc_id bigint, text string")
    stored = in_chunks(docs, {"id": docs.doc_id}, size=100_000)
    sent = zipped(stored.select("chunk", "id", "text"))
    chunks = {r.chunk for r in stored.select("chunk").distinct().collect()}
    assert {r.chunk for r in sent.collect()} == chunks and len(chunks) > 5
    found = {r["id"]: r["text"] for part in unzipped(sent.toArrow()) for r in part.to_pylist()}
    assert found == {r.doc_id: r.text or "" for r in docs.collect()}
    assert sum(len(r.rows) for r in sent.collect()) * 5 < sum(map(len, found.values()))


class Task:  # takes the place of a frame and keeps the function that it is given
    def select(self, *columns):
        return self

    def mapInArrow(self, task, schema):
        return task


def traced(work):
    """What ``work`` returns, and the MB that Python and numpy held at most meanwhile."""
    tracemalloc.start()
    try:
        return work(), tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_scoring_tasks_hold_little_of_a_chunk():
    pick = np.random.default_rng(5)
    words = np.array(["".join(x) for x in pick.choice(list("abcdefgh"), (70_000, 5))])
    texts = [" ".join(pick.choice(words, 400)) for _ in range(3_000)]
    batch = pa.RecordBatch.from_arrays([pa.array(np.zeros(3_000, np.int64)), pa.array(range(3_000)), pa.array([i % 10 > 0 for i in range(3_000)]), pa.array(texts)], ["chunk", "id", "learn", "text"])
    of_runs, run_mb = traced(lambda: list(lm_scoring.run_counts(Task())(iter([batch]))))
    of_words, word_mb = traced(lambda: list(lm_scoring.word_counts(Task())(iter([batch]))))
    assert max(b.num_rows for b in of_runs + of_words) <= 50_000  # what the JVM has to hold of a result at once
    of_runs, of_words = pa.Table.from_batches(of_runs), pa.Table.from_batches(of_words)
    lines = [lm_scoring.line(lm_scoring.words_of(t.encode())) for t in texts]
    want = Counter(lm_scoring.byte_runs(lines[0::10])[0].tolist())
    assert set(want) <= set(of_runs["run"].to_pylist()) and sum(of_runs["n"].to_pylist()) == sum(map(len, lines)) - sum(map(len, lines[0::10]))
    values = pa.table(
        {
            "chunk": np.zeros(len(of_runs) + len(of_words), np.int64),
            "run": pa.chunked_array([*of_runs["run"].chunks, pa.nulls(len(of_words), pa.int64())]),
            "word": pa.chunked_array([pa.nulls(len(of_runs), pa.binary()), *of_words["word"].chunks]),
            "value": np.r_[np.full(len(of_runs), -0.5), np.full(len(of_words), -2.0)],
        }
    )
    zipped = pa.Table.from_batches(list(chunks.zipped(Task().select())(iter([batch]))))
    got, score_mb = traced(lambda: lm_scoring.score_chunk(zipped, values))
    assert got["score"].to_pylist() == [-0.5 * len(x) for x in lines] and set(got["base_score"].to_pylist()) == {-802.0}
    assert run_mb < 45 and word_mb < 10 and score_mb < 55, (run_mb, word_mb, score_mb)
