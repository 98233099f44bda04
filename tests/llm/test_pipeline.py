import base64
import functools
import math
import re
import subprocess
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as spark_entry
import corpus_pipeline
from quillmill.llm import language_id

from .conftest import SF
from .test_dedup_sharding_mixing import targets_by_hand, words
from .test_jaccard import components_by_hand


def test_registered():
    assert [n for n in spark_entry.queries() if n.startswith("op")] and "pipeline" in spark_entry.queries()
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in spark_entry.queries() if n.startswith("op")} == set(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5


def stage_outputs(spark, docs):
    outputs = [docs]
    for _, stage in corpus_pipeline.STAGES:
        found = stage(spark, outputs[-1], SF)
        outputs.append(spark.createDataFrame(found.collect(), found.schema))
    return outputs


@pytest.fixture(scope="module")
def outputs(spark, documents):
    return stage_outputs(spark, documents)


def known_share(text, model):
    """Share of the distinct n-grams of a text that a landmark has, in plain sets."""
    letters = re.sub(r"\x01+", "\x01", "".join(c if c.isalpha() else "\x01" for c in f" {text} ".lower()))
    grams = {letters[i : i + n] for n in (1, 2, 3) for i in range(len(letters) - n + 1)}
    known, code = set(model.grams.tolist()), lambda g: functools.reduce(lambda a, c: a << 21 | ord(c), g, 0)
    return sum(code(g) in known for g in grams) / len(grams)


def by_hand(rows, model):
    """What the first three stages keep, one document at a time."""
    rows = [r for r in rows if any(c.isalpha() for c in r.text or "") and known_share(r.text, model) >= model.least_known]
    yield rows
    last = {}
    for r in rows:
        last[r.text] = max(last.get(r.text, r.doc_id), r.doc_id)
    rows = [r for r in rows if last[r.text] == r.doc_id]
    yield rows
    components = {k: c for k, _, c in components_by_hand([(r.doc_id, r.text) for r in rows])}
    yield [r for r in rows if components[r.doc_id] == r.doc_id]


def test_filtering_stages(documents, outputs):
    for stage, want in zip(outputs[1:4], by_hand(documents.collect(), language_id.fit(documents))):
        assert stage.columns == documents.columns
        assert Counter(map(tuple, stage.collect())) == Counter(map(tuple, want))
    assert outputs[1].count() > 0.97 * documents.count()


def test_mix_comes_near_its_targets(documents, outputs):
    rows, mixed = outputs[3].collect(), outputs[4].collect()
    assert outputs[4].columns == documents.columns and set(map(tuple, mixed)) <= set(map(tuple, rows))
    sizes, largest, taken = Counter(), Counter(), Counter()
    for r in rows:
        sizes[r.source] += words(r.text)
        largest[r.source] = max(largest[r.source], words(r.text))
    for r in mixed:
        taken[r.source] += words(r.text)
    target = targets_by_hand(sizes)
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6 for s in sizes)
    assert max(Counter(r.doc_id for r in mixed).values()) <= 3


def test_every_mixed_document_is_packed_whole(outputs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, packed = Counter(), outputs[5].collect()
    for r in outputs[4].collect():
        ids = tokenizer.encode(r.text, add_special_tokens=False).ids + [1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            want[r.doc_id, piece, tuple(ids[at : at + 4096])] += 1
    assert Counter((r.doc_id, r.piece, tuple(r.ids)) for r in packed) == want
    held = defaultdict(list)
    for r in packed:
        held[r.sequence_id].append((r.offset, r.length))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    for places in held.values():
        ends = [0, *np.cumsum([n for _, n in sorted(places)]).tolist()]
        assert [o for o, _ in sorted(places)] == ends[:-1] and ends[-1] <= 4096
    assert len(held) <= math.ceil(sum(r.length for r in packed) / 4096) + 2


def test_odd_and_empty_tables_pass_every_stage(spark, odd, empty):
    for docs in (odd, empty):
        for _, stage in corpus_pipeline.STAGES:
            found = stage(spark, docs, SF)
            docs = spark.createDataFrame(found.collect(), found.schema)
    assert docs.count() == 0


def test_run(spark, outputs):
    got = corpus_pipeline.run(spark, SF).select("doc_id", "piece", "length", "ids_crc32")
    assert Counter(map(tuple, got.collect())) == Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in outputs[5].collect())


def test_foreign_texts_go_and_clean_ones_stay(spark, documents):
    random = np.random.default_rng(7)
    noise = lambda letters, n: "".join(random.choice(list(letters), n))
    foreign = [
        "Все люди рождаются свободными и равными в своем достоинстве и правах.",
        "人人生而自由，在尊严和权利上一律平等。他们赋有理性和良心。",
        "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα.",
        base64.b64encode(random.bytes(600)).decode(),
        " ".join(noise("abcdefghijklmnopqrstuvwxyz", 6) for _ in range(100)),
    ]
    clean = documents.where("text rlike '[a-z]'").select("doc_id", "text", "lang")
    added = spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(foreign)], "doc_id bigint, text string, lang string")
    cuts = clean.selectExpr("doc_id + 1000000 AS doc_id", "substr(text, 30, 40) AS text", "CAST(NULL AS string) AS lang").where("length(text) = 40")
    kept = {r.doc_id for r in corpus_pipeline.in_known_languages(spark, clean.unionByName(added).unionByName(cuts), SF).collect()}
    assert not kept & set(range(-len(foreign), 0))
    assert kept == {r.doc_id for r in clean.unionByName(cuts).collect()}


TASK = """
import random, pyarrow as pa, public_tokenizers
from unittest import mock
from pyspark.sql import functions
from quillmill.llm import jaccard_join, packing

functions.col = mock.MagicMock()  # there is no session

def held():
    return next(int(line.split()[1]) // 1024 for line in open("/proc/self/status") if line.startswith("RssAnon"))

class Docs:  # takes the place of a frame and runs the task itself
    def select(self, *columns):
        return self
    def mapInArrow(self, task, schema):
        return task(batches())

def batches():
    pick = random.Random(1)
    words = ["".join(pick.choices("abcdefghijklmnop", k=7)) for _ in range(20_000)]
    for at in range(2):
        texts = [" ".join(pick.choices(words, k=400)) for _ in range(4_000)]
        yield pa.RecordBatch.from_arrays([pa.array(range(4_000)), pa.array(texts)], ["id", "text"])

start = held()
for _ in {task}:
    pass
del _
print(held() - start)
"""


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="reads /proc")
@pytest.mark.parametrize(
    ("task", "most"),
    [("jaccard_join._describe(batches())", 20), ("packing.encode_pieces(Docs(), public_tokenizers.path('word_bpe_49k.json'), stored_words=40_000)", 65)],
)
def test_workers_give_memory_back_at_the_end_of_a_task(task, most):
    found = subprocess.run([sys.executable, "-c", TASK.replace("{task}", task)], check=True, capture_output=True, text=True)
    assert int(found.stdout) < most
