import hashlib
import math
import struct
import zlib
from collections import Counter, defaultdict

import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from quillmill.llm import exact_dedup, jaccard_join, mixing, queries, sharding

from .conftest import SF


def groups_by_hand(rows):
    found = defaultdict(list)
    for r in rows:
        found[r.text or ""].append(r.doc_id)
    return {t: (max((i for i in ids if i is not None), default=None), len(ids)) for t, ids in found.items()}


def check_duplicates(docs, **options):
    rows, want = docs.collect(), groups_by_hand(docs.collect())
    got = exact_dedup.exact_duplicates(docs, **options).collect()
    by_id = defaultdict(list)
    for r in rows:
        by_id[r.doc_id].append((r.doc_id, *want[r.text or ""]))
    assert Counter((r.id, r.keep_id, r.group_size) for r in got) == Counter(x for v in by_id.values() for x in v)
    assert sum(r.kept for r in got) == len(want)


def test_duplicates(documents, odd, empty):
    check_duplicates(documents)
    check_duplicates(odd)
    check_duplicates(empty)


def test_texts_decide_when_digests_collide(odd):
    check_duplicates(odd, digest=lambda c: F.length(c).cast("string").cast("binary"), salts=3)


def test_kept_rows_have_all_columns(odd):
    kept = exact_dedup.drop_exact_duplicates(odd)
    assert kept.columns == odd.columns
    texts = [r.text or "" for r in kept.collect()]
    assert sorted(texts) == sorted({r.text or "" for r in odd.collect()})


def test_maps_and_internal_names_pass(odd):
    """Rows that differ in a map only, under column names that operators use themselves."""
    for names in (("_mid", "row_number", "slot", "_place"), ("_chunk", "pos", "nth", "tie"), ("_keep", "_digest", "wordless", "hash")):
        docs = odd.select("*", F.create_map(F.lit("k"), F.col("n_chars")).alias("m"), *[F.lit(5).alias(n) for n in names])
        kept = exact_dedup.drop_exact_duplicates(docs)
        assert kept.columns == docs.columns and kept.count() == len({r.text or "" for r in odd.collect()})
        single = jaccard_join.one_of_each_group(docs)
        assert single.columns == docs.columns and single.count() == jaccard_join.one_of_each_group(odd).count()
        sharded = sharding.with_shards(docs, ["doc_id", "text", "n_chars", "shard"], 8)
        rest = [c for c in docs.columns if c not in ("row_number", "shard", "slot")]
        assert sorted(sharded.columns) == sorted([*rest, "row_number", "shard", "slot"])
        assert sorted((r.shard, r.slot) for r in sharded.collect()) == sorted((i % 8, i // 8) for i in range(odd.count()))
        assert mixing.mix(docs).columns == docs.columns


def place_by_hand(v, rows, seed=0):
    m = math.isqrt(max(rows - 1, 0)) + 1
    while True:
        left, right = divmod(v, m)
        for i in range(sharding.ROUNDS):
            h = 42
            for part in (right, seed * sharding.ROUNDS + i):
                h = xxhash.xxh64_intdigest(struct.pack("<q", part), h)
            signed = h - (1 << 64) if h >> 63 else h
            left, right = right, (left + signed % m) % m
        v = left * m + right
        if v < rows:
            return v


def test_permutation_is_exact_at_every_size(spark):
    for n in (1, 2, 3, 5, 17, 100, 1_000, 1_030, 40_000):
        got = [r.p for r in spark.range(n).select(sharding.permuted(F.col("id"), n, 5).alias("p")).collect()]
        assert sorted(got) == list(range(n))
        assert n > 1_000 or got == [place_by_hand(i, n, 5) for i in range(n)]


def test_shards(documents, odd, empty):
    for docs in (documents.select("doc_id", "text"), odd.select("doc_id", "text", "n_chars")):
        rows = sharding.with_shards(docs, docs.columns, 8).collect()
        assert len(rows) == docs.count()
        by_shard = defaultdict(list)
        for r in rows:
            by_shard[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
        sizes = [len(by_shard[k]) for k in range(8)]
        assert max(sizes) - min(sizes) <= 1
    assert sharding.with_shards(empty.select("doc_id"), ["doc_id"]).count() == 0


def test_sharding_query(spark, documents):
    got = {r.doc_id: r for r in queries.QUERIES["op8_sharding"](spark, SF).collect()}
    ordered = sorted(documents.collect(), key=lambda r: r.doc_id)
    for i, r in enumerate(ordered):
        data, at = (r.text or "").encode(), place_by_hand(i, len(ordered))
        assert (got[r.doc_id].size, got[r.doc_id].text_crc32) == (len(data) + 1, zlib.crc32(data))
        assert (got[r.doc_id].shard, got[r.doc_id].slot, got[r.doc_id].law) == (at % 8, at // 8, "rows")


def test_written_shards(spark, documents, tmp_path):
    sharded = sharding.with_shards(documents.select("doc_id"), ["doc_id"], 4)
    sharding.write_shards(sharded, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert Counter((r.doc_id, r.shard, r.slot) for r in back.collect()) == Counter((r.doc_id, r.shard, r.slot) for r in sharded.collect())


def targets_by_hand(sizes, weights=mixing.WEIGHTS, repeats=mixing.MAX_REPEATS):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > repeats * sizes[s]}
        for s in over or free:
            target[s] = float(repeats * sizes[s]) if over else level * weight[s]
            left -= target[s]
        free -= over or free
    return target


def words(text):
    import re

    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_mix_plan(documents, odd, empty):
    for docs in (documents, odd):
        rows = docs.collect()
        sizes, largest = Counter(), Counter()
        for r in rows:
            sizes[r.source] += words(r.text)
            largest[r.source] = max(largest[r.source], words(r.text) * sum((x.doc_id, x.source, x.text) == (r.doc_id, r.source, r.text) for x in rows))
        want = targets_by_hand(sizes)
        plan = mixing.plan_mix(docs).collect()
        assert sum(r.n for r in plan) == len(rows)
        taken = Counter()
        for r in plan:
            assert math.isclose(r.target, want[r.source], rel_tol=1e-9, abs_tol=1e-6) and r.source_size == sizes[r.source]
            assert 0 <= r.copies <= mixing.MAX_REPEATS
            taken[r.source] += r.copies * r.size * r.n
        assert all(abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6 for s in sizes)
    assert mixing.plan_mix(empty).count() == 0 and mixing.mix(empty).count() == 0


def test_blocks_keep_their_quotas(spark):
    targets = spark.createDataFrame([("a", 500.0), ("b", 1.0), (None, 3000.0), ("z", 0.0)], "source string, target double")
    for shards in (1, 2, 7, 8):
        blocks = mixing.split_blocks(targets, shards, 16, seed=3).collect()
        per_source = Counter(r.source for r in blocks)
        assert per_source == {r.source: r.blocks for r in blocks} and "z" not in per_source and per_source["b"] >= 1
        assert len({(r.source, r.block) for r in blocks}) == len(blocks)
        per_shard = Counter(r.shard for r in blocks)
        assert sorted(per_shard) == list(range(shards)) and max(per_shard.values()) - min(per_shard.values()) <= 3


def test_quotas_are_hypergeometric(spark):
    """Of 32 + 32 blocks, half goes left: mean 16, variance 32 * 1/4 * 32/63."""
    targets = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "source string, target double")
    left = [sum(r.source == "a" and r.shard == 0 for r in mixing.split_blocks(targets, 2, 32, seed=s).collect()) for s in range(40)]
    mean = sum(left) / len(left)
    assert abs(mean - 16) < 1.2 and 1.2 < sum((x - mean) ** 2 for x in left) / len(left) < 9


def test_mix_query_and_draw_agree(spark, documents):
    query = queries.QUERIES["op10_mixing"]
    first, again = (Counter(map(tuple, query(spark, SF).drop("shards").collect())) for _ in range(2))
    assert first == again and len(first) == documents.count()
    taken = {r.doc_id: r.taken for r in query(spark, SF).collect()}
    drawn = Counter(r.doc_id for r in mixing.mix(documents).collect())
    assert all(taken[r.doc_id] == drawn[r.doc_id] * words(r.text) for r in documents.collect())


def test_mixed_rows_keep_columns(odd):
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns and mixed.count() > 0


def test_stage_names():
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_digest_is_sha256(spark):
    row = exact_dedup.exact_duplicates(spark.createDataFrame([(1, "é")], "doc_id bigint, text string")).first()
    assert bytes(row.digest).hex() == hashlib.sha256("é".encode()).hexdigest()
