import random
import re
from collections import Counter, defaultdict

import pytest

from quillmill.llm import jaccard_join, queries
from quillmill.llm.components import components

from .conftest import SF


def shingles_by_hand(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    size = min(5, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def components_by_hand(rows):
    """Smallest reachable id of each row, by comparing all pairs that share a shingle."""
    sets = [shingles_by_hand(text) for _, text in rows]
    holders, root = defaultdict(list), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in enumerate(sets):
        common = Counter(j for x in s for j in holders[x])
        for j, n in common.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
        for x in s:
            holders[x].append(i)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return Counter((key, len(s), least.get(find(i)) if s else key) for i, ((key, _), s) in enumerate(zip(rows, sets)))


def check(docs, **options):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = Counter(map(tuple, jaccard_join.similar_documents(docs, **options).collect()))
    assert got == components_by_hand(rows)


def clusters(seed, groups, copies, length=120, edits=6):
    """Groups of edited copies of a text, with one passage in many of the texts."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3_000)]
    passage, rows = rng.choices(words, k=60), []
    for g in range(groups):
        base = rng.choices(words, k=rng.randint(5, length)) + passage * (g % 2)
        for _ in range(rng.randint(1, copies)):
            text = list(base)
            for _ in range(rng.randint(0, edits)):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((len(rows) * 7 % 100_003, " ".join(text)))
    return rows


SCHEMA = "doc_id bigint, text string"


def test_documents_and_odd_rows(spark, documents, odd, empty):
    check(documents)
    check(odd)
    check(odd, region_documents=2, region_shingles=50)
    assert jaccard_join.similar_documents(empty).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_edited_copies(spark, seed):
    check(spark.createDataFrame(clusters(seed, 60, 8), SCHEMA))


@pytest.mark.parametrize("options", [{"region_documents": 3, "region_shingles": 400}, {"region_documents": 10, "region_shingles": 3_000, "pivots": 3}])
def test_large_regions_are_cut_into_cells_and_blocks(spark, options):
    check(spark.createDataFrame(clusters(5, 4, 60, edits=14) + [(10**6 + i, t) for i, t in clusters(6, 30, 4)], SCHEMA), **options)


def test_common_shingles_go_last_without_losing_links(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "COMMON_SHARE", 1)
    rows = clusters(7, 40, 6)
    check(spark.createDataFrame(rows + [(10**6 + i, " ".join(t.split()[-50:])) for i, (_, t) in enumerate(rows)], SCHEMA))


def test_exactly_four_fifths_links(spark):
    words = [f"x{i}" for i in range(40)]
    rows = [(1, " ".join(words[:12])), (2, " ".join(words[:14])), (3, " ".join(words[:15])), (4, " ".join(words[20:23])), (5, " ".join(words[20:23]).upper())]
    check(spark.createDataFrame(rows, SCHEMA))  # 8 of 10 shingles link, 8 of 11 do not


def test_region_against_all_pairs():
    rows = clusters(11, 30, 20, edits=10)
    import numpy as np

    sets = [jaccard_join.shingle_set(t) for _, t in rows]
    region = jaccard_join.Region(np.array([len(s) for s in sets]), sets)
    roots = region.join().tolist()
    want = Counter((k, n, c) for (k, n, c) in components_by_hand([(i, t) for i, (_, t) in enumerate(rows)]))
    assert Counter((i, len(s), roots[i]) for i, s in enumerate(sets)) == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, 3), (500, 7), (7, 9), (20, 20)]
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, 500: 3, 3: 3, 7: 3, 9: 3}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_one_document_of_each_group_stays(spark, odd):
    rows = clusters(3, 20, 5)
    docs = spark.createDataFrame(rows + rows[:3], SCHEMA)
    kept = [r.doc_id for r in jaccard_join.one_of_each_group(docs).collect()]
    want = {c for _, _, c in components_by_hand(rows)}
    assert sorted(kept) == sorted(want)
    assert jaccard_join.one_of_each_group(odd).columns == odd.columns


def test_query(spark, documents):
    got = queries.QUERIES["op3_jaccard_join"](spark, SF)
    assert got.columns == ["doc_id", "n_shingles", "component_id"] and got.count() == documents.count()


def test_shared_and_missing_ids_lose_no_other_text(spark):
    texts = {k: " ".join(f"{k}{i}" for i in range(40)) for k in "ABCD"}
    near = texts["B"] + " more"
    rows = [(5, texts["A"]), (5, texts["B"]), (2, near), (None, texts["C"]), (None, texts["D"]), (None, texts["D"]), (None, near), (None, ""), (None, None), (7, " \n"), (7, None)]
    got = Counter(map(tuple, jaccard_join.one_of_each_group(spark.createDataFrame(rows, SCHEMA)).collect()))
    assert got == Counter([(5, texts["A"]), (2, near), (None, texts["C"]), (None, texts["D"]), (None, ""), (None, None), (7, " \n"), (7, None)])
