import json
import random

import pytest
from pyspark.sql import functions as F

from quillmill.functions.papers import headings_once
from quillmill.operators.joins import join_paper_metadata
from quillmill.operators.records import headings_once_rows
from quillmill.plans import papers as plan
from quillmill.schemas import PARAGRAPHS
from quillmill.sources.readers import read_paper_metadata, read_papers


def para(*pairs):
    return [{"section": s, "text": t} for s, t in pairs]


def author(first, last, country=...):
    out = {"first": first, "last": last}
    if country is not ...:
        out["affiliation"] = {"location": {"country": country}} if country else {}
    return out


PAPERS = {
    "pdf_json/a.json": {
        "paper_id": "aaaa",
        "metadata": {
            "title": "First",
            "authors": [author("Ann", "Lee", " UK "), author("", ""), author("Ann", "Lee"), author("Bo", "", None), author("C", "D", "UK")],
        },
        "abstract": para(("Abstract", "x"), ("Abstract", "y")),
        "body_text": para(("Intro", "1"), ("Intro", "2"), ("Methods", "3"), ("Intro", "4"), ("Abstract", "5")),
    },
    "pdf_json/b.json": {"paper_id": "bbbb", "metadata": {"title": "No abstract", "authors": []}, "body_text": para(("S", "line\nbreak"))},
    "pmc_json/c.json": {"paper_id": "cccc", "metadata": {"title": "PMC", "authors": [author(None, "Solo", "Chile")]}, "body_text": []},
}
META = '''cord_uid,sha,journal,doi,url,publish_time
u1,,J0,d0,w0,2020-01-01
u2,zzzz; aaaa,"J, ""one""",d1,w1,2020-01-02
u3,aaaa,J2,d2,w2,2020-01-03
u4,bbbb,,d3,,2020
'''


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    root = tmp_path_factory.mktemp("papers")
    for name, paper in PAPERS.items():
        path = root / "document_parses" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps(paper, indent=1))
    (root / "metadata.csv").write_text(META)
    return str(root)


def test_read_papers_in_folder_order(spark, root):
    rows = read_papers(spark, root).orderBy("dir_ord", "file_path").collect()
    assert [r.paper_id for r in rows] == ["aaaa", "bbbb", "cccc"]
    assert rows[1].abstract is None


def test_read_metadata_keeps_nulls_and_order(spark, root):
    rows = read_paper_metadata(spark, root).orderBy("row_ord").collect()
    assert [r.sha for r in rows] == [None, "zzzz; aaaa", "aaaa", "bbbb"]
    assert rows[1].journal == 'J, "one"'


def test_pipeline(spark, root):
    corpus, metadata = plan.papers(spark, root)
    lines = {r.id: r.text for r in corpus.collect()}
    assert lines == {
        "aaaa": "First <p> Abstract <p> x <p> y <p> Intro <p> 1 <p> 2 <p> Methods <p> 3 <p> 4 <p> Abstract <p> 5",
        "bbbb": "No abstract <p> S <p> line <p> break",
        "cccc": "PMC",
    }
    records = {r.id: r.asDict() for r in metadata.collect()}
    assert records["aaaa"] == {
        "id": "aaaa", "title": "First", "author": "Ann Lee,Bo,C D", "location": "UK",
        "journal": 'J, "one"', "doi": "d1", "url": "w1", "publication_date": "2020-01-02",
    }
    assert records["bbbb"]["journal"] is None and records["bbbb"]["url"] is None and records["bbbb"]["doi"] == "d3"
    assert records["cccc"]["author"] == "Solo" and records["cccc"]["location"] == "Chile" and records["cccc"]["doi"] is None


def test_written_outputs(spark, root, tmp_path):
    for _ in range(2):  # a second export replaces the first
        plan.process_papers(spark, root, str(tmp_path))
    lines = [r.value for r in spark.read.text(str(tmp_path / "cord19_processed/corpus")).collect()]
    assert sorted(line.split("\t")[0] for line in lines) == ["aaaa", "bbbb", "cccc"]
    raw = [r.value for r in spark.read.text(str(tmp_path / "cord19_processed/metadata")).collect()]
    records = [json.loads(r) for r in raw]
    assert all(list(r) == sorted(r) for r in records) and len(records) == 3
    assert next(r for r in records if r["id"] == "cccc")["journal"] is None and "NaN" not in "".join(raw)


def test_limit_below_the_total_writes_that_many_lines(spark, root, tmp_path):
    plan.process_papers(spark, root, str(tmp_path), limit=2)
    lines = [r.value for r in spark.read.text(str(tmp_path / "cord19_processed/corpus")).collect()]
    assert sorted(line[:4] for line in lines) == ["aaaa", "bbbb"]


def test_sample_writes_one_file_per_paper(spark, root, tmp_path):
    plan.sample_papers(spark, root, str(tmp_path), limit=2)
    assert len(list((tmp_path / "cord19_sample").glob("id=*/part-*.txt"))) == 2


def test_headings_once_in_a_list(spark):
    rows = [("I", "1"), ("I", "2"), ("M", "3"), ("I", "4"), (None, "5"), (None, None)]
    df = spark.createDataFrame([([{"section": s, "text": t} for s, t in rows],), ([],), (None,)], f"p {PARAGRAPHS}")
    got = [r[0] for r in df.select(headings_once(F.col("p"))).collect()]
    assert got == [["I", "1", "2", "M", "3", "4", "", "5", ""], [], None]


def test_row_form_equals_list_form(spark):
    rng = random.Random(5)
    docs = {d: [(rng.choice("abc"), str(i)) for i in range(rng.randrange(1, 30))] for d in range(20)}
    listed = spark.createDataFrame([(d, [{"section": s, "text": t} for s, t in ps]) for d, ps in docs.items()], f"d int, p {PARAGRAPHS}")
    rows = spark.createDataFrame([(d, i, s, t) for d, ps in docs.items() for i, (s, t) in enumerate(ps)], "d int, i int, section string, text string")
    want = {r.d: r.lines for r in listed.select("d", headings_once(F.col("p")).alias("lines")).collect()}
    got = {}
    for r in headings_once_rows(rows, ["d"], "i").orderBy("d", "i", "part").collect():
        got.setdefault(r.d, []).append(r.line)
    assert got == want


def first_containing(ids, metas):
    return {i: next((k for k, sha in enumerate(metas) if sha is not None and i in sha), None) for i in ids}


@pytest.mark.parametrize("alphabet,seed", [("ab", 1), ("ab; ", 2), ("abcdef", 3), ("aé;", 4)])
def test_containment_join_equals_brute_force(spark, alphabet, seed):
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, n)))
    ids = list({word(6) for _ in range(40)})
    metas = [None if rng.random() < 0.1 else "; ".join(word(8) for _ in range(rng.randrange(0, 4))) for _ in range(60)]
    papers = spark.createDataFrame([(i,) for i in ids], "paper_id string")
    meta = spark.createDataFrame(list(enumerate(metas)), "ord int, sha string").repartition(5)
    got = {r.paper_id: r.ord for r in join_paper_metadata(papers, meta, ["ord"], ["ord"]).collect()}
    assert got == first_containing(ids, metas)


def test_containment_join_compares_no_pairs(spark):
    papers = spark.createDataFrame([("a",)], "paper_id string")
    meta = spark.createDataFrame([(1, "a")], "ord int, sha string")
    plan_text = join_paper_metadata(papers, meta, ["ord"], ["ord"])._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan_text and "Cartesian" not in plan_text


def test_repeated_papers_each_get_the_match(spark):
    papers = spark.createDataFrame([("a",), ("a",), ("x",)], "paper_id string")
    meta = spark.createDataFrame([(1, "b;a"), (0, "a")], "ord int, sha string")
    got = sorted((r.paper_id, r.ord) for r in join_paper_metadata(papers, meta, ["ord"], ["ord"]).na.fill(-1).collect())
    assert got == [("a", 0), ("a", 0), ("x", -1)]


def test_containment_join_groups_no_substring_that_is_no_id(spark):
    """Grouping sorts whole rows, so all substrings of all texts would be held sorted."""
    papers = spark.createDataFrame([("ab",), ("abc",)], "paper_id string")
    meta = spark.createDataFrame([(1, "xxabcxx")], "ord int, sha string")
    plan = join_paper_metadata(papers, meta, ["ord"], ["ord"])._jdf.queryExecution().optimizedPlan().toString()
    lines = [line.strip(" :+-") for line in plan.split("\n")]
    grouped = next(i for i, line in enumerate(lines) if line.startswith("Aggregate [_id"))
    assert lines[grouped + 1].startswith("Join LeftSemi") or lines[grouped + 2].startswith("Join LeftSemi")
