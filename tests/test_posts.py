import json

import pytest

from quillmill.operators.filters import REMOVAL_NOTICES, drop_containing_any
from quillmill.plans.posts import process_posts
from quillmill.sources.readers import read_posts_csv


@pytest.fixture()
def paths(tmp_path):
    female = 'week,post,V,std(V),extra\n1,"line one\nline ""two""",0.5,0.1,e1\n48,It was (#start_removal) gone,0.1,0.2,e2\n49,last week,0.25,,e3\n'
    male = "week,post,V,std(V)\n50,no such week,1.5,0.5\n2,plain,0.75,0.125\n"
    for name, text in (("f", female), ("m", male)):
        (tmp_path / f"{name}.csv").write_text(text)
    return {"female": str(tmp_path / "f.csv"), "male": str(tmp_path / "m.csv")}


def test_reader_keeps_order_labels_and_extra_columns(spark, paths):
    rows = read_posts_csv(spark, paths).orderBy("label_ord", "row_ord").collect()
    assert [(r.gender, r.week, r.extra) for r in rows] == [
        ("female", 1, "e1"), ("female", 48, "e2"), ("female", 49, "e3"), ("male", 50, None), ("male", 2, None),
    ]
    assert rows[0].post == 'line one\nline "two"' and rows[2]["std(V)"] is None


def test_types_of_further_columns(spark, tmp_path):
    (tmp_path / "x.csv").write_text("week,post,V,std(V),i,gap,d,b,s,none\n1,a,1,1,5,5,1.5,True,2020-01-01,\n2,b,1,1,-6,,2,false,x,\n")
    rows = read_posts_csv(spark, {"f": str(tmp_path / "x.csv")})
    kinds = dict(rows.dtypes)
    assert [kinds[c] for c in ("week", "V", "i", "gap", "d", "b", "s", "none")] == ["int", "double", "bigint", "double", "double", "boolean", "string", "string"]
    told = read_posts_csv(spark, {"f": str(tmp_path / "x.csv")}, types={"i": "string", "d": "float"})
    assert dict(told.dtypes)["i"] == "string" and dict(told.dtypes)["d"] == "float" and dict(told.dtypes)["b"] == "string"


def test_reader_checks_required_columns(spark, tmp_path):
    (tmp_path / "x.csv").write_text("week,post\n1,a\n")
    with pytest.raises(ValueError, match="lacks columns"):
        read_posts_csv(spark, {"x": str(tmp_path / "x.csv")})


def test_pipeline(spark, paths, tmp_path):
    out = tmp_path / "out"
    process_posts(spark, paths, str(out))
    lines = sorted(r.value for r in spark.read.text(str(out / "reddit_processed/corpus")).collect())
    assert lines == [
        'reddit_000001\tline one <p> line "two"',
        "reddit_000002\tlast week",
        "reddit_000003\tno such week",
        "reddit_000004\tplain",
    ]
    records = [json.loads(r.value) for r in spark.read.text(str(out / "reddit_processed/metadata")).collect()]
    first = next(r for r in records if r["id"] == "reddit_000001")
    assert list(first) == ["id", "publication_date", "valance", "std(valance)", "extra", "gender"]
    assert first["publication_date"] == "2020-02-09" and first["valance"] == 0.5
    assert {r["id"]: r["publication_date"] for r in records}["reddit_000003"] is None


def test_limit_applies_after_numbering(spark, paths, tmp_path):
    process_posts(spark, paths, str(tmp_path / "out"), limit=2, normalise=False)
    text = "\n".join(r.value for r in spark.read.text(str(tmp_path / "out/reddit_processed/corpus")).collect())
    assert "reddit_000002\tlast week" in text and "reddit_000003" not in text


def test_removal_notices_are_literal_and_case_sensitive(spark):
    texts = [f"x {n} y" for n in REMOVAL_NOTICES] + [REMOVAL_NOTICES[0].upper(), "(start_removal)", None, "ok"]
    df = spark.createDataFrame([(t,) for t in texts], "post string")
    assert [r.post for r in drop_containing_any(df, "post").collect()] == texts[len(REMOVAL_NOTICES):]
