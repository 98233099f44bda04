import pytest

from quillmill import __main__ as cli


def test_process_posts(spark, tmp_path):
    (tmp_path / "f.csv").write_text("week,post,V,std(V)\n1,a,0.5,0.1\n")
    cli.main(["process-posts", f"female={tmp_path}/f.csv", "-o", str(tmp_path / "out"), "-l", "5"])
    assert [r.value for r in spark.read.text(str(tmp_path / "out/reddit_processed/corpus")).collect()] == ["reddit_000001\ta"]


def test_ingest_and_export(spark, tmp_path):
    link = '<a class="teaser-anchor" href="/a">x</a>'
    spark.createDataFrame([(1, link)], "page_num int, html string").write.parquet(str(tmp_path / "index"))
    pages = [("https://www.thesun.co.uk/a", "<body><article>text</article></body>")]
    spark.createDataFrame(pages, "url string, html string").write.parquet(str(tmp_path / "pages"))
    where = ["--store", str(tmp_path / "store"), "-o", str(tmp_path / "out")]
    cli.main(["ingest-articles", "sun", "--index-pages", str(tmp_path / "index"), "--article-pages", str(tmp_path / "pages"), *where])
    cli.main(["export-articles", "sun", *where])
    assert [r.value for r in spark.read.text(str(tmp_path / "out/sun/corpus")).collect()] == ["00001_sun\ttext"]


def test_unknown_source_is_refused():
    with pytest.raises(SystemExit):
        cli.main(["export-articles", "mirror", "--store", "x"])
