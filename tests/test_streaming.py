from quillmill.sources.store import read_posts, read_rejects
from quillmill.streaming.ingest import ingest_stream, source_posts

HTML = "<body><article>{0}</article></body>"


def land(spark, landing, *rows):
    spark.createDataFrame([(i, u, HTML.format(t)) for i, u, t in rows], "page_id bigint, url string, html string").coalesce(1).write.mode("append").parquet(landing)


def test_stream_appends_new_urls_once(spark, tmp_path):
    landing, store, checkpoint = (str(tmp_path / n) for n in ("landing", "store", "checkpoint"))
    run = lambda: ingest_stream(spark, landing, store, checkpoint, source_posts("guardian"))
    land(spark, landing, (1, "u1", "a"), (2, "u2", "b"), (3, "u1", "again"))
    run()
    assert sorted((r.url, r.content) for r in read_posts(spark, store).collect()) == [("u1", "a"), ("u2", "b")]
    run()
    assert read_posts(spark, store).count() == 2
    land(spark, landing, (4, "u2", "old url"), (5, "u3", "new"))
    run()
    assert sorted(r.url for r in read_posts(spark, store).collect()) == ["u1", "u2", "u3"]


def test_a_replayed_batch_adds_nothing(spark, tmp_path):
    landing, store = str(tmp_path / "landing"), str(tmp_path / "store")
    land(spark, landing, (1, "u1", "a"))
    for attempt in ("first", "lost"):  # a lost checkpoint replays all input
        ingest_stream(spark, landing, store, str(tmp_path / attempt), source_posts("sun"), files_per_batch=1)
    assert read_posts(spark, store).count() == 1


def test_rejects_are_kept_once(spark, tmp_path):
    landing, store, rejects = (str(tmp_path / n) for n in ("landing", "store", "rejects"))
    run = lambda checkpoint: ingest_stream(spark, landing, store, str(tmp_path / checkpoint), source_posts("guardian"), rejects=rejects)
    found = lambda *store: sorted((str(r.url), r.id_custom, r.reason) for r in read_rejects(spark, rejects, *store).collect())
    assert found() == []
    land(spark, landing, (1, "u1", ""), (2, "u2", "b"), (3, "u2", ""), (4, None, "no address"))
    run("first")
    assert found() == [("None", 4, "no url"), ("u1", 1, "no content")]  # u2 has a post
    run("first")
    run("lost")  # another stream reads all input again
    assert found() == [("None", 4, "no url"), ("u1", 1, "no content")]
    land(spark, landing, (5, "u1", "mended"), (6, "u3", ""))
    run("first")
    assert found() == [("None", 4, "no url"), ("u1", 1, "no content"), ("u3", 6, "no content")]
    assert found(store) == [("None", 4, "no url"), ("u3", 6, "no content")]  # u1 has one by now
    assert sorted(r.url for r in read_posts(spark, store).collect()) == ["u1", "u2"]


def test_a_replayed_batch_replaces_its_rejects(spark, tmp_path):
    from quillmill.sources.store import replace_rejects

    path, rows = str(tmp_path), [("sun", "u1", 1, "no content"), ("sun", "u2", 2, "no content")]
    for kept in (rows, rows[:1]):  # the first attempt broke off after its rejects
        replace_rejects(spark.createDataFrame(kept, "source string, url string, id_custom int, reason string"), path, "a", 0)
    assert [r.url for r in read_rejects(spark, path).collect()] == ["u1"]
