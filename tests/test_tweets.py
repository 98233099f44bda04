import json
import random

import pytest
from pyspark.sql import functions as F

from quillmill.functions.location import US_STATES, tweet_location
from quillmill.functions.tweets import tweet_metadata
from quillmill.operators import aggregates as A, joins as J
from quillmill.operators.filters import split_retweets
from quillmill.operators.limits import sort_files
from quillmill.operators.positions import with_scan_position
from quillmill.plans import tweets as plan
from quillmill.sources import readers
from quillmill.sources.store import read_ledger

COUNTRIES = [
    (0, "Aruba", "AW", "ABW"), (1, "Chile", "CL", "CHL"), (2, "Niger", "NE", "NER"), (3, "Nigeria", "NG", "NGA"),
    (4, "Texland", "TX", "TEX"), (5, "United Kingdom", "GB", "GBR"), (6, "United States", "US", "USA"),
]


@pytest.fixture(scope="module")
def countries(spark):
    return spark.createDataFrame(COUNTRIES, "ord bigint, name string, alpha2 string, alpha3 string").repartition(3)


def expected_location(place, text):
    """Slow stand-in written from the rules, for comparison."""
    if place is not None:
        return place.get("country")
    if not text:
        return None
    words = {"".join(ch for ch in w if ch not in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~") for w in text.split()}
    names = [name for _, name, _, _ in COUNTRIES if name in text]
    if names:
        return names[-1]
    if words & set(US_STATES):
        return "United States"
    codes = []
    for _, name, alpha2, alpha3 in COUNTRIES:
        codes += [(alpha2, name), ("UK", "United Kingdom"), (alpha3, name)]
    return next((name for code, name in codes if code in words), None)


CASES = [
    ({"country": "Peru"}, "Chile"), ({"country": None}, "Chile"), ({}, "Chile"),
    (None, "Nigeria"), (None, "Niger"), (None, "Chile and Aruba"), (None, "Austin, TX."), (None, "London, UK"), (None, "GB"),
    (None, "(GBR)"), (None, "uk"), (None, ""), (None, None), (None, "Nowhere"), (None, "AW UK"), (None, "ABW UK"),
    (None, "CL UK"), (None, "TEX"), (None, "CHL NG"), (None, "... --"), (None, "U.K."), (None, "chile"),
]


def located(spark, countries, cases):
    rows = [(i, p, {"location": t}) for i, (p, t) in enumerate(cases)]
    df = spark.createDataFrame(rows, "i int, place struct<country:string>, user struct<location:string>")
    return [r.location for r in tweet_location(df, countries).orderBy("i").collect()]


def test_location_cases(spark, countries):
    assert located(spark, countries, CASES) == [expected_location(p, t) for p, t in CASES]


def test_location_equals_stand_in_on_random_texts(spark, countries):
    rng = random.Random(11)
    parts = ["AW", "CL", "UK", "GBR", "ABW", "NE", "TX", "DC", "Chile", "Niger", "Nigeria", "x", "USA", "(GB)", "N.G.", "uk", ","]
    cases = [(None, " ".join(rng.choice(parts) for _ in range(rng.randrange(0, 4)))) for _ in range(600)]
    assert located(spark, countries, cases) == [expected_location(p, t) for p, t in cases]


def test_country_tables_of_any_length(spark, countries):
    more = spark.range(1_000, 7_000).select(F.col("id").alias("ord"), *[F.concat(F.lit(f"{c}?"), "id").alias(c) for c in ("name", "alpha2", "alpha3")])
    assert located(spark, countries.union(more), CASES) == [expected_location(p, t) for p, t in CASES]


def tweet(i, text="hello  world\nagain", **more):
    return {
        "id": i, "id_str": str(i), "full_text": text, "created_at": "Sun Mar 01 00:30:00 +0500 2020", "lang": "en",
        "favorite_count": 1, "retweet_count": 2, "in_reply_to_status_id": None, "in_reply_to_user_id": 3, "place": None,
        "entities": {
            "hashtags": [{"text": "a"}, {"text": "b"}], "urls": [{"expanded_url": "http://x"}], "user_mentions": [{"id": 2**40}],
        },
        "user": {"id": 9, "name": "N", "location": "London, UK", "followers_count": 4, "statuses_count": 5, "verified": True},
    } | more


def write_tweets(path, tweets):
    path.mkdir(parents=True, exist_ok=True)
    (path / "t.jsonl").write_text("\n".join(json.dumps(t) for t in tweets))
    return str(path)


def test_retweets_are_told_by_key_presence(spark, tmp_path):
    path = write_tweets(tmp_path / "a", [
        tweet(1), tweet(2, retweeted_status=None), tweet(3, retweeted_status={"id": 1}), tweet(4, text='say "retweeted_status" aloud'),
        tweet(5, quoted={"retweeted_status": 1}),
    ])
    kept, skipped = split_retweets(readers.read_tweets(spark, path))
    assert sorted(r.id for r in kept.collect()) == [1, 4, 5]
    assert sorted(r.id_str for r in skipped.collect()) == ["2", "3"]


def test_tweet_record(spark, tmp_path, countries):
    tweets = readers.read_tweets(spark, write_tweets(tmp_path / "a", [tweet(2**60)]))
    assert tweet_metadata(tweet_location(tweets, countries)).first().asDict() == {
        "date": "2020-03-01", "location": "United Kingdom", "hashtags": ["a", "b"], "urls": ["http://x"],
        "user_mentions": [2**40], "id": 2**60, "language": "en", "favourite_count": 1, "retweet_count": 2,
        "in_reply_to_status_id": None, "in_reply_to_user_id": 3, "author": 9, "author_name": "N",
        "author_followers_count": 4, "author_statuses_count": 5, "author_verified": True, "content": "hello world <p> again",
    }


@pytest.fixture()
def id_dirs(tmp_path):
    """Headerless and headered id files; batch size 3: none, less, exact, one more."""
    dataport, cov19 = tmp_path / "dataport", tmp_path / "cov19"
    dataport.mkdir(), cov19.mkdir()
    files = {"corona_tweets_01.csv": [], "corona_tweets_02.csv": [21, 22], "corona_tweets_03.csv": [31, 32, 33], "corona_tweets_04.csv": [41, 42, 43, 44]}
    for name, ids in files.items():
        (dataport / name).write_text("".join(f"{i},0.5\n" for i in ids))
    (cov19 / "2020-03-01_tweets_cov19.csv").write_text("id,username,timestamp\n51,u,x\n52,u,y\n21,u,z\n")
    return [str(dataport), str(cov19)]


def test_id_files_of_both_layouts(spark, id_dirs):
    rows = with_scan_position(readers.read_id_files(spark, id_dirs), plan.FILES).collect()
    got = {}
    for r in sorted(rows, key=lambda r: r.pos):
        got.setdefault((r.dataset, r.file_name), []).append((r.pos, r.id))
    assert got == {
        ("dataport", "corona_tweets_02.csv"): [(0, 21), (1, 22)],
        ("dataport", "corona_tweets_03.csv"): [(0, 31), (1, 32), (2, 33)],
        ("dataport", "corona_tweets_04.csv"): [(0, 41), (1, 42), (2, 43), (3, 44)],
        ("cov19", "2020-03-01_tweets_cov19.csv"): [(0, 51), (1, 52), (2, 21)],
    }


def test_scan_positions_across_blocks_of_one_file(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d/big.csv").write_text("".join(f"{i},x\n" for i in range(1000, 9000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        rows = with_scan_position(readers.read_id_files(spark, [str(tmp_path / "d")]), plan.FILES)
        assert rows.count() == 8000 and rows.where("pos <> id - 1000").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_plan_counts_true_rows(spark, id_dirs):
    ids = readers.read_id_files(spark, id_dirs)
    planned = {(r.file_name, r.batch_id) for r in plan.planned_batches(ids, 3).collect()}
    assert planned == {
        ("corona_tweets_02.csv", 0), ("corona_tweets_03.csv", 0), ("corona_tweets_04.csv", 0), ("corona_tweets_04.csv", 1),
        ("2020-03-01_tweets_cov19.csv", 0),
    }


def test_file_list_is_sorted_by_path(spark, id_dirs):
    rows = sort_files(readers.list_files(spark, id_dirs)).collect()
    paths = [r.file_path for r in rows]
    assert paths == sorted(paths) and [r.dataset for r in rows] == ["cov19"] + ["dataport"] * 3


def read_parts(spark, path):
    return [(r.file_name, r.batch_id, r.value) for r in spark.read.text(path).collect()]


def test_hydration_is_resumable(spark, id_dirs, tmp_path, countries):
    archive = write_tweets(tmp_path / "archive", [tweet(i) for i in (21, 22, 31, 41, 44)] + [tweet(51, retweeted_status=None)])
    out, ledger = str(tmp_path / "out"), str(tmp_path / "ledger")
    run = lambda **kw: plan.hydrate_batches(spark, id_dirs, archive, countries, out, ledger, batch=3, **kw)

    first = {(r.file_name, r.batch_id): r.num_tweets_saved for r in run(max_batches=1).collect()}
    assert first == {
        ("corona_tweets_02.csv", 0): 2, ("corona_tweets_03.csv", 0): 1, ("corona_tweets_04.csv", 0): 1,
        ("2020-03-01_tweets_cov19.csv", 0): 1,  # 21 occurs in two files; 51 is a retweet
    }
    second = {(r.file_name, r.batch_id): r.num_tweets_saved for r in run().collect()}
    assert second == {("corona_tweets_04.csv", 1): 1}
    assert run().count() == 0
    assert read_ledger(spark, ledger).count() == 5

    corpus = read_parts(spark, f"{out}/corpus")
    assert sorted(v for _, _, v in corpus) == [f"{i}\thello world <p> again" for i in (21, 21, 22, 31, 41, 44)]
    assert ("corona_tweets_04.csv", 1, "44\thello world <p> again") in corpus
    assert [v for _, _, v in read_parts(spark, f"{out}/skipped_ids")] == ["51"]
    lengths = spark.read.option("header", True).csv(f"{out}/lengths").collect()
    assert {r.tweet_length for r in lengths} == {"3"} and len(lengths) == 6
    records = [json.loads(v) for _, _, v in read_parts(spark, f"{out}/metadata")]
    assert all(list(r) == sorted(r) and r["in_reply_to_status_id"] is None for r in records) and len(records) == 6


def test_a_broken_run_is_repeated_without_duplicates(spark, id_dirs, tmp_path, countries):
    archive = write_tweets(tmp_path / "archive", [tweet(i) for i in (21, 31)])
    out = str(tmp_path / "out")
    for ledger in ("lost", "kept"):  # the first run's ledger never got written
        plan.hydrate_batches(spark, id_dirs, archive, countries, out, str(tmp_path / ledger), batch=3)
    assert len(read_parts(spark, f"{out}/corpus")) == 3


def test_hydrate_keeps_repeated_ids_unless_distinct(spark):
    ids = spark.createDataFrame([(1,), (1,), (2,)], "id bigint")
    archive = spark.createDataFrame([(1, "x")], "id bigint, t string")
    assert J.hydrate(ids, archive).count() == 2
    assert J.hydrate(ids, archive, distinct=True).count() == 1


def test_batch_log_reports_empty_batches(spark):
    planned = spark.createDataFrame([("a", 0), ("a", 1)], "file_name string, batch_id int")
    kept = spark.createDataFrame([("a", 1), ("a", 1)], "file_name string, batch_id int")
    assert {(r.batch_id, r.num_tweets_saved) for r in A.batch_log(planned, kept).collect()} == {(0, 0), (1, 2)}


def test_file_dates(spark, id_dirs, tmp_path):
    stamp = "Wed Apr 01 12:00:00 +0000 2020"
    archive = write_tweets(tmp_path / "archive", [tweet(22), tweet(32, created_at=stamp), tweet(33), tweet(44)])
    got = {r.file_name: (r.date, r.new_name) for r in plan.id_file_dates(spark, id_dirs[:1], archive, probe_rows=3).collect()}
    assert got == {
        "corona_tweets_02.csv": ("2020-03-01", "2020-03-01_corona_tweets_02.csv"),
        "corona_tweets_03.csv": ("2020-04-01", "2020-04-01_corona_tweets_03.csv"),
        "corona_tweets_04.csv": (None, None),
    }


def test_id_table_by_day(spark, tmp_path):
    row = lambda i, stamp: "\t".join([str(i), "u", stamp] + ["1"] * 9)
    stamps = ["Sun Mar 01 23:59:59 +0000 2020", "Sun Mar 01 00:30:00 +0500 2020", "Mon Mar 02 00:00:00 +0000 2020", "Fri Mar 20 01:00:00 +0000 2020"]
    (tmp_path / "t.tsv").write_text("\n".join(row(i, s) for i, s in enumerate(stamps)))
    days = str(tmp_path / "days")
    counts = plan.split_id_table_by_day(spark, str(tmp_path / "t.tsv"), days, ("2019-12-01", "2020-03-19"))
    assert {(str(r.date), r.n) for r in counts.collect()} == {("2020-03-01", 2), ("2020-03-02", 1)}
    back = readers.read_id_files(spark, [days])
    assert {(r.dataset, r.file_name, r.id) for r in back.collect()} == {
        ("days", "2020-03-01_tweets_cov19.csv", 0), ("days", "2020-03-01_tweets_cov19.csv", 1), ("days", "2020-03-02_tweets_cov19.csv", 2),
    }


def test_ids_are_found_by_header_and_nothing_is_dropped_silently(spark, tmp_path):
    (tmp_path / "d").mkdir()
    files = {
        "a.csv": 'username,text,id\n7,"x, y",100\n8,z,101\n', "b.csv": '"id","user"\n"5","7"\n"6","8"\n', "c.csv": "1,0.5\n2,0.5\n\nnothing here\n3,0.5\n",
        "d.csv": "\ufeffid\n9\n", "e.csv": "",
    }
    for name, text in files.items():
        (tmp_path / "d" / name).write_text(text, encoding="utf-8")
    rows = with_scan_position(readers.read_id_files(spark, [str(tmp_path / "d")]), plan.FILES).collect()
    got = {}
    for r in sorted(rows, key=lambda r: r.pos):
        got.setdefault(r.file_name, []).append((r.pos, r.id))
    assert got == {"a.csv": [(0, 100), (1, 101)], "b.csv": [(0, 5), (1, 6)], "c.csv": [(0, 1), (1, 2), (2, 3)], "d.csv": [(0, 9)]}
    assert [(r.file_name, r.line) for r in readers.rejected_id_lines(spark, [str(tmp_path / "d")]).collect()] == [("c.csv", "nothing here")]


def test_no_id_is_lost_between_runs(spark, tmp_path, countries):
    """Another batch size, a file that grew, a repeated object, and a changed file."""
    (tmp_path / "d").mkdir()
    ids, out, ledger = tmp_path / "d/x.csv", str(tmp_path / "out"), str(tmp_path / "ledger")
    write = lambda n, first=0: ids.write_text("".join(f"{i},x\n" for i in range(first, first + n)))
    archive = write_tweets(tmp_path / "archive", [tweet(i) for i in range(30)] + [tweet(3)])
    run = lambda **kw: plan.hydrate_batches(spark, [str(tmp_path / "d")], archive, countries, out, ledger, **kw)
    write(20)
    assert run(batch=5, max_batches=1).count() == 1
    assert sum(r.num_tweets_saved for r in run(batch=45_000).collect()) == 15
    write(22)
    assert [r.num_tweets_saved for r in run(batch=7).collect()] == [2]
    saved = [int(v.split("\t")[0]) for _, _, v in read_parts(spark, f"{out}/corpus")]
    assert sorted(saved) == list(range(22))
    write(25, first=1)
    with pytest.raises(ValueError, match="changed"):
        run(batch=7)


def test_a_table_split_again_keeps_the_places_of_its_ids(spark, tmp_path):
    """Other scan tasks, as on another day of a cluster, bring rows in another order."""
    (tmp_path / "t").mkdir()
    stamp = lambda i: f"Sun Mar {1 + i % 2:02d} 10:00:00 +0000 2020"
    row = lambda i: "\t".join([str(i), "u", stamp(i)] + ["1"] * 9)
    for name, ids in (("a", range(40)), ("b", range(40, 900)), ("c", range(900, 1500))):
        (tmp_path / f"t/{name}.tsv").write_text("\n".join(map(row, ids)) + "\n")
    days = str(tmp_path / "days")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    found = []
    try:
        for size, dates in (("20000", ("2020-03-01", "2020-03-01")), (before, None), ("3000", None)):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            plan.split_id_table_by_day(spark, str(tmp_path / "t"), days, dates)
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
            rows = plan.id_file_positions(spark, [days]).collect()
            found.append({(r.file_name, r.pos): r.id for r in rows})
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    first, second = ({(f"2020-03-0{1 + d}_tweets_cov19.csv", i): 2 * i + d for i in range(750)} for d in (0, 1))
    assert found == [first, first | second, first | second]


def test_id_lines_are_neither_moved_nor_misread(spark, tmp_path):
    """What is known of a file comes to its lines; numbers need no pattern unless quoted."""
    folder = tmp_path / "d"
    folder.mkdir()
    (folder / "a.csv").write_text('id,x\n 7 ,y\n"8",z\n\t9\n1 0\n"a,b",11\n" 12 ", "c,d"\n-5,\n,6\n')
    (folder / "b.csv").write_text('x,id\n"a,b",11\nc\n"d", "12"\n')
    rows = readers.read_id_files(spark, [str(folder)])
    assert sorted((r.dataset, r.file_name, r.id) for r in rows.collect()) == sorted(
        [("d", "a.csv", i) for i in (7, 8, 9, 12, -5)] + [("d", "b.csv", i) for i in (11, 12)]
    )
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
