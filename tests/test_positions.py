import random

import pytest
from pyspark.sql import functions as F

from quillmill.durable import checkpoint_folder, durable
from quillmill.operators import joins as J, limits as L, positions as W, sets as S
from quillmill.sources.sinks import write_daily_partitions


def plan_of(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    """5,000 rows; one file holds most of them, one is null, many are tiny."""
    rng = random.Random(3)
    rows = [("hot" if i % 3 else f"f{i % 40:02}" if i % 2 else None, i) for i in range(5000)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "file_name string, id int").repartition(6)


def test_positions_are_consecutive_in_every_file(skewed):
    seen = {}
    for r in W.with_position(skewed, ["id"]).orderBy("file_name", "id").collect():
        assert r.pos == seen.get(r.file_name, 0)
        seen[r.file_name] = r.pos + 1
    assert sum(seen.values()) == 5000 and None in seen


def test_sequence_is_global_and_ordered(skewed):
    rows = W.with_sequence(skewed, ["id"], "reddit_%06d").orderBy("id").collect()
    assert [r.id for r in rows if r.id] and len(rows) == 5000
    got = W.number_rows(skewed, ["id"], start=1).orderBy("id").collect()
    assert [r.pos for r in got] == list(range(1, 5001))


def test_sequence_names_and_format(spark):
    df = spark.createDataFrame([("b",), ("a",)], "t string")
    assert [tuple(r) for r in W.with_sequence(df, ["t"], "reddit_%06d").orderBy("t").collect()] == [
        ("reddit_000001", "a"),
        ("reddit_000002", "b"),
    ]


def test_empty_frame_numbers_nothing(spark):
    assert W.with_position(spark.createDataFrame([], "file_name string, id int"), ["id"]).count() == 0


def test_numbering_does_not_put_rows_into_one_task(skewed):
    plan = plan_of(W.number_rows(skewed, ["id"])).split("== Physical Plan ==")[1]
    assert "Window" not in plan and "SinglePartition" not in plan and "CartesianProduct" not in plan


def test_a_hot_file_is_spread_over_tasks(spark):
    df = spark.range(200_000).select(F.lit("hot").alias("file_name"), "id")
    ordered = df.orderBy("file_name", "id").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(ordered) > 1
    assert W.with_position(df, ["id"]).where(F.col("pos") != F.col("id")).count() == 0


CLASHES = ("_mid", "_chunk", "_shift", "_c", "_g0", "_n", "_first", "_row", "_rank", "_number", "gaps")


def test_columns_with_internal_names_survive(spark, monkeypatch):
    monkeypatch.setattr(L, "ONE_TASK_ROWS", 3)
    columns = list(CLASHES)
    rows = [("ab"[i % 2], i, {"k": i}, *[100 * i + j for j in range(len(columns))]) for i in range(20)]
    df = spark.createDataFrame(rows, "file_name string, id int, m map<string,int>, " + ", ".join(f"`{c}` int" for c in columns))
    want = {r.id: tuple(r) for r in df.collect()}

    def same(found, *added):
        assert [c for c in found.columns if c not in added] == df.columns
        got = [tuple(r[c] for c in df.columns) for r in found.collect()]
        assert all(want[g[1]] == g for g in got)
        return len(got)

    assert same(W.with_position(df, ["id"]), "pos") == 20
    assert same(W.with_sequence(df, ["id"], "x%02d", "name"), "name") == 20
    assert same(W.with_article_index(df, ["id"], ["file_name"]), "id_custom") == 20
    assert same(L.take_first(df, 2, ["file_name"])) == 2 and same(L.take_first(df, 7, ["file_name"])) == 7
    assert same(L.head_per_file(df, 3, ["id"]), "pos") == 6


def test_a_column_of_the_result_is_replaced(spark):
    df = spark.createDataFrame([("f", 2, 9), ("f", 1, 8)], "file_name string, id int, pos int")
    for found in (W.with_position(df, ["id"]), L.head_per_file(df, 5, ["id"])):
        assert sorted(found.columns) == ["file_name", "id", "pos"]
        assert {(r.id, r.pos) for r in found.collect()} == {(1, 0), (2, 1)}
    assert [r.pos for r in W.with_position(df, ["pos"]).orderBy("id").collect()] == [0, 1]
    assert {tuple(r) for r in W.with_sequence(df, ["id"], "%d", "pos").select("pos", "id").collect()} == {("1", 1), ("2", 2)}


def test_ties_of_rows_with_maps_have_an_order(spark):
    rows = [(1, {"k": i}) for i in range(50)]
    firsts = {L.take_first(spark.createDataFrame(rows[i:] + rows[:i], "a int, m map<string,int>").repartition(1 + i % 3), 1, ["a"]).first().m["k"] for i in (0, 7, 20)}
    assert len(firsts) == 1


def test_batch_ids(spark):
    df = spark.range(101).select(F.col("id").alias("pos"))
    got = {r.batch_id: r["count"] for r in W.with_batch_id(df, 50).groupBy("batch_id").count().collect()}
    assert got == {0: 50, 1: 50, 2: 1}


def test_take_first(spark):
    df = spark.range(10).select((9 - F.col("id")).alias("k"))
    assert [r.k for r in L.take_first(df, 3, ["k"]).collect()] == [0, 1, 2]
    for everything in (None, 0, 99):
        assert L.take_first(df, everything, ["k"]).count() == 10
    assert "TakeOrderedAndProject" in plan_of(L.take_first(df, 3, ["k"]))


def test_long_prefixes_are_cut_where_they_lie(spark, monkeypatch):
    monkeypatch.setattr(L, "ONE_TASK_ROWS", 5)
    rows = [(i % 7, None if i == 3 else i, "wide" * 10) for i in range(100)]
    df = spark.createDataFrame(rows, "a int, b int, text string").repartition(5)
    by_key = sorted(rows, key=lambda r: (r[0], -1 if r[1] is None else r[1]))
    for n in (6, 60, 100, 500):
        cut = L.take_first(df, n, ["a", "b"])
        assert sorted(map(repr, map(tuple, cut.collect()))) == sorted(map(repr, by_key[:n]))
    assert L.take_first(df.where("a > 9"), 60, ["a", "b"]).count() == 0
    assert L.sample_exact(df.withColumn("id", F.col("a") * 100 + F.coalesce("b", F.lit(0))), "id", 30, 1).count() == 30


@pytest.mark.parametrize("descending", [False, True])
def test_prefixes_of_ties_are_exact_on_both_paths(spark, monkeypatch, descending):
    df = spark.range(3_000).select((F.col("id") / 10).cast("int").alias("k"), "id").repartition(7)
    order = [F.desc("k")] if descending else ["k"]
    for n in (1, 995, 1_001, 2_999, 3_000, 9_999):
        cuts = []
        for limit in (1, 10_000):
            monkeypatch.setattr(L, "ONE_TASK_ROWS", limit)
            cuts.append(sorted(r.id for r in L.take_first(df, n, order).collect()))
        assert cuts[0] == cuts[1] and len(cuts[0]) == min(n, 3_000)
        keys = sorted((i // 10 for i in range(3_000)), reverse=descending)[:n]
        assert sorted(i // 10 for i in cuts[0]) == sorted(keys)


def test_sample_is_exact_and_reproducible(spark):
    df = spark.range(1000)
    a, b, c = (sorted(r.id for r in L.sample_exact(df, "id", 50, seed).collect()) for seed in (1, 1, 2))
    assert len(set(a)) == 50 and a == b != c
    assert L.sample_exact(df, "id", 5000).count() == 1000


def test_head_per_file_limits_before_the_shuffle(skewed):
    head = L.head_per_file(skewed.na.fill("none"), 5, ["id"])
    assert {r["count"] for r in head.groupBy("file_name").count().collect()} == {5}
    assert plan_of(head).count("WindowGroupLimit") >= 2


def test_article_index_is_per_source(spark):
    df = spark.createDataFrame([("a", 2, 0), ("a", 1, 5), ("b", 1, 0), ("a", 1, 2)], "source string, page_num int, pos int")
    got = {(r.source, r.page_num, r.pos): r.id_custom for r in W.with_article_index(df, ["page_num", "pos"]).collect()}
    assert got == {("a", 1, 2): 1, ("a", 1, 5): 2, ("a", 2, 0): 3, ("b", 1, 0): 1}


def test_processing_order_is_batch_major(spark):
    df = spark.createDataFrame([("b", 0), ("a", 1), ("a", 0), ("a", 12)], "file_name string, batch_id int")
    assert [tuple(r) for r in W.processing_order(df).collect()] == [("a", 0), ("b", 0), ("a", 1), ("a", 12)]
    assert W.processing_order(df, 10).count() == 3


def test_concat_labelled_keeps_order_and_extra_columns(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2, "e")], "x int, y string")
    got = [tuple(r) for r in S.concat_labelled({"f": a, "m": b}, "gender").orderBy("label_ord").select("x", "y", "gender", "label_ord").collect()]
    assert got == [(1, None, "f", 0), (2, "e", "m", 1)]


def test_scratch_tables_lie_in_the_sessions_checkpoint_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert checkpoint_folder(spark) == named.rstrip("/")
    kept = durable(spark.range(3), "t")
    assert checkpoint_folder(spark) in kept.inputFiles()[0] and kept.count() == 3


@pytest.fixture()
def small_partitions(spark):
    """Settings under which small test data counts as large."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_hot_id_is_looked_up_by_several_tasks(spark, small_partitions):
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    third = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))
    ids = spark.range(0, 60_000, numPartitions=8).select(third.alias("id"), F.col("id").alias("row"))
    archive = spark.range(60_000).select("id", F.md5(F.col("id").cast("string")).alias("tweet"))
    want = ids.join(archive, "id")
    for rows in (ids, ids.select("id")):
        found = J.hydrate(rows, archive, rows_per_task=2_000)
        per_task = found.groupBy(F.spark_partition_id().alias("p")).agg(F.count_if(F.col("id") == 7).alias("hot")).collect()
        assert sum(r.hot > 0 for r in per_task) > 3 and sum(r.hot for r in per_task) == 20_001
    assert J.hydrate(ids, archive, rows_per_task=2_000).exceptAll(want).isEmpty()
    assert J.hydrate(ids, archive, rows_per_task=2_000).count() == want.count()
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def test_a_hot_day_is_split_over_files(spark, small_partitions, tmp_path):
    day = F.when(F.col("id") % 3 > 0, F.lit("2020-03-01")).otherwise(F.lit("2020-03-02")).cast("date")
    rows = spark.range(0, 60_000, numPartitions=8).select("id", F.md5(F.col("id").cast("string")).alias("x"), day.alias("date"))
    write_daily_partitions(rows, str(tmp_path / "days"))
    assert len(list((tmp_path / "days/date=2020-03-01").rglob("*.csv"))) > 1
    assert spark.read.option("header", True).csv(str(tmp_path / "days")).count() == 60_000


def test_copies_of_one_url_reach_the_shuffle_as_one_row_per_task(spark, small_partitions):
    hot = F.when(F.col("id") % 3 > 0, F.lit("u")).otherwise(F.col("id").cast("string"))
    posts = spark.range(0, 30_000, numPartitions=4).select(hot.alias("url"), F.col("id").alias("n"))
    first = J.first_per_key(posts, "url", ["n"])
    assert first.count() == 10_001 and first.where("url = 'u'").first().n == 1


def test_tables_that_share_a_day_add_up(spark, tmp_path):
    path = str(tmp_path / "days")

    def write(name, days, date_range=None):
        rows = [(f"2020-03-0{d}", 10 * d + i) for d in days for i in range(2)]
        df = spark.createDataFrame(rows, "date string, id bigint").withColumn("date", F.col("date").cast("date"))
        write_daily_partitions(df, path, date_range, name)

    def stored():
        back = spark.read.option("header", True).csv(path)
        return sorted((str(r.date), r.input, r["count"]) for r in back.groupBy("date", "input").count().collect())

    for _ in range(2):
        write("a", [1, 2])
        write("b", [2, 3])
    both = [("2020-03-01", "a", 2), ("2020-03-02", "a", 2), ("2020-03-02", "b", 2), ("2020-03-03", "b", 2)]
    assert stored() == both
    write("a", [2], ("2020-03-02", "2020-03-03"))  # outside the range nothing changes
    assert stored() == both
    write("a", [2])  # a day that the table has no longer goes
    assert stored() == both[1:]
    write("b", [4], ("2020-03-03", "2020-03-04"))
    assert stored() == [("2020-03-02", "a", 2), ("2020-03-02", "b", 2), ("2020-03-04", "b", 2)]
    with pytest.raises(ValueError, match="input"):
        write_daily_partitions(spark.createDataFrame([("x", 1)], "date string, input int"), path)
