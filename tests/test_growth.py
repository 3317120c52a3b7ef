"""What keeps the work in proportion to the input, on rows of its own."""

from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F

from acervo.operators import joins, markup, relations
from acervo.session import prepare, spread
from acervo.workloads import inputs, pages, stored, warehouse
from tables import rows


@pytest.fixture
def folder(spark, tmp_path):
    """Customers in one split, nations, orders and line items."""
    tables = {
        "customer": "SELECT id AS c_custkey, concat('Customer#', lpad(id, 9, '0')) AS c_name, int(id % 2) AS c_nationkey, 'M' AS c_mktsegment FROM range(400)",
        "nation": "SELECT int(id) AS n_nationkey, concat('N', id) AS n_name FROM range(2)",
        "supplier": "SELECT id AS s_suppkey, int(id % 2) AS s_nationkey FROM range(60)",
        "orders": "SELECT id AS o_orderkey, id % 7 AS o_custkey, 'F' AS o_orderstatus, timestamp'1995-02-03' AS o_orderdate, '1-URGENT' AS o_orderpriority FROM range(300)",
        "lineitem": "SELECT id AS l_orderkey, 1 AS l_linenumber, 3.0D AS l_quantity, timestamp'1995-02-03' AS l_shipdate FROM range(300)",
    }
    for name, sql in tables.items():
        spark.sql(sql).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def _per_task(df):
    return [n for (n,) in rows(df.groupBy(F.spark_partition_id().alias("task")).count(), "count")]


def test_rows_of_one_split_are_spread(spark):
    one = spark.range(800).coalesce(1)
    assert spread(one).count() == 800
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert spread(one).rdd.getNumPartitions() == tasks


@pytest.mark.parametrize("full", [False, True])
def test_pages_of_one_split_are_read_by_all_tasks(spark, folder, full):
    rendered = pages.rendered(spark, folder, full)
    dealt = _per_task(rendered)
    assert sum(dealt) == 400 and len(dealt) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(dealt) < 200


def test_a_hot_key_gets_no_more_salts_than_help(spark, folder):
    tasks = spark.sparkContext.defaultParallelism
    right = spark.range(5000).selectExpr("'hot' AS k", "id")
    few = joins.useful_salts(joins.hot_keys(right, "k", 2), 2)
    assert rows(few) == [("hot", min(2500, tasks))]
    many = spark.createDataFrame([("hot", 100_000)], "__hot_key string, __salts long")
    assert rows(joins.useful_salts(many, 10_000)) == [("hot", max(1000, tasks))]
    assert rows(joins.useful_salts(many, joins.HOT_ROWS)) == [("hot", 100_000)]
    joined = warehouse.q_left_join_hot(spark, folder)
    assert joined.count() == 400 * 30 and joined.distinct().count() == 400 * 30


def test_links_of_containers_are_found_in_the_page_row(spark):
    html = """</table><table summary="other"><tr><td><a href="/no">x</a></td></tr></table></table>
      <table summary="S"><a href="/1">a</a><table><a href="/2&amp;amp;">b</a></table><a href="/3">c</a></table>
      <a href="/no">d</a><table/><table summary="other"><table summary="S"><a href="">e</a><a href="/4">f</a></table>
      <a href="/no">g</a></table><table summary="S"><a href="/5">h</a></table><table summary="S"><table summary="S"></table><a href="/6">i</a>"""
    one = spark.createDataFrame([(1, "https://h.example/p", html)], "page_id long, url string, html string")
    links = markup.container_links(one.union(one), "table", "S")
    got = [r["link"] for r in links.orderBy("pos").collect()]
    assert got == [f"https://h.example/{n}" for n in ("1", "2&amp;", "3", "4", "5", "6")]
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_partitions_of_joins_stay_small(spark):
    prepare(spark)
    size = lambda name: spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))
    assert size("spark.sql.adaptive.advisoryPartitionSizeInBytes") <= 16 << 20
    assert size("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes") <= 32 << 20


def test_a_session_of_few_partitions_gets_enough_for_large_inputs(spark):
    prepare(spark)
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) < 200
    summed = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert ", 200)" in summed._jdf.queryExecution().executedPlan().toString()
    assert sorted(rows(summed)) == [(k, 143 if k < 6 else 142) for k in range(7)]


def test_the_last_of_a_key_without_an_order_is_found_without_a_sort_of_all_rows(spark):
    twice = spark.sql("SELECT * FROM VALUES ('a', 1), ('a', 1), ('a', 2), (NULL, 3), (NULL, 3), ('b', NULL) AS t(k, v)")
    last = relations.latest_per_key(twice, "k", [])
    assert sorted(map(str, (r["k"] for r in last.collect()))) == ["None", "a", "b"]
    assert rows(relations.latest_per_key(twice, "k", ["v"]).where("k = 'a'")) == [("a", 2)]
    assert "SortAggregate" not in last._jdf.queryExecution().executedPlan().toString()


def test_staged_documents_are_compressed(spark, folder, tmp_path):
    built = stored._build(spark, folder, f"{tmp_path}/layers", {"silver"})
    assert built["silver_papers"].count() == 300
    for kind in ("papers", "contents"):
        parts = glob.glob(f"{tmp_path}/layers/{kind}/period=*/part-*")
        assert parts and all(p.endswith(".lz4") for p in parts)


def test_papers_of_one_split_are_dealt_out(spark, folder):
    papers = inputs.papers(spark, folder)
    assert len(_per_task(papers)) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(rows(papers, "_id")) == 300


def test_staged_json_is_written_by_several_tasks_without_a_sort(spark, folder, tmp_path):
    stored._build(spark, folder, f"{tmp_path}/layers", {"stage"})
    files = glob.glob(f"{tmp_path}/layers/papers/*/*.json.lz4")
    assert len(files) >= spark.sparkContext.defaultParallelism // 2  # files of lz4 are not split by their readers
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "32"


def test_a_left_row_meets_the_right_rows_of_its_key_in_packs(spark, folder, monkeypatch):
    monkeypatch.setattr(joins, "PACK_ROWS", 8)
    left = spark.createDataFrame([(0.0, 1), (-0.0, 2), (5.0, 3), (7.0, 4), (None, 5), (None, 5)], "k double, v int")
    copies = [(-0.0, "same")] * 60 + [(-0.0, f"r{i}") for i in range(41)] + [(5.0, None), (None, "x"), (6.0, "o")]
    right = spark.createDataFrame(copies, "rk double, v string").repartition(3)
    plain = left.join(right, F.col("k") == F.col("rk"), "left").toDF("k", "n", "rk", "v")
    for hot_rows in (2, 50, joins.HOT_ROWS):
        got = joins.left_join(left, right, "k", "rk", hot_rows=hot_rows, pack=True)
        assert got.columns == ["k", "v", "rk", "v"]
        assert rows(got.toDF("k", "n", "rk", "v")) == rows(plain)
    packs = joins.packed(right.withColumn("s", F.lit(0)), "rk", "s")
    assert rows(packs.select(F.size("__rows"))) == [(1,), (1,), (5,)] + [(8,)] * 12
    monkeypatch.setattr(joins, "PACK_ROWS", 256)
    joined = warehouse.q_left_join_hot(spark, folder)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.index("inline(__rows") < plan.index("Join")


def test_papers_kept_once_are_shuffled_once(spark, folder):
    silver = warehouse.q_silver_options(spark, folder)
    assert silver.count() == 300 and silver.select("silver_papers_id").distinct().count() == 300
    plan = silver._jdf.queryExecution().executedPlan().toString().splitlines()
    by_paper = [line for line in plan if "Exchange hashpartitioning" in line and "(__key" not in line]
    assert len(by_paper) == 2  # the papers, and the tables of contents
    assert not any("salt" in line for line in by_paper)


@pytest.mark.parametrize("hot_rows", [3, 1000])
@pytest.mark.parametrize("order", [[], ["run"], ["run", "v"]])
def test_only_the_last_rows_of_a_hot_key_are_shuffled(spark, hot_rows, order):
    data = [("hot", i % 9, f"v{i % 7}", i % 3) for i in range(120)] + [(None, i % 4, "n", None) for i in range(40)]
    data += [("a", 1, "x", 1), ("a", 1, "x", 1), ("a", None, "y", 2), ("b", None, None, 1)]
    df = spark.createDataFrame(data, "k string, run int, v string, more int").repartition(3)
    got = rows(relations.latest_per_key(df, "k", order, hot_rows))
    assert [r[0] for r in got] == ["a", "b", "hot", None] and set(got) <= set(data)
    if order:
        assert {r[0]: r[1] for r in got} == {"hot": 8, None: 3, "a": 1, "b": None}
    if len(order) == 2:
        assert {r[0]: r[2] for r in got} == {"hot": "v6", None: "n", "a": "x", "b": None}
    place = F.struct("run", "v")
    left = relations._without_hot_losers(df, "k", place, hot_rows)
    kept = {r["k"]: r["count"] for r in left.groupBy("k").count().collect()}
    ends = {"hot": sum(r[:3] == ("hot", 8, "v6") for r in data), None: 10}
    assert kept == {"a": 3, "b": 1, None: 10, "hot": ends["hot"] if hot_rows == 3 else 120}


def test_rows_that_key_and_order_make_up_are_limited_before_the_shuffle(spark):
    pairs = spark.sql("SELECT id % 5 AS k, id AS v FROM range(0, 500, 1, 4)")
    last = relations.latest_per_key(pairs, "k", ["v"])
    assert rows(last) == [(k, 495 + k) for k in range(5)]
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("WindowGroupLimit", plan.index("Exchange"))
