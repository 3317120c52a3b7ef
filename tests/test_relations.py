from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from acervo.operators import joins, quality, relations
from tables import rows


def test_union_relations(spark):
    a = spark.sql("SELECT 1 AS id, 'x' AS `Título`, array('p', 'q') AS tags")
    b = spark.sql("SELECT 2 AS id, 'one' AS tags, 9 AS `m.n`")
    got = relations.union_relations({"t_2015": a, "t_2017": b})
    assert rows(got, "__table_source", "id", "Título", "tags", "`m.n`") == [
        ("t_2015", 1, "x", '["p","q"]', None),
        ("t_2017", 2, None, "one", 9),
    ]


def test_union_filter_on_source_prunes_branches(spark):
    a, b = spark.range(5).toDF("id"), spark.range(7).toDF("id")
    got = relations.union_relations({"a": a, "b": b}).where("__table_source = 'b'")
    assert got.count() == 7
    assert "Union" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_latest_per_key(spark):
    df = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (2, "only", 1)], "id int, v string, run int")
    assert rows(relations.latest_per_key(df, "id", ["run"])) == [(1, "new", 2), (2, "only", 1)]
    repeated = df.unionByName(df).unionByName(spark.sql("SELECT CAST(NULL AS INT) AS id, 'x' AS v, CAST(NULL AS INT) AS run"))
    assert rows(relations.latest_per_key(repeated, "id", ["run"])) == [(1, "new", 2), (2, "only", 1), (None, "x", None)]


def test_latest_per_key_aggregates_narrow_rows(spark):
    df = spark.createDataFrame([(1, "wide", 1)], "id int, wide string, run int")
    plan = relations.latest_per_key(df, "id", ["run"])._jdf.queryExecution().executedPlan().toString()
    aggregates = [line for line in plan.splitlines() if "Aggregate" in line]
    assert aggregates and not any("wide" in line.split("functions=")[1] for line in aggregates)


def test_distinct_values_keep_first_position(spark):
    df = spark.createDataFrame(
        [("p", "Autor", "B", 1), ("p", "Autor", "A", 2), ("p", "Autor", "B", 3), ("q", "Autor", "A", 1)],
        "page string, label string, value string, pos int",
    )
    values = relations.distinct_values(df, ["page", "label"], "value", "pos")
    assert rows(values, "page", "value", "first_seen") == [("p", "A", 2), ("p", "B", 1), ("q", "A", 1)]
    assert rows(relations.label_counts(values, ["page", "label"])) == [("p", "Autor", 2), ("q", "Autor", 1)]


def _events(spark):
    """One key holds most rows; runs of equal values cross every block border."""
    data = [(k, i, "ab"[(i // 7) % 2] if i % 5 else None) for k, n in ((1, 300), (2, 20), (3, 1)) for i in range(n)]
    return data, spark.createDataFrame(data, "k int, i int, v string").repartition(5)


@pytest.mark.parametrize("block", [1, 7, 10, 1000])
def test_consecutive_repeats_do_not_depend_on_blocks(spark, block):
    data, df = _events(spark)
    expected, last = [], {}
    for k, i, v in sorted(data, key=lambda r: r[:2]):
        if k not in last or last[k] != v:
            expected.append((k, i, v))
        last[k] = v
    blocked = df.withColumn("b", F.floor(F.col("i") / block))
    got = relations.drop_consecutive_repeats(blocked, ["k"], ["b"], ["i"], "v")
    assert sorted(map(tuple, got.select("k", "i", "v").collect())) == sorted(expected, key=lambda r: r[:2])


def test_blocks_split_a_burst(spark):
    data = [(i if i % 100 == 0 else 1_000_000_000 + i,) for i in range(2000)] + [(None,)]
    df = spark.createDataFrame(data, "i bigint")
    sizes = [r["count"] for r in relations.numbered_blocks(df, F.col("i"), blocks=20).groupBy("block").count().collect()]
    assert len(sizes) == 20 and max(sizes) <= 150 and sum(sizes) == 2001


def test_consecutive_repeats_keep_null_keys_and_blocks(spark):
    data = [(None, None, 1, "a"), (None, None, 2, "a"), (None, 5, 3, "a"), (None, 5, 4, "b"), (1, None, 1, "a"), (1, 2, 2, "a")]
    df = spark.createDataFrame(data, "k int, b int, i int, v string")
    got = relations.drop_consecutive_repeats(df, ["k"], ["b"], ["i"], "v")
    assert rows(got, "k", "i", "v") == [(1, 1, "a"), (None, 1, "a"), (None, 4, "b")]


@pytest.mark.parametrize("hot_rows", [10, 50, 10**6])
def test_left_join_with_hot_and_null_keys(spark, hot_rows):
    left = spark.createDataFrame(
        [("hot", 1), ("hot", 2), ("cold", 3), ("none", 4), (None, 5), (None, 6)], "key string, n int"
    )
    copies = [("hot", "same")] * 60 + [("hot", f"r{i}") for i in range(40)]
    right = spark.createDataFrame(copies + [("cold", "c1"), ("cold", "c2"), ("other", "o"), (None, "x")], "rk string, v string")
    right = right.repartition(4)
    plain = left.join(right, F.col("key") == F.col("rk"), "left").select("key", "n", "rk", "v")
    for spread in (None, "n"):
        got = joins.left_join(left, right, "key", "rk", spread=spread, hot_rows=hot_rows)
        assert got.columns == ["key", "n", "rk", "v"]
        assert rows(got) == rows(plain)
    hot = rows(joins.hot_keys(right, "rk", hot_rows))
    assert hot == ([("hot", 100 // hot_rows)] if hot_rows < 100 else [])


def _requests(spark):
    return spark.createDataFrame(
        [
            (1, dt.date(2026, 6, 1), dt.date(2026, 6, 30), "PUBLISH_DATE", None),
            (2, dt.date(2026, 6, 1), dt.date(2026, 6, 1), "DIRECT_LINK", "https://h.example/x"),
            (3, dt.date(2026, 6, 2), dt.date(2026, 6, 1), "PUBLISH_DATE", None),
            (4, dt.date(2026, 6, 1), dt.date(2026, 6, 1), "SOMETHING", None),
        ],
        "id int, date_start date, date_end date, run_mode string, direct_link string",
    )


def test_backfill_plan(spark):
    plan = relations.backfill_plan(_requests(spark), "https://h.example")
    assert {r["id"]: r["count"] for r in plan.groupBy("id").count().collect()} == {1: 30, 2: 1, 4: 1}
    payloads = dict(plan.where("publish_date = date'2026-06-01'").select("id", "payload").collect())
    assert payloads[1] == (
        '{"url":"https://h.example/simple-search?location=&query=&filter_field_1=dateIssued'
        '&filter_type_1=equals&filter_value_1=2026-06-01&rpp=9999"}'
    )
    assert payloads[2] == '{"url":"https://h.example/x"}'
    assert payloads[4] == '{"url":""}'
    assert relations.backfill_plan(_requests(spark), "", days_per_batch=10).where("id = 1").count() == 3
    assert rows(relations.rejected_requests(_requests(spark)), "id", "message") == [(3, "date_end must be >= date_start")]
    with pytest.raises(Exception, match="date_end must be"):
        relations.backfill_plan(_requests(spark), "", strict=True).collect()


def test_json_map_total(value):
    texts = ['{"1001": 301.27, "1002": 433.21, "1003": 502.22}', '{"a": 1.5, "b": 2.25}', "{}", None, "broken"]
    got = value(relations.json_map_total, texts)
    assert round(got[0], 2) == 1236.70
    assert got[1:4] == [3.75, 0.0, None]
    assert got[4] in (None, 0.0)


def test_quality(spark):
    df = spark.createDataFrame([("1", "a"), ("1", None), (None, "b"), (None, "c")], "id string, d string")
    assert rows(quality.not_null(df, "d")) == [("not_null", "d", 1, False)]
    assert rows(quality.not_null(df.where("d is not null"), "d")) == [("not_null", "d", 0, True)]
    assert rows(quality.unique(df, "id")) == [("unique", "id", 1, False)]
    assert rows(quality.unique(df, "d")) == [("unique", "d", 0, True)]


def test_all_tests_of_a_table_in_one_pass(spark):
    df = spark.createDataFrame([(1, "a", None), (1, None, None), (2, None, "x"), (None, "b", "x")], "i int, s string, t string")
    tests = [("not_null", "i"), ("unique", "i"), ("not_null", "s"), ("unique", "s"), ("not_null", "t"), ("unique", "t")]
    results = quality.run_all(df, tests)
    assert [tuple(r) for r in results.collect()] == [
        ("not_null", "i", 1, False), ("unique", "i", 1, False), ("not_null", "s", 2, False),
        ("unique", "s", 0, True), ("not_null", "t", 2, False), ("unique", "t", 1, False),
    ]
    assert all(r["passed"] for r in quality.run_all(df.limit(0), tests).collect())
    plan = quality.run_all(df, tests)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_hot_keys_are_found_by_a_sketch(spark):
    rows_ = [("hot", i) for i in range(500)] + [("warm", i) for i in range(60)] + [(f"k{i}", i) for i in range(300)] + [(None, 0)] * 900
    got = joins.hot_keys(spark.createDataFrame(rows_, "k string, i int").repartition(5), "k", 50)
    assert rows(got) == [("hot", 10), ("warm", 2)]
    assert "keys=[k" not in got._jdf.queryExecution().executedPlan().toString()
    assert joins.hot_keys(spark.createDataFrame([], "k string"), "k", 50).count() == 0


def test_blocks_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(relations, "BLOCK_ROWS", 100)
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.when(F.col("id") > 0, F.col("id") * F.col("id")).alias("i"), (F.col("id") % 3 % 2).alias("v"))
    blocked = relations.numbered_blocks(df, F.col("i"))
    sizes = [r["count"] for r in blocked.groupBy("block").count().collect()]
    assert len(sizes) == 10 and max(sizes) <= 125
    edges = blocked.groupBy("block").agg(F.min("i"), F.max("i")).orderBy("block").collect()
    assert all(a[2] < b[1] for a, b in zip(edges, edges[1:]))
    kept = relations.drop_consecutive_repeats(blocked, ["k"], ["block"], ["i"], "v")
    one = relations.drop_consecutive_repeats(df.withColumn("block", F.lit(0)), ["k"], ["block"], ["i"], "v")
    assert rows(kept, "k", "i", "v") == rows(one, "k", "i", "v")
