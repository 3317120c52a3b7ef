"""Unions, keyed replacement, value collection and the backfill plan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acervo import fixed_values as fixed
from acervo.functions import urls
from acervo.operators.joins import HOT_ROWS, hot_keys


def _as_text(df: DataFrame, name: str) -> Column:
    """A column as text; arrays, maps and structs as JSON text."""
    kind = df.schema[name].dataType
    column = F.col(f"`{name}`")
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(column)
    return column.cast("string")


def union_relations(relations: dict[str, DataFrame], source_column: str = "__table_source") -> DataFrame:
    """UNION ALL by column name; a column a relation lacks is NULL there.

    Where relations disagree on a column's type, it becomes text everywhere. ``source_column``
    names the origin of each row, so a filter on it prunes whole branches.
    """
    kinds: dict[str, set] = {}
    for df in relations.values():
        for field in df.schema.fields:
            kinds.setdefault(field.name, set()).add(field.dataType.simpleString())
    clashing = {name for name, seen in kinds.items() if len(seen) > 1}

    def branch(name: str, df: DataFrame) -> DataFrame:
        columns = [
            (_as_text(df, c) if c in clashing else F.col(f"`{c}`")).alias(c) for c in df.columns
        ]
        return df.select(F.lit(name).alias(source_column), *columns)

    branches = [branch(name, df) for name, df in relations.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), branches)


def _without_hot_losers(df: DataFrame, key: str, place: Column, hot_rows: int) -> DataFrame:
    """``df`` without the rows that are not the last of a hot or NULL key, whose rows would all meet in one task.

    Their last places, ``NAMED`` and one at most, are found by a partial aggregate and broadcast.
    """
    hot, here = hot_keys(df, key, hot_rows), F.col(f"`{key}`")
    many = df.join(F.broadcast(hot), here == F.col("__hot_key"), "left_semi").union(df.where(here.isNull()))
    best = many.select(here.alias("__key"), place.alias("__place")).groupBy("__key").agg(F.max("__place").alias("__best"))
    met = df.join(F.broadcast(best), here.eqNullSafe(F.col("__key")), "left")
    return met.where(F.col("__best").isNull() | (F.col("__best") == place)).drop("__key", "__best")


def latest_per_key(df: DataFrame, key: str, order: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per key, the last by ``order``: a document written again replaces the earlier one.

    Of rows equal in ``order`` a hash of the row decides, so a task run again picks the same row.
    Whole rows are shuffled once, by the key, and sorted there; a join on the key then moves none again.
    Of a key with more than ``hot_rows`` rows only its last ones are shuffled. Where key and order are the
    whole row, each task first keeps its last row of a key, by the limit that Catalyst puts below the shuffle.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    by = [F.col(f"`{c}`") for c in order]
    if not order or set(df.columns) - {key, *order}:
        by.append(F.xxhash64(*columns))
        # A number alone is aggregated without a sort of the rows.
        place = F.struct(*by) if order else by[0]
        df = _without_hot_losers(df, key, place, hot_rows).repartition(F.col(f"`{key}`"))
    last = F.row_number().over(Window.partitionBy(F.col(f"`{key}`")).orderBy(*[c.desc_nulls_last() for c in by]))
    return df.withColumn("__n", last).where("__n = 1").select(*columns)


def distinct_values(df: DataFrame, keys: list[str], value: str, position: str) -> DataFrame:
    """Distinct values of each group with the position they were first seen at.

    The group is never collected, so a group of any size spreads over its values.
    """
    return df.groupBy(*keys, value).agg(F.min(position).alias("first_seen"))


def label_counts(values: DataFrame, keys: list[str]) -> DataFrame:
    """How many distinct values each group has: more than one means a list."""
    return values.groupBy(*keys).agg(F.count("*").alias("n_values"))


BLOCK_ROWS, MOST_BLOCKS = 1_000_000, 100_000


def numbered_blocks(df: DataFrame, position: Column, blocks: int | None = None, name: str = "block") -> DataFrame:
    """``df`` with the number of the block of ``position`` that each row is in.

    The edges are quantiles, so a burst is split like any other stretch. They are one value, found by
    one aggregate over a single column; a row finds its block by binary search. Without ``blocks`` the
    rows are counted, and there is a block for every ``BLOCK_ROWS`` of them.
    """
    if blocks is None:
        blocks = min(MOST_BLOCKS, max(1, df.count() // BLOCK_ROWS))
    shares = F.array(*[F.lit(i / blocks) for i in range(1, blocks)]) if blocks > 1 else F.array(F.lit(0.5))
    edges = df.select(F.percentile_approx(position, shares, F.lit(10 * blocks)).alias("edges")).scalar()
    if blocks == 1:
        return df.withColumn(name, F.lit(0))

    def halved(place: Column, step: Column) -> Column:
        further = F.coalesce(F.try_element_at("__edges", place + step) <= position, F.lit(False))
        return F.when(further, place + step).otherwise(place)

    steps = F.array(*[F.lit(1 << k) for k in reversed(range(blocks.bit_length()))])
    return df.withColumn("__edges", edges).withColumn(name, F.aggregate(steps, F.lit(0), halved)).drop("__edges")


def drop_consecutive_repeats(
    df: DataFrame, key: list[str], block: list[str], order: list[str], value: str
) -> DataFrame:
    """Drop rows whose value equals the row before within the key; later repeats stay.

    Rows are sorted per (key, block), not per key, so a key with a third of all rows is spread
    over its blocks. The last value of each block reaches the next block through a table with
    one row per block, made by a partial aggregate: the rows themselves are exchanged once. NULL is a
    key and a block like any other: they are compared inside structs.
    """
    packed = df.withColumns({"__key": F.struct(*key), "__block": F.struct(*block)})
    boxed = F.struct(F.col(value).alias("value"))
    ends = packed.groupBy("__key", "__block").agg(F.max_by(boxed, F.struct(*order)).alias("__end"))
    before = ends.select(
        "__key", "__block", F.lag("__end").over(Window.partitionBy("__key").orderBy("__block")).alias("__before")
    )
    here = Window.partitionBy("__key", "__block").orderBy(*order)
    joined = packed.withColumn("__previous", F.lag(boxed).over(here)).join(before, ["__key", "__block"])
    previous = F.coalesce("__previous", "__before")
    repeated = previous.isNotNull() & previous["value"].eqNullSafe(F.col(value))
    return joined.where(~repeated).drop("__previous", "__before", "__key", "__block")


def valid_range(start: Column, end: Column) -> Column:
    """Whether a date range is usable; NULL bounds are not."""
    return F.coalesce(end >= start, F.lit(False))


def search_url(base_url: str, run_mode: Column, publish_date: Column, direct_link: Column) -> Column:
    """Search address of one run: by publishing date, a given link, or '' for an unknown mode."""
    by_date = F.concat(F.lit(base_url), F.format_string(fixed.SEARCH_QUERY, publish_date.cast("string")))
    return (
        F.when(run_mode == fixed.RUN_MODE_PUBLISH_DATE, by_date)
        .when(run_mode == fixed.RUN_MODE_DIRECT_LINK, direct_link)
        .otherwise(F.lit(""))
    )


def backfill_plan(
    requests: DataFrame, base_url: str, days_per_batch: int = 1, strict: bool = False
) -> DataFrame:
    """One run per day (or per ``days_per_batch`` days) of each request's date range.

    ``requests``: date_start, date_end, run_mode, direct_link plus any columns to carry along.
    A range that ends before it starts is left out (see ``rejected_requests``) or, with
    ``strict``, stops the job.
    """
    fine = valid_range(F.col("date_start"), F.col("date_end"))
    if strict:
        checked = requests.where(F.when(fine, True).otherwise(F.raise_error(F.lit(fixed.BAD_DATE_RANGE)).cast("boolean")))
    else:
        checked = requests.where(fine)
    step = F.expr(f"interval {int(days_per_batch)} day")
    runs = checked.withColumn("publish_date", F.explode(F.sequence("date_start", "date_end", step)))
    link = search_url(base_url, F.col("run_mode"), F.col("publish_date"), F.col("direct_link"))
    return runs.withColumn("payload", F.to_json(F.struct(link.alias("url"))))


def run_configurations(plan: DataFrame, bucket: Column) -> DataFrame:
    """Adds ``run_conf``: what each run of the plan is started with, its target bucket included."""
    conf = F.struct(
        "run_mode", F.col("publish_date").cast("string").alias("papers_publish_date"), bucket.alias("aws_bucket_name")
    )
    return plan.withColumn("run_conf", F.to_json(conf))


def rejected_requests(requests: DataFrame) -> DataFrame:
    """Requests whose date range is unusable, with the reason."""
    return requests.where(~valid_range(F.col("date_start"), F.col("date_end"))).withColumn(
        "message", F.lit(fixed.BAD_DATE_RANGE)
    )


def chained_payloads(links: DataFrame, bucket: str) -> DataFrame:
    """Requests of the three document steps (paper, PDF, contents) for each ``link``/``pdf_url``."""
    store = F.lit(bucket)
    item = urls.last_segment(F.col("link"))
    pdf_uri = urls.storage_uri(store, urls.pdf_key(F.lit(fixed.PDF_PREFIX), item))
    paper = F.struct(
        F.col("link").alias("url"), store.alias("bucket"), F.lit(fixed.METADATA_PREFIX).alias("prefix")
    )
    pdf = F.struct(
        item.alias("id"),
        F.col("pdf_url"),
        store.alias("bucket"),
        F.lit(fixed.PDF_PREFIX).alias("prefix"),
    )
    contents = F.struct(
        item.alias("paper_id"),
        pdf_uri.alias("pdf_s3_uri"),
        F.lit(fixed.CONTENTS_PREFIX).alias("output_prefix"),
    )
    return links.select(
        "*",
        F.to_json(paper).alias("paper_payload"),
        F.to_json(pdf).alias("pdf_payload"),
        F.to_json(contents).alias("contents_payload"),
    )


def json_map_total(c: Column) -> Column:
    """Sum of the values of a JSON object of numbers; NULL where it is not one."""
    amounts = F.from_json(c, "map<string,double>")
    return F.aggregate(F.map_values(amounts), F.lit(0.0), lambda total, v: total + v)
