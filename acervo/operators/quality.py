"""Data tests: each returns one row per check with its number of violations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _result(df: DataFrame, check: str, column: str) -> DataFrame:
    return df.select(
        F.lit(check).alias("check"),
        F.lit(column).alias("column_name"),
        F.col("violations"),
        (F.col("violations") == 0).alias("passed"),
    )


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows where the column is NULL."""
    return _result(df.agg(F.count_if(F.col(f"`{column}`").isNull()).alias("violations")), "not_null", column)


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values seen more than once; NULLs do not count."""
    name = F.col(f"`{column}`")
    seen = df.where(name.isNotNull()).groupBy(name.alias("__value")).agg(F.count("*").alias("n"))
    return _result(seen.agg(F.count_if(F.col("n") > 1).alias("violations")), "unique", column)


def run_all(df: DataFrame, tests: list[tuple[str, str]]) -> DataFrame:
    """All tests of a table, (``not_null`` or ``unique``, column) each, in one scan and one shuffle.

    A row gives out what its tests have to see: a NULL for ``not_null``, a value as text for ``unique``.
    Equal ones are counted before the shuffle, so a column of few values or NULLs makes few rows.
    """
    seen = [
        F.when(F.col(f"`{column}`").isNull() if test == "not_null" else F.col(f"`{column}`").isNotNull(),
               F.struct(F.lit(i).alias("i"), F.col(f"`{column}`").cast("string").alias("value")))
        for i, (test, column) in enumerate(tests)
    ]
    counted = df.select(F.inline(F.array_compact(F.array(*seen)))).groupBy("i", "value").agg(F.count("*").alias("n"))
    kinds = F.array(*[F.lit(test) for test, _ in tests])
    broken = F.when(kinds[F.col("i")] == "not_null", F.col("n")).otherwise((F.col("n") > 1).cast("long"))
    # Added up per test, so that a test without a row has its row too: an array of all tests' sums.
    sums = [F.sum(F.when(F.col("i") == i, broken)) for i in range(len(tests))]
    names = [F.struct(F.lit(t).alias("check"), F.lit(c).alias("column_name"), F.coalesce(s, F.lit(0).cast("long")).alias("violations")) for (t, c), s in zip(tests, sums)]
    results = counted.agg(F.array(*names).alias("results")).select(F.inline("results"))
    return results.withColumn("passed", F.col("violations") == 0)
