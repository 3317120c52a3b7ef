"""JSON documents: fixed schemas, column mapping, keyed append and read-back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acervo import fixed_values as fixed
from acervo.operators.relations import latest_per_key


def text_schema(keys: list[str]) -> T.StructType:
    """All keys as nullable text: a missing key is NULL and a list arrives as JSON text."""
    return T.StructType([T.StructField(key, T.StringType()) for key in keys])


PAPERS = text_schema(fixed.PAPER_KEYS)
CONTENTS = text_schema(fixed.CONTENTS_KEYS)


def read_json(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """JSON lines under a folder, one object per line, with a fixed schema: no inference pass."""
    return spark.read.schema(schema).option("multiLine", False).json(path)


#: Labels that documents may have besides the fixed ones; more than that are no labels but data.
MOST_LABELS = 10_000


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path).where(F.col("value").rlike(r"\S"))


def labels_seen(spark: SparkSession, path: str | list[str]) -> list[str]:
    """All labels of the documents under a folder, sorted; at most ``MOST_LABELS``.

    Each task gives out a label once; the distinct labels alone are shuffled and collected.
    """
    seen = _lines(spark, path).select(F.explode(F.json_object_keys("value")).alias("label")).distinct()
    found = sorted(r["label"] for r in seen.limit(MOST_LABELS + 1).collect())
    if len(found) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labels under {path}")
    return found


def read_merged(spark: SparkSession, path: str | list[str], schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(documents, unreadable lines) of a folder of JSON lines.

    The documents have the columns of ``schema`` and, after them, every further label that some document
    has, as text. A line that is no JSON object is set aside in the column ``line``. Blank lines are
    neither. A label that differs from an earlier column in case only gets a number after its name.
    """
    known = set(schema.fieldNames())
    more = [label for label in labels_seen(spark, path) if label not in known]
    names: list[str] = []
    for label in [*schema.fieldNames(), *more]:
        same = sum(n.lower() == label.lower() for n in names)
        names.append(f"{label} ({same + 1})" if same else label)
    bad = "__unreadable"
    fields = T.StructType([*schema.fields, *text_schema(more).fields, T.StructField(bad, T.StringType())])
    parsed = F.from_json("value", fields, {"columnNameOfCorruptRecord": bad})
    # A generator's row: the line is parsed once, not once for each column and filter.
    rows = _lines(spark, path).select("value", F.inline(F.array(parsed))).toDF("__line", *names, bad)
    fine = F.col(bad).isNull() & F.ltrim("__line").startswith("{")
    return rows.where(fine).select(*[f"`{n}`" for n in names]), rows.where(~fine).select(F.col("__line").alias("line"))


def read_mapped(spark: SparkSession, path: str | list[str], mapping: dict[str, str]) -> DataFrame:
    """External table over JSON: ``mapping`` gives the document key behind each column."""
    raw = read_json(spark, path, text_schema(list(mapping.values())))
    return raw.select(*[F.col(f"`{key}`").alias(column) for column, key in mapping.items()])


def metadata_table(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_mapped(spark, path, fixed.METADATA_MAPPING)


def contents_table(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_mapped(spark, path, fixed.CONTENTS_MAPPING)


def period_name(base: str, period: str = fixed.DEFAULT_PERIOD) -> str:
    """Relation name of one two-year period."""
    return f"{base}_{period}"


def overwrite_table(df: DataFrame, path: str) -> DataFrame:
    """Drop and recreate a stored table; returns it as read back, with a short lineage."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_documents(documents: DataFrame, path: str, run: int) -> None:
    """Store one run's JSON documents (column ``document``), one per line, in its own folder.

    A run that is written again replaces only its own folder.
    """
    documents.select(F.col("document").alias("value")).write.mode("overwrite").text(f"{path}/run={run}")


def read_latest_documents(spark: SparkSession, path: str, schema: T.StructType, key: str) -> DataFrame:
    """Documents under ``path``, the last run's for every key."""
    runs = read_json(spark, path, T.StructType([*schema.fields, T.StructField("run", T.LongType())]))
    return latest_per_key(runs, key, ["run"]).drop("run")


def stored_objects(spark: SparkSession, path: str) -> DataFrame:
    """Listing of the files under ``path``: path and length; no content is read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
