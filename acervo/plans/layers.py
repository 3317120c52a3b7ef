"""Registry of models and the layer build."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo import fixed_values as fixed
from acervo.operators.relations import union_relations
from acervo.plans import models
from acervo.sources import documents, tables


@dataclass
class Model:
    """``build`` gets its inputs in the order of ``inputs``."""

    build: Callable[..., DataFrame]
    inputs: list[str]
    layer: str
    tags: set[str]
    view: bool = False


@dataclass
class Settings:
    """Where the documents are and what the run is about."""

    metadata_path: str
    contents_path: str
    teachers: DataFrame
    teacher_table: str = "base_docentes"
    periods: list[str] = field(default_factory=lambda: list(fixed.PERIODS))
    period_folder: str = "{}"
    as_of: str | None = None
    empty: frozenset[str] = frozenset()  # relations whose period has no folder; any other must have one
    merge_labels: bool = False  # keep labels outside the fixed list, and leave unreadable lines out


def registry(spark: SparkSession, settings: Settings) -> dict[str, Model]:
    """All models in dependency order."""
    base = settings.teacher_table

    def stage(name: str, folder: str, period: str, schema) -> Callable[[], DataFrame]:
        if name in settings.empty:
            return lambda: spark.createDataFrame([], schema)
        path = f"{folder}/{settings.period_folder.format(period)}"
        if settings.merge_labels:
            return lambda: documents.read_merged(spark, path, schema)[0]
        return lambda: documents.read_json(spark, path, schema)

    out: dict[str, Model] = {}
    for kind, folder, schema in (
        ("papers_metadata", settings.metadata_path, documents.PAPERS),
        ("papers_tableofcontent", settings.contents_path, documents.CONTENTS),
    ):
        names = [documents.period_name(kind, period) for period in settings.periods]
        for period, name in zip(settings.periods, names):
            out[name] = Model(stage(name, folder, period, schema), [], "stage", {"stage"})
        union = lambda *dfs, names=names: union_relations(dict(zip(names, dfs)))
        out[f"bronze_{kind}"] = Model(union, names, "bronze", {"bronze"}, view=True)
    out[base] = Model(lambda: settings.teachers, [], "stage", {"stage"})
    out[f"bronze_{base}"] = Model(lambda df: df, [base], "bronze", {"bronze"}, view=True)
    out["silver_papers"] = Model(
        models.silver_papers, ["bronze_papers_metadata", "bronze_papers_tableofcontent"], "silver", {"silver"}
    )
    out[f"silver_{base}"] = Model(
        lambda df: models.silver_teachers(df, base), [f"bronze_{base}"], "silver", {"silver"}
    )
    out["gold_master_dim_calendar"] = Model(
        lambda: models.master_calendar(spark), [], "gold", {"gold", "master_dim"}
    )
    out["gold_master_dim_docente"] = Model(
        lambda df: models.master_teachers(df, base), [f"silver_{base}"], "gold", {"gold", "master_dim"}
    )
    out[models.MART_ADVISORS] = Model(
        models.mart_advisors, ["gold_master_dim_docente"], "gold", {"gold", "publishing_analysis", "dim"}
    )
    out[models.MART_CALENDAR] = Model(
        lambda df: models.mart_publish_calendar(df, settings.as_of),
        ["gold_master_dim_calendar"],
        "gold",
        {"gold", "publishing_analysis", "dim"},
    )
    out[models.MART_FACT] = Model(
        models.mart_fact,
        ["silver_papers", models.MART_ADVISORS],
        "gold",
        {"gold", "publishing_analysis", "fact"},
    )
    return out


def unreadable_lines(spark: SparkSession, settings: Settings) -> DataFrame:
    """Lines of all periods that are no JSON object, with the relation they were read for."""
    found = []
    for kind, folder, schema in (
        ("papers_metadata", settings.metadata_path, documents.PAPERS),
        ("papers_tableofcontent", settings.contents_path, documents.CONTENTS),
    ):
        for period in settings.periods:
            name = documents.period_name(kind, period)
            if name not in settings.empty:
                lines = documents.read_merged(spark, f"{folder}/{settings.period_folder.format(period)}", schema)[1]
                found.append(lines.select(F.lit(name).alias("relation"), "line"))
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], "relation string, line string")


def build(
    spark: SparkSession, settings: Settings, warehouse: str, tags: set[str] | None = None
) -> dict[str, DataFrame]:
    """Build the models that carry one of ``tags`` (all by default) in dependency order.

    Views stay lazy. Tables are written to ``<warehouse>/<layer>/<model>`` and read back, so
    the next layer starts from stored data. A model that was not selected is taken from the
    warehouse where it is stored there before, and is otherwise computed on the way. The layer
    schemas are created where missing. All inputs are looked up before anything is written.
    """
    tables.create_layers(spark)
    chosen = registry(spark, settings)
    built: dict[str, DataFrame] = {}

    def stored(path: str) -> DataFrame | None:
        try:
            return spark.read.parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def resolve(name: str) -> DataFrame:
        if name in built:
            return built[name]
        model = chosen[name]
        path = tables.table_path(warehouse, tables.layer_schema(model.layer, "stage"), name)
        selected = tags is None or bool(model.tags & tags)
        earlier = None if selected or model.view else stored(path)
        if earlier is not None:
            built[name] = earlier
            return earlier
        df = model.build(*[resolve(dep) for dep in model.inputs])
        if model.view:
            df.createOrReplaceTempView(name)
        elif selected:
            df = documents.overwrite_table(df, path)
        built[name] = df
        return df

    return {
        name: resolve(name) for name, model in chosen.items() if tags is None or model.tags & tags
    }
