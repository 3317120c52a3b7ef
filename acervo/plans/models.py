"""Bronze, silver and gold models: DataFrames in, one DataFrame out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo import fixed_values as fixed
from acervo.functions import dates, text
from acervo.operators.joins import left_join
from acervo.operators.relations import latest_per_key

CALENDAR = "gold_master_dim_calendar"
TEACHERS = "gold_master_dim_docentes"
MART_ADVISORS = "gold_datamart_publishing_analysis_dim_orientador"
MART_CALENDAR = "gold_datamart_publishing_analysis_dim_publish_calendar"
MART_FACT = "gold_datamart_publishing_analysis_fact"
TEACHER_FIELDS = ["id", "siape", "nome", "campus", "disciplina", "disciplina_primary", "disciplina_secondary"]


def rename_odd_labels(papers: DataFrame) -> DataFrame:
    """All columns, plus the odd labels again under snake-case names."""
    return papers.select(
        "*", *[F.col(f"`{label}`").alias(column) for column, label in fixed.LABEL_COLUMNS.items()]
    )


def silver_papers(
    papers: DataFrame, contents: DataFrame, dedupe: bool = False, raw_urls: bool = False
) -> DataFrame:
    """Dated, cleaned papers with their table of contents: 34 columns.

    Papers with two stored tables of contents come out twice; ``dedupe`` keeps one per paper.
    Cleaning upper-cases addresses; ``raw_urls`` adds them as they were.
    """
    contents = contents.select("paper_id", "tableOfContent")
    if dedupe:
        contents = latest_per_key(contents, "paper_id", ["tableOfContent"])
        papers = latest_per_key(papers, "_id", [])
    renamed = rename_odd_labels(dates.with_pt_date(papers, "Data do documento", "data_publicacao"))
    # Texts are cleaned before the join, once per stored document and not once per joined row.
    raw = {"pdf_url_raw": "_pdf_url", "source_url_raw": "_source_url"} if raw_urls else {}
    own = renamed.select(
        F.col("_id").alias("silver_papers_id"),
        F.col("data_publicacao").alias("silver_papers_data_publicacao"),
        *[
            text.clean_text(F.col(source)).alias(f"silver_papers_{column}")
            for column, source in fixed.SILVER_PAPER_TEXTS.items()
            if source != "tableOfContent"
        ],
        *[F.col(source).alias(f"silver_papers_{column}") for column, source in raw.items()],
    )
    sections = contents.select(
        "paper_id",
        text.null_flag(F.col("tableOfContent")).alias("__has"),
        text.clean_text(F.col("tableOfContent")).alias("silver_papers_table_of_content"),
    )
    # One table of contents per paper leaves no hot key, and both sides are dealt out by the paper already.
    joined = left_join(own, sections, "silver_papers_id", "paper_id", **({"hot_rows": None} if dedupe else {}))
    has_contents = F.coalesce("__has", F.lit(0)).alias("silver_papers_has_table_of_content")
    return joined.select(
        "silver_papers_id",
        "silver_papers_data_publicacao",
        has_contents,
        *[f"silver_papers_{column}" for column in [*fixed.SILVER_PAPER_TEXTS, *raw]],
    )


def silver_teachers(base: DataFrame, name: str = "base_docentes") -> DataFrame:
    """Cleaned teachers; ``name`` is the teacher table's name and prefixes the columns."""
    fixed_discipline = base.select(
        F.col("siape").alias("id"),
        "siape",
        text.clean_text(F.col("nome")).alias("nome"),
        text.clean_text(F.col("campus")).alias("campus"),
        text.clean_text(F.col("nome_da_disciplina")).alias("__clean"),
    ).withColumn("disciplina", text.strip_roman_suffix(F.col("__clean")))
    split = fixed_discipline.withColumns(
        {
            "disciplina_primary": text.split_discipline(F.col("disciplina"), 1),
            "disciplina_secondary": text.split_discipline(F.col("disciplina"), 2),
        }
    )
    return split.select(*[F.col(c).alias(f"silver_{name}_{c}") for c in TEACHER_FIELDS])


def master_teachers(silver: DataFrame, name: str = "base_docentes") -> DataFrame:
    """Teacher dimension with the citation name."""
    return silver.select(
        *[F.col(f"silver_{name}_{c}").alias(f"{TEACHERS}_{c}") for c in TEACHER_FIELDS],
        text.citation_name(F.col(f"silver_{name}_nome")).alias(f"{TEACHERS}_nome_citacao"),
    )


def master_calendar(
    spark: SparkSession, start: str = fixed.CALENDAR_START, end: str = fixed.CALENDAR_END
) -> DataFrame:
    """One row per day, both ends included, 19 columns."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day"))
    spine = spark.range(1).select(F.explode(days).alias("day"))
    attributes = dates.calendar_attributes(F.col("day"))
    return spine.select(*[c.alias(f"{CALENDAR}_{name}") for name, c in attributes.items()])


def advisor_columns(teachers: DataFrame) -> DataFrame:
    """The 8 columns of the advisors, repeated rows and all."""
    fields = [*TEACHER_FIELDS, "nome_citacao"]
    return teachers.select(*[F.col(f"{TEACHERS}_{c}").alias(f"{MART_ADVISORS}_{c}") for c in fields])


def mart_advisors(teachers: DataFrame) -> DataFrame:
    """Distinct advisors, 8 columns."""
    return advisor_columns(teachers).distinct()


def mart_publish_calendar(calendar: DataFrame, as_of: str | Column | None = None) -> DataFrame:
    """Days from 2015 up to ``as_of`` (today by default), 6 columns."""
    today = F.current_date() if as_of is None else as_of
    if isinstance(today, str):
        today = F.lit(today).cast("date")
    fields = {"id": "date_id", "date": "date", "year_month": "year_month", "year": "year",
              "month": "month", "month_name": "month_name"}
    return calendar.where(
        (F.col(f"{CALENDAR}_year") >= fixed.PUBLISH_CALENDAR_FIRST_YEAR) & (F.col(f"{CALENDAR}_date") <= today)
    ).select(*[F.col(f"{CALENDAR}_{c}").alias(f"{MART_CALENDAR}_{name}") for name, c in fields.items()])


def mart_fact(papers: DataFrame, advisors: DataFrame) -> DataFrame:
    """One row per paper and matching advisor, 14 columns; unmatched papers stay.

    ``advisors`` may hold repeated rows: names are made distinct here.
    """
    citation = f"{MART_ADVISORS}_nome_citacao"
    names = advisors.select(f"{MART_ADVISORS}_id", citation).distinct()
    joined = left_join(papers, names, "silver_papers_primeiro_orientador", citation, spread="silver_papers_id")
    advisor_id = F.col(f"{MART_ADVISORS}_id")
    fact = {
        f"{MART_FACT}_id": F.col("silver_papers_id"),
        f"{MART_ADVISORS}_id": advisor_id,
        f"{MART_CALENDAR}_id": dates.date_key(F.col("silver_papers_data_publicacao")),
        f"{MART_FACT}_type": F.col("silver_papers_tipo"),
        f"{MART_FACT}_has_table_of_content": F.col("silver_papers_has_table_of_content"),
        f"{MART_FACT}_title": F.col("silver_papers_titulo"),
        f"{MART_FACT}_uri": F.col("silver_papers_uri"),
        f"{MART_FACT}_cnpq": F.col("silver_papers_cnpq"),
        f"{MART_FACT}_papers_palavras_chave": F.col("silver_papers_palavras_chave"),
        f"{MART_FACT}_papers_titulo": F.col("silver_papers_titulo"),
        f"{MART_FACT}_paper_sigla_da_instituicao": F.col("silver_papers_sigla_da_instituicao"),
        f"{MART_FACT}_qtd_publicacoes": F.lit(1),
        f"{MART_FACT}_qtd_publicacoes_com_orientador_identificado": text.null_flag(advisor_id),
        f"{MART_FACT}_qtd_publicacoes_com_sumario": text.equals_flag(
            F.col("silver_papers_has_table_of_content"), 1
        ),
    }
    return joined.select(*[c.alias(name) for name, c in fact.items()])


def star_summary(fact: DataFrame, calendar: DataFrame, advisors: DataFrame, by: str = "campus") -> DataFrame:
    """Measures of the fact by publishing month and one advisor attribute.

    The fact is summed by its two keys first, so only one row per (advisor, day) is joined. Calendar
    and advisors go by their size.
    """
    measures = ["qtd_publicacoes", "qtd_publicacoes_com_orientador_identificado", "qtd_publicacoes_com_sumario"]
    keys = [f"{MART_ADVISORS}_id", f"{MART_CALENDAR}_id"]
    summed = fact.groupBy(*keys).agg(*[F.sum(f"{MART_FACT}_{m}").alias(m) for m in measures])
    days = calendar.select(f"{MART_CALENDAR}_id", F.col(f"{MART_CALENDAR}_year_month").alias("year_month"))
    people = advisors.select(f"{MART_ADVISORS}_id", F.col(f"{MART_ADVISORS}_{by}").alias(by))
    return (
        summed.join(days, f"{MART_CALENDAR}_id", "left")
        .join(people, f"{MART_ADVISORS}_id", "left")
        .groupBy("year_month", by)
        .agg(*[F.sum(m).alias(m) for m in measures])
    )
