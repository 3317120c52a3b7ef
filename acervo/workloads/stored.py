"""Queries that go through storage: JSON loads, keyed documents, layer build, export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo import fixed_values as fixed
from acervo.plans import checks, ingest, layers, models
from acervo.session import work_dir
from acervo.sources import documents, tables
from acervo.streaming.ingest import load_new_files
from acervo.workloads import inputs, lines, pages, warehouse

QUERIES, ORACLES = {}, {}


def _write_json(df: DataFrame, path: str) -> str:
    """JSON lines without NULL keys, so files lack different columns."""
    df.write.mode("overwrite").option("ignoreNullFields", True).json(path)
    return path


def q_json_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "json-load")
    _write_json(inputs.papers(spark, sf_dir), f"{folder}/in")
    loaded = documents.read_json(spark, f"{folder}/in", documents.PAPERS)
    return documents.overwrite_table(loaded, f"{folder}/papers_metadata")


ORACLES["q_json_load"] = inputs.PAPERS_SQL


def _mixed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of changing labels as lines, and lines that are no documents."""
    orders = inputs.load(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS _id", "concat('T', o_custkey) AS `Título`",
        "CASE WHEN o_orderkey % 3 = 0 THEN concat('Selo ', o_custkey) END AS `Selo (novo)`",
        "CASE WHEN o_orderkey % 5 = 0 THEN array('a', o_orderpriority) END AS `a.b`",
    )
    return orders.select(
        F.expr("CASE _id % 13 WHEN 4 THEN concat('{\"_id\": \"', _id) WHEN 5 THEN concat('[', _id, ']') WHEN 6 THEN ' ' "
               "ELSE to_json(struct(string(_id) AS _id, `Título`, `Selo (novo)`, `a.b`)) END").alias("value")
    )


def q_json_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every label that some document has, whether listed or not, and the lines that are none."""
    folder = work_dir(spark, "json-merged")
    _mixed_lines(spark, sf_dir).write.text(f"{folder}/in")
    good, bad = documents.read_merged(spark, f"{folder}/in", documents.PAPERS)
    own = good.select("_id", F.col("Título").alias("titulo"), F.col("`Selo (novo)`").alias("selo"), F.col("`a.b`").alias("ab"), F.lit(len(good.columns)).alias("n_columns"))
    return own.withColumn("line", F.lit(None).cast("string")).unionByName(bad, allowMissingColumns=True)


ORACLES["q_json_merged"] = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS _id, 'T' || o_custkey AS titulo,
  CASE WHEN o_orderkey % 3 = 0 THEN 'Selo ' || o_custkey END AS selo,
  CASE WHEN o_orderkey % 5 = 0 THEN '["a","' || o_orderpriority || '"]' END AS ab,
  {len(documents.PAPERS.fields) + 2} AS n_columns, NULL AS line
FROM orders WHERE o_orderkey % 13 NOT IN (4, 5, 6)
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL,
  CASE o_orderkey % 13 WHEN 4 THEN '{{"_id": "' || o_orderkey ELSE '[' || o_orderkey || ']' END
FROM orders WHERE o_orderkey % 13 IN (4, 5)"""


def q_json_load_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "json-contents")
    _write_json(inputs.contents(spark, sf_dir), f"{folder}/in")
    return documents.contents_table(spark, f"{folder}/in")


ORACLES["q_json_load_contents"] = (
    f'SELECT paper_id, "tableOfContent" AS table_of_content FROM ({inputs.CONTENTS_SQL})'
)


def q_json_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "json-mapping")
    _write_json(inputs.papers(spark, sf_dir), f"{folder}/in")
    return documents.metadata_table(spark, f"{folder}/in")


ORACLES["q_json_mapping"] = (
    "SELECT "
    + ", ".join(f'"{key}" AS {column}' for column, key in fixed.METADATA_MAPPING.items())
    + f" FROM ({inputs.PAPERS_SQL})"
)


def q_document_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every paper stored once, the finished ones stored again with another type: last one wins."""
    folder = work_dir(spark, "documents")
    papers = inputs.papers(spark, sf_dir).select("_id", "Tipo", "Sigla da Instituição")
    as_json = F.to_json(F.struct(*[F.col(f"`{c}`") for c in papers.columns])).alias("document")
    again = papers.where(F.col("Tipo") == "Dissertação").withColumn("Tipo", F.lit("Revisão"))
    documents.append_documents(papers.select(as_json), folder, run=1)
    documents.append_documents(again.select(as_json), folder, run=2)
    schema = documents.text_schema(["_id", "Tipo", "Sigla da Instituição"])
    return documents.read_latest_documents(spark, folder, schema, "_id")


ORACLES["q_document_store"] = f"""
SELECT _id, CASE "Tipo" WHEN 'Dissertação' THEN 'Revisão' ELSE "Tipo" END AS "Tipo", "Sigla da Instituição"
FROM ({inputs.PAPERS_SQL})"""


def q_incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops of files, three runs: no row is missing and none is loaded twice."""
    folder = work_dir(spark, "incremental")
    papers = inputs.papers(spark, sf_dir).select("_id", "Título", "Tipo")
    schema = documents.text_schema(papers.columns)
    early = F.col("Tipo") == "Tese"
    for drop in (early, ~early):
        papers.where(drop).write.mode("append").json(f"{folder}/in")
        load_new_files(spark, f"{folder}/in", schema, f"{folder}/out", f"{folder}/checkpoint")
    load_new_files(spark, f"{folder}/in", schema, f"{folder}/out", f"{folder}/checkpoint")
    return spark.read.schema(schema).parquet(f"{folder}/out")


ORACLES["q_incremental_load"] = f'SELECT _id, "Título", "Tipo" FROM ({inputs.PAPERS_SQL})'



def q_ingest_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item pages to stored JSON documents and back through the fixed schema."""
    folder = work_dir(spark, "ingest-papers")
    ingest.store_papers(pages.rendered(spark, sf_dir), pages.rendered(spark, sf_dir, full=True), folder, run=1)
    loaded = documents.read_latest_documents(spark, folder, documents.PAPERS, "_id")
    return loaded.select("_id", "_source_url", "_pdf_url", "_parser_warning", "Título", "Autor(es)", "Palavras-chave", "URI")


ORACLES["q_ingest_papers"] = f"""
SELECT CAST(page_id AS VARCHAR) AS _id, '{inputs.HOST}/handle/prefix/' || page_id AS _source_url, pdf_url AS _pdf_url,
  warning AS _parser_warning, titulo AS "Título", autores AS "Autor(es)", CAST(NULL AS VARCHAR) AS "Palavras-chave",
  uri AS "URI" FROM ({pages.ORACLES['q_record_fallback']})"""


def q_ingest_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines to stored tables of contents and back, with the rejected documents beside them."""
    folder = work_dir(spark, "ingest-contents")
    rejected = ingest.store_contents(inputs.lines(spark, sf_dir), folder, run=1)
    loaded = documents.read_latest_documents(spark, folder, documents.CONTENTS, "paper_id")
    good = loaded.select("paper_id", "tableOfContent", F.lit(None).cast("string").alias("message"))
    return good.unionByName(
        rejected.select(F.col("key").alias("paper_id"), F.lit(None).cast("string").alias("tableOfContent"), "message")
    )


ORACLES["q_ingest_contents"] = f"""
SELECT CAST(s.doc_id AS VARCHAR) AS paper_id, CASE WHEN status = 200 THEN section END AS "tableOfContent", message
FROM ({lines.ORACLES['q_status_gates']}) s LEFT JOIN ({lines.ORACLES['q_toc_text']}) t ON s.doc_id = t.doc_id"""


def q_model_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The teacher model's own data tests."""
    teachers = models.silver_teachers(inputs.teachers(spark, sf_dir))
    return checks.run_checks({"silver_base_docentes": teachers})


ORACLES["q_model_checks"] = f"""
WITH t AS ({warehouse.ORACLES['q_silver_teacher']}),
v AS (SELECT 'not_null' AS "check", 'silver_base_docentes_disciplina' AS column_name,
    (SELECT count(*) FROM t WHERE silver_base_docentes_disciplina IS NULL) AS violations
  UNION ALL SELECT 'unique', 'silver_base_docentes_id',
    (SELECT count(*) FROM (SELECT 1 FROM t WHERE silver_base_docentes_id IS NOT NULL GROUP BY silver_base_docentes_id HAVING count(*) > 1)))
SELECT 'silver_base_docentes' AS model, "check", column_name, violations, violations = 0 AS passed FROM v"""

# Publishing years of each period; together they cover all papers.
_PERIOD_YEARS = [(None, 2016), (2017, 2018), (2019, 2020), (2021, 2022), (2023, 2024), (2025, None)]
_PERIOD = "CASE " + " ".join(
    f"WHEN year(o_orderdate) + 20 <= {last} THEN '{period}'" if last else f"ELSE '{period}' END"
    for period, (_, last) in zip(fixed.PERIODS, _PERIOD_YEARS)
)

_SECTION_PERIOD = _PERIOD.replace("o_orderdate", "l_shipdate")


def _without_rows(base: str, rows: DataFrame) -> frozenset[str]:
    """Relations of the periods that no row falls into."""
    found = {r["period"] for r in rows.select("period").distinct().collect()}
    return frozenset(documents.period_name(base, period) for period in fixed.PERIODS if period not in found)


def _build(spark: SparkSession, sf_dir: str, folder: str, tags: set[str] | None = None) -> dict[str, DataFrame]:
    """Papers by period and tables of contents as JSON, then the layers."""
    # Compressed files are not split, and each task writes one per period: twice as many tasks as run at once.
    tasks = 2 * spark.sparkContext.defaultParallelism
    dated = inputs.papers(spark, sf_dir, period=_PERIOD).coalesce(tasks)
    # Lines of JSON repeat all keys; lz4 takes little time and leaves about a tenth on the disks.
    dated.write.mode("overwrite").option("compression", "lz4").partitionBy("period").json(f"{folder}/papers")
    sections = inputs.contents(spark, sf_dir, period=_SECTION_PERIOD)
    sections.write.mode("overwrite").option("compression", "lz4").partitionBy("period").json(f"{folder}/contents")
    settings = layers.Settings(
        metadata_path=f"{folder}/papers",
        contents_path=f"{folder}/contents",
        teachers=inputs.teachers(spark, sf_dir),
        period_folder="period={}",
        as_of=warehouse.AS_OF,
        empty=_without_rows("papers_metadata", dated) | _without_rows("papers_tableofcontent", sections),
    )
    return layers.build(spark, settings, f"{folder}/warehouse", tags)


def q_layer_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All layers from JSON documents to the mart; rows per table."""
    built = _build(spark, sf_dir, work_dir(spark, "layers"))
    counts = None
    for name, df in built.items():
        one = df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        counts = one if counts is None else counts.unionByName(one)
    return counts


def _sql_layer_counts() -> str:
    rows = []
    for period in fixed.PERIODS:
        rows.append((f"papers_metadata_{period}", f"SELECT count(*) FROM orders WHERE {_PERIOD} = '{period}'"))
        rows.append(
            (
                f"papers_tableofcontent_{period}",
                f"SELECT count(*) FROM lineitem WHERE {_SECTION_PERIOD} = '{period}'",
            )
        )
    fanned = "SELECT count(*) FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey"
    publish_days = f"SELECT DATE '{warehouse.AS_OF}' - DATE '2015-01-01' + 1"
    all_days = f"SELECT DATE '{fixed.CALENDAR_END}' - DATE '{fixed.CALENDAR_START}' + 1"
    rows += [
        ("bronze_papers_metadata", "SELECT count(*) FROM orders"),
        ("bronze_papers_tableofcontent", "SELECT count(*) FROM lineitem"),
        ("base_docentes", "SELECT count(*) FROM customer"),
        ("bronze_base_docentes", "SELECT count(*) FROM customer"),
        ("silver_papers", fanned),
        ("silver_base_docentes", "SELECT count(*) FROM customer"),
        ("gold_master_dim_calendar", all_days),
        ("gold_master_dim_docente", "SELECT count(*) FROM customer"),
        (models.MART_ADVISORS, "SELECT count(DISTINCT c_custkey) FROM customer"),
        (models.MART_CALENDAR, publish_days),
        (models.MART_FACT, fanned),
    ]
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, CAST(({sql}) AS BIGINT) AS n_rows" for name, sql in rows
    )


ORACLES["q_layer_build"] = _sql_layer_counts()


def q_layer_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The papers that a build of the silver layer writes, through bronze views nobody selected."""
    return _build(spark, sf_dir, work_dir(spark, "layers"), {"silver"})["silver_papers"]


ORACLES["q_layer_silver"] = warehouse.ORACLES["q_silver_papers"]


def q_layer_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The advisors that a build of the tag ``dim`` writes, all layers below computed on the way."""
    return _build(spark, sf_dir, work_dir(spark, "layers"), {"dim"})[models.MART_ADVISORS]


ORACLES["q_layer_dims"] = f"""WITH {warehouse.SILVER_TEACHERS}
SELECT DISTINCT {warehouse.advisor_list()} FROM silver_t"""


def q_mart_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart exported table by table, read back by name and summarised."""
    mart = warehouse.mart(spark, sf_dir)
    chosen = {name: mart[name] for name in tables.mart_tables()}
    exported = tables.export_mart(chosen, work_dir(spark, "export"), one_file=(models.MART_CALENDAR,))
    back = {name: spark.read.parquet(path) for name, path in exported.items()}
    return models.star_summary(back[models.MART_FACT], back[models.MART_CALENDAR], back[models.MART_ADVISORS])


ORACLES["q_mart_export"] = warehouse.ORACLES["q_star_summary"]

QUERIES.update({name: fn for name, fn in globals().items() if name.startswith("q_")})
