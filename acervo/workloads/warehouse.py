"""Text rules and the silver and gold models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo import fixed_values as fixed
from acervo.functions import dates, text
from acervo.operators.joins import left_join
from acervo.plans import models
from acervo.session import spread
from acervo.workloads import inputs

AS_OF = "2021-06-30"
QUERIES, ORACLES = {}, {}


def sql_clean(c: str) -> str:
    return f"translate(trim(upper(replace({c}, 'ß', 'SS'))), '{fixed.ACCENTED_LETTERS}', '{fixed.PLAIN_LETTERS}')"


def sql_suffix(c: str) -> str:
    cases = " ".join(
        f"WHEN {c} LIKE '%{s}' THEN left({c}, length({c}) - {len(s)})" for s in (" I", " II", " III", " IV")
    )
    return f"CASE {cases} ELSE {c} END"


def sql_part(c: str, n: int) -> str:
    return f"trim(split_part(replace(replace(replace({c}, ' E ', '/'), ':', '/'), ',', '/'), '/', {n}))"


def sql_citation(c: str) -> str:
    return rf"regexp_replace(regexp_replace(trim({c}), '\s+', ' ', 'g'), '^(.*) (\S+)$', '\2, \1')"


def sql_pt_date(c: str) -> str:
    months = "[" + ", ".join(f"'{pt}'" for pt, _ in fixed.MONTHS_PT) + "]"
    full, short = r"^([0-9]{1,2})-([A-Za-z]{3})-([0-9]{4})$", r"^([A-Za-z]{3})-([0-9]{4})$"

    def iso(year: str, month: str, day: str) -> str:
        number = f"list_position({months}, {month})"
        return f"CAST(try_strptime({year} || '-' || lpad(CAST({number} AS VARCHAR), 2, '0') || '-' || lpad({day}, 2, '0'), '%Y-%m-%d') AS DATE)"

    part = lambda pattern, i: f"regexp_extract({c}, '{pattern}', {i})"
    return f"""CASE WHEN regexp_matches({c}, '{full}') THEN {iso(part(full, 3), part(full, 2), part(full, 1))}
      WHEN regexp_matches({c}, '{short}') THEN {iso(part(short, 2), part(short, 1), "'1'")} END"""


# --- text rules -------------------------------------------------------------------


def q_text_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.load(spark, sf_dir, "documents")
    return docs.select("doc_id", text.clean_text(F.col("text")).alias("cleaned"))


ORACLES["q_text_clean"] = f"SELECT doc_id, {sql_clean('text')} AS cleaned FROM documents"


def q_parse_pt_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.load(spark, sf_dir, "orders")
    written = inputs.spark_select(orders, {"o_orderkey": "o_orderkey", "written": inputs.PT_DATE})
    return dates.with_pt_date(written, "written", "published").withColumn(
        "publish_key", dates.date_key(F.col("published"))
    )


ORACLES["q_parse_pt_date"] = f"""
WITH w AS (SELECT o_orderkey, {inputs.PT_DATE} AS written FROM orders),
d AS (SELECT *, {sql_pt_date('written')} AS published FROM w)
SELECT *, CAST(strftime(published, '%Y%m%d') AS INTEGER) AS publish_key FROM d"""

_SUFFIXED = "concat(upper(p_name), CASE p_size % 6 WHEN 0 THEN ' I' WHEN 1 THEN ' II' WHEN 2 THEN ' III' WHEN 3 THEN ' IV' WHEN 4 THEN ' V' ELSE '' END)"


def q_strip_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = inputs.load(spark, sf_dir, "part")
    named = inputs.spark_select(part, {"p_partkey": "p_partkey", "name": _SUFFIXED})
    return named.select(
        "p_partkey",
        text.strip_roman_suffix(F.col("name")).alias("stripped"),
        text.drop_right(F.col("name"), 2).alias("shorter"),
    )


ORACLES["q_strip_suffix"] = f"""
WITH n AS (SELECT p_partkey, {_SUFFIXED} AS name FROM part)
SELECT p_partkey, {sql_suffix('name')} AS stripped, left(name, length(name) - 2) AS shorter FROM n"""

_JOINED = "concat(upper(p_name), CASE p_partkey % 4 WHEN 0 THEN ' E ' WHEN 1 THEN ': ' WHEN 2 THEN ', ' ELSE ' ' END, p_type, CASE WHEN p_size % 2 = 0 THEN ' E TERCEIRA' ELSE '' END)"


def q_split_primary(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = inputs.load(spark, sf_dir, "part")
    named = inputs.spark_select(part, {"p_partkey": "p_partkey", "d": _JOINED})
    return named.select(
        "p_partkey",
        text.split_discipline(F.col("d"), 1).alias("primary_part"),
        text.split_discipline(F.col("d"), 2).alias("secondary_part"),
    )


ORACLES["q_split_primary"] = f"""
WITH n AS (SELECT p_partkey, {_JOINED} AS d FROM part)
SELECT p_partkey, {sql_part('d', 1)} AS primary_part, {sql_part('d', 2)} AS secondary_part FROM n"""


_PERSON = "CASE WHEN p_partkey % 5 = 0 THEN p_type ELSE concat(' ', p_type, '   da  ', p_name, ' ') END"


def q_citation_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = inputs.load(spark, sf_dir, "part")
    named = inputs.spark_select(part, {"p_partkey": "p_partkey", "person": _PERSON})
    return named.select("p_partkey", text.citation_name(F.col("person")).alias("citation"))


ORACLES["q_citation_name"] = f"""
WITH n AS (SELECT p_partkey, {_PERSON} AS person FROM part)
SELECT p_partkey, {sql_citation('person')} AS citation FROM n"""

_CENTS = "cast(round(l_extendedprice * 100) as bigint)"


def q_cents(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = inputs.load(spark, sf_dir, "lineitem")
    cents = inputs.spark_select(
        items, {"l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber", "cents": _CENTS}
    )
    return cents.withColumn("units", text.cents_to_units(F.col("cents")))


ORACLES["q_cents"] = f"""
SELECT l_orderkey, l_linenumber, {_CENTS} AS cents, round({_CENTS} / 100, 2) AS units FROM lineitem"""

# --- models -----------------------------------------------------------------------

_SILVER_TEACHERS = f"""
t AS ({inputs.TEACHERS_SQL}),
t1 AS (SELECT siape AS id, siape, {sql_clean('nome')} AS nome, {sql_clean('campus')} AS campus,
  {sql_clean('nome_da_disciplina')} AS d FROM t),
t2 AS (SELECT id, siape, nome, campus, {sql_suffix('d')} AS disciplina FROM t1),
silver_t AS (SELECT *, {sql_part('disciplina', 1)} AS disciplina_primary,
  {sql_part('disciplina', 2)} AS disciplina_secondary FROM t2)"""
_TEACHER_LIST = lambda prefix: ", ".join(f"{c} AS {prefix}_{c}" for c in models.TEACHER_FIELDS)


SILVER_TEACHERS = _SILVER_TEACHERS


def advisor_list() -> str:
    """The advisors' columns out of the silver teachers."""
    return f"{_TEACHER_LIST(models.MART_ADVISORS)}, {sql_citation('nome')} AS {models.MART_ADVISORS}_nome_citacao"


def q_silver_teacher(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.silver_teachers(inputs.teachers(spark, sf_dir))


ORACLES["q_silver_teacher"] = f"WITH {_SILVER_TEACHERS} SELECT {_TEACHER_LIST('silver_base_docentes')} FROM silver_t"


def _master_teachers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.master_teachers(q_silver_teacher(spark, sf_dir))


def q_dim_teacher(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _master_teachers(spark, sf_dir)


ORACLES["q_dim_teacher"] = f"""WITH {_SILVER_TEACHERS}
SELECT {_TEACHER_LIST(models.TEACHERS)}, {sql_citation('nome')} AS {models.TEACHERS}_nome_citacao FROM silver_t"""


def q_dim_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = models.silver_teachers(inputs.teacher_mentions(spark, sf_dir))
    return models.mart_advisors(models.master_teachers(silver))


ORACLES["q_dim_distinct"] = f"""WITH {_SILVER_TEACHERS.replace(inputs.TEACHERS_SQL, inputs.MENTIONS_SQL)}
SELECT DISTINCT {_TEACHER_LIST(models.MART_ADVISORS)}, {sql_citation('nome')} AS {models.MART_ADVISORS}_nome_citacao FROM silver_t"""


def q_rename_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    renamed = models.rename_odd_labels(inputs.papers(spark, sf_dir))
    return renamed.select("_id", *fixed.LABEL_COLUMNS)


ORACLES["q_rename_project"] = (
    f"WITH p AS ({inputs.PAPERS_SQL}) SELECT _id, "
    + ", ".join(f'"{label}" AS {column}' for column, label in fixed.LABEL_COLUMNS.items())
    + " FROM p"
)


def q_left_join_toc(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = inputs.papers(spark, sf_dir).select("_id")
    return left_join(ids, inputs.contents(spark, sf_dir), "_id", "paper_id")


ORACLES["q_left_join_toc"] = f"""WITH p AS ({inputs.PAPERS_SQL}), c AS ({inputs.CONTENTS_SQL})
SELECT p._id, c.paper_id, c."tableOfContent" FROM p LEFT JOIN c ON p._id = c.paper_id"""


def q_left_join_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the suppliers of their nation: few keys, all of them hot, and NULL keys."""
    customers = inputs.load(spark, sf_dir, "customer").selectExpr("c_custkey", "nullif(c_nationkey, 3) AS nation")
    suppliers = inputs.load(spark, sf_dir, "supplier").selectExpr("s_suppkey", "s_nationkey")
    # A customer brings a row for each supplier of the nation, and the customers' file may be one split.
    return left_join(spread(customers), suppliers, "nation", "s_nationkey", spread="c_custkey", hot_rows=2, pack=True)


ORACLES["q_left_join_hot"] = """
SELECT c_custkey, nullif(c_nationkey, 3) AS nation, s_suppkey, s_nationkey
FROM customer LEFT JOIN supplier ON s_nationkey = nullif(c_nationkey, 3)"""


def _silver_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.silver_papers(inputs.papers(spark, sf_dir), inputs.contents(spark, sf_dir))


def q_silver_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver_papers(spark, sf_dir)


def _silver_sql() -> str:
    texts = []
    for column, source in fixed.SILVER_PAPER_TEXTS.items():
        label = fixed.LABEL_COLUMNS.get(source, source)
        quoted = '"' + label + '"'
        texts.append(f"{sql_clean(quoted)} AS silver_papers_{column}")
    return f"""p AS ({inputs.PAPERS_SQL}), c AS ({inputs.CONTENTS_SQL}),
silver_p AS (SELECT _id AS silver_papers_id, {sql_pt_date('"Data do documento"')} AS silver_papers_data_publicacao,
  CASE WHEN c."tableOfContent" IS NULL THEN 0 ELSE 1 END AS silver_papers_has_table_of_content,
  {", ".join(texts)} FROM p LEFT JOIN c ON p._id = c.paper_id)"""


ORACLES["q_silver_papers"] = f"WITH {_silver_sql()} SELECT * FROM silver_p"


def q_silver_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per paper, with its addresses as they were."""
    papers, contents = inputs.papers(spark, sf_dir), inputs.contents(spark, sf_dir)
    return models.silver_papers(papers.unionByName(papers), contents, dedupe=True, raw_urls=True)


_LAST_CONTENTS = f'SELECT paper_id, max("tableOfContent") AS "tableOfContent" FROM ({inputs.CONTENTS_SQL}) GROUP BY 1'
ORACLES["q_silver_options"] = f"""WITH {_silver_sql().replace(f'c AS ({inputs.CONTENTS_SQL})', f'c AS ({_LAST_CONTENTS})')}
SELECT s.*, p._pdf_url AS silver_papers_pdf_url_raw, p._source_url AS silver_papers_source_url_raw
FROM silver_p s JOIN p ON p._id = s.silver_papers_id"""


def _orders_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers per publishing day: at most one row per calendar day."""
    orders = inputs.load(spark, sf_dir, "orders").select(F.expr(inputs.PUBLISH_DATE).alias("day"))
    return orders.groupBy("day").agg(F.count("*").alias("n_papers"))


def _with_papers(calendar: DataFrame, date_column: str, per_day: DataFrame) -> DataFrame:
    joined = calendar.join(per_day, F.col(date_column) == F.col("day"), "left")
    return joined.withColumn("n_papers", F.coalesce("n_papers", F.lit(0).cast("bigint"))).drop("day")


def q_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    calendar = models.master_calendar(spark)
    return _with_papers(calendar, f"{models.CALENDAR}_date", _orders_per_day(spark, sf_dir))


_SQL_PER_DAY = "per_day AS (SELECT CAST(CAST(o_orderdate AS DATE) + INTERVAL 20 YEAR AS DATE) AS day, count(*) AS n_papers FROM orders GROUP BY 1)"
_SQL_CALENDAR = f"""
days AS (SELECT CAST(unnest(generate_series(DATE '{fixed.CALENDAR_START}', DATE '{fixed.CALENDAR_END}', INTERVAL 1 DAY)) AS DATE) AS d),
calendar AS (SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, d AS date,
  CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
  strftime(d, '%B') AS month_name, strftime(d, '%b') AS month_short_name,
  CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(dayofmonth(d) AS INTEGER) AS day_of_month,
  CAST(dayofyear(d) AS INTEGER) AS day_of_year,
  strftime(d, '%a') AS day_short_name, strftime(d, '%A') AS day_name,
  CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
  CAST(date_trunc('month', d) AS TIMESTAMP) AS month_start_date, last_day(d) AS month_end_date,
  CAST(date_trunc('year', d) AS TIMESTAMP) AS year_start_date, make_date(year(d), 12, 31) AS year_end_date,
  strftime(d, '%Y-%m') AS year_month, year(d) || '-Q' || quarter(d) AS year_quarter FROM days)"""
_CALENDAR_FIELDS = [
    "date_id", "date", "year", "quarter", "month", "month_name", "month_short_name", "week_of_year",
    "day_of_month", "day_of_year", "day_short_name", "day_name", "is_weekend", "month_start_date",
    "month_end_date", "year_start_date", "year_end_date", "year_month", "year_quarter",
]
ORACLES["q_calendar"] = (
    f"WITH {_SQL_CALENDAR}, {_SQL_PER_DAY} SELECT "
    + ", ".join(f"c.{f} AS {models.CALENDAR}_{f}" for f in _CALENDAR_FIELDS)
    + ", coalesce(n_papers, 0) AS n_papers FROM calendar c LEFT JOIN per_day ON c.date = per_day.day"
)


def _publish_calendar(spark: SparkSession) -> DataFrame:
    return models.mart_publish_calendar(models.master_calendar(spark), AS_OF)


def q_publish_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_papers(_publish_calendar(spark), f"{models.MART_CALENDAR}_date", _orders_per_day(spark, sf_dir))


_SQL_PUBLISH = f"publish AS (SELECT * FROM calendar WHERE year >= 2015 AND date <= DATE '{AS_OF}')"
ORACLES["q_publish_calendar"] = (
    f"WITH {_SQL_CALENDAR}, {_SQL_PER_DAY}, {_SQL_PUBLISH} SELECT "
    + f"c.date_id AS {models.MART_CALENDAR}_id, "
    + ", ".join(f"c.{f} AS {models.MART_CALENDAR}_{f}" for f in ("date", "year_month", "year", "month", "month_name"))
    + ", coalesce(n_papers, 0) AS n_papers FROM publish c LEFT JOIN per_day ON c.date = per_day.day"
)


def _advisors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.mart_advisors(_master_teachers(spark, sf_dir))


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.mart_fact(_silver_papers(spark, sf_dir), models.advisor_columns(_master_teachers(spark, sf_dir)))


def q_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact(spark, sf_dir)


_F, _A, _C = models.MART_FACT, models.MART_ADVISORS, models.MART_CALENDAR
_SQL_FACT = f"""{_silver_sql()}, {_SILVER_TEACHERS},
advisors AS (SELECT DISTINCT id, nome, campus, disciplina, {sql_citation('nome')} AS nome_citacao FROM silver_t),
fact AS (SELECT silver_papers_id AS {_F}_id, a.id AS {_A}_id,
  CAST(strftime(silver_papers_data_publicacao, '%Y%m%d') AS INTEGER) AS {_C}_id,
  silver_papers_tipo AS {_F}_type, silver_papers_has_table_of_content AS {_F}_has_table_of_content,
  silver_papers_titulo AS {_F}_title, silver_papers_uri AS {_F}_uri, silver_papers_cnpq AS {_F}_cnpq,
  silver_papers_palavras_chave AS {_F}_papers_palavras_chave, silver_papers_titulo AS {_F}_papers_titulo,
  silver_papers_sigla_da_instituicao AS {_F}_paper_sigla_da_instituicao,
  1 AS {_F}_qtd_publicacoes,
  CASE WHEN a.id IS NULL THEN 0 ELSE 1 END AS {_F}_qtd_publicacoes_com_orientador_identificado,
  CASE WHEN silver_papers_has_table_of_content = 1 THEN 1 ELSE 0 END AS {_F}_qtd_publicacoes_com_sumario
  FROM silver_p LEFT JOIN (SELECT DISTINCT id, nome_citacao FROM advisors) a
  ON a.nome_citacao = silver_papers_primeiro_orientador)"""
ORACLES["q_fact"] = f"WITH {_SQL_FACT} SELECT * FROM fact"


def mart(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three tables of the mart."""
    return {
        models.MART_ADVISORS: _advisors(spark, sf_dir),
        models.MART_CALENDAR: _publish_calendar(spark),
        models.MART_FACT: _fact(spark, sf_dir),
    }


def star(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = mart(spark, sf_dir)
    return models.star_summary(
        tables[models.MART_FACT], tables[models.MART_CALENDAR], tables[models.MART_ADVISORS]
    )


def q_star_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star(spark, sf_dir)


ORACLES["q_star_summary"] = f"""WITH {_SQL_FACT}, {_SQL_CALENDAR}, {_SQL_PUBLISH}
SELECT p.year_month, a.campus, CAST(sum({_F}_qtd_publicacoes) AS BIGINT) AS qtd_publicacoes,
  CAST(sum({_F}_qtd_publicacoes_com_orientador_identificado) AS BIGINT) AS qtd_publicacoes_com_orientador_identificado,
  CAST(sum({_F}_qtd_publicacoes_com_sumario) AS BIGINT) AS qtd_publicacoes_com_sumario
FROM fact f LEFT JOIN publish p ON f.{_C}_id = p.date_id LEFT JOIN advisors a ON f.{_A}_id = a.id
GROUP BY 1, 2"""

QUERIES.update({name: fn for name, fn in globals().items() if name.startswith("q_")})
