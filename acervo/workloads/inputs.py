"""Inputs of the operators, shaped from the benchmark tables.

An input is a dict of column -> expression that Spark SQL and the oracle both understand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo import fixed_values as fixed
from acervo.session import prepare, spread

HOST = "https://repository.example.org"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def spark_select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(e).alias(name) for name, e in columns.items()])


def sql_select(columns: dict[str, str], source: str) -> str:
    listed = ", ".join(f'{e} AS "{name}"' for name, e in columns.items())
    return f"SELECT {listed} FROM {source}"


_DAY = "day(cast(o_orderdate as date))"
_YEAR = "(year(cast(o_orderdate as date)) + 20)"
_MONTH = (
    "CASE month(cast(o_orderdate as date)) "
    + " ".join(f"WHEN {i} THEN '{pt}'" for i, (pt, _) in enumerate(fixed.MONTHS_PT, 1))
    + " END"
)
PT_DATE = f"""CASE o_orderkey % 11
  WHEN 0 THEN concat({_MONTH}, '-', {_YEAR})
  WHEN 1 THEN concat({_MONTH}, '-', {_YEAR})
  WHEN 2 THEN concat('31-Fev-', {_YEAR})
  WHEN 3 THEN concat({_DAY}, '-May-', {_YEAR})
  WHEN 4 THEN upper(concat({_DAY}, '-', {_MONTH}, '-', {_YEAR}))
  WHEN 5 THEN cast({_YEAR} as string)
  WHEN 6 THEN NULL
  ELSE concat({_DAY}, '-', {_MONTH}, '-', {_YEAR}) END"""
PUBLISH_DATE = "cast(add_months(cast(o_orderdate as date), 240) as date)"

# Papers: one per order, all document keys.
PAPERS = {
    "_id": "cast(o_orderkey as string)",
    "_source_url": f"concat('{HOST}/handle/prefix/', o_orderkey)",
    "_pdf_url": f"CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE concat('{HOST}/bitstream/prefix/', o_orderkey, '/1/Texto.pdf') END",
    "_parser_warning": "cast(NULL as string)",
    "Abstract": "concat('Abstract about ', o_orderpriority, ' and ', o_orderstatus)",
    "CNPq": "CASE WHEN o_custkey % 2 = 0 THEN 'CNPQ::CIÊNCIAS EXATAS' ELSE 'CNPq::Ciências Humanas' END",
    "Editor": "'Instituto de Educação'",
    "Idioma": "CASE WHEN o_custkey % 7 = 0 THEN 'eng' ELSE 'por' END",
    "Resumo": "concat('Resumo: ação ', o_custkey, ', ligação e coração')",
    "Tipo": "CASE o_orderstatus WHEN 'F' THEN 'Dissertação' WHEN 'O' THEN 'Trabalho de Conclusão de Curso' ELSE 'Tese' END",
    "URI": f"concat('{HOST}/handle/prefix/', o_orderkey)",
    "Data do documento": PT_DATE,
    "Aparece nas coleções": "concat('Coleção ', o_custkey % 13)",
    "Título(s) alternativo(s)": "CASE WHEN o_orderkey % 3 = 1 THEN concat('Alternate ', o_orderkey) END",
    "Título": "concat('  Análise do Ñandu ', o_orderkey, ' - ', o_orderpriority, '  ')",
    "Autor(es)": """CASE WHEN o_orderkey % 5 = 0 THEN concat('["Gonçalves, ', o_custkey, '","Araújo, B."]') ELSE concat('Gonçalves, ', o_custkey) END""",
    "Citação": "concat('GONÇALVES. ', o_orderpriority)",
    "País": "'Brasil'",
    "Palavras-chave": "o_orderpriority",
    "Primeiro Orientador": "CASE WHEN o_orderkey % 3 > 0 THEN concat('Customer#', lpad(cast(o_custkey as string), 9, '0'), ', Ana Maria') WHEN o_orderkey % 2 = 0 THEN 'Sem Orientador' END",
    "Segundo Orientador": "CASE WHEN o_orderkey % 9 = 0 THEN 'Conceição, Zé' END",
    "Sigla da Instituição": "concat('ie', lower(o_orderstatus))",
    "Tipo de Acesso": "'Acesso Aberto'",
    "Identificador DOI": "CASE WHEN o_orderkey % 2 = 0 THEN concat('10.1/', o_orderkey) END",
    "metadata.dc.contributor.advisor-co1": "CASE WHEN o_custkey % 5 = 0 THEN 'Müller, Ü.' END",
    "metadata.dc.contributor.advisor-co2": "CASE WHEN o_custkey % 6 = 0 THEN 'Sá, Í.' END",
    "metadata.dc.contributor.referee1": "concat('Referê ', o_custkey % 17)",
    "metadata.dc.contributor.referee2": "concat('Referê ', o_custkey % 19)",
    "metadata.dc.contributor.referee3": "CASE WHEN o_custkey % 3 = 0 THEN 'Referê C' END",
    "metadata.dc.contributor.referee4": "CASE WHEN o_custkey % 4 = 0 THEN 'Referê D' END",
    "metadata.dc.contributor.referee5": "cast(NULL as string)",
    "metadata.dc.publisher.department": "concat('Câmpus ', o_custkey % 25)",
    "metadata.dc.publisher.program": "concat('Programa ', o_orderstatus)",
}

# Tables of contents: one per line item, so papers fan out.
CONTENTS = {
    "paper_id": "cast(l_orderkey as string)",
    "tableOfContent": "CASE WHEN l_linenumber = 7 THEN '' ELSE concat('Sumário ', l_linenumber, '. Introdução ', cast(l_quantity as int)) END",
}

_DISCIPLINE = """CASE {key} % 8
  WHEN 0 THEN 'Física I' WHEN 1 THEN 'Física II' WHEN 2 THEN ' Física III' WHEN 3 THEN 'Física IV '
  WHEN 4 THEN 'Física V' WHEN 5 THEN 'Artes e Música' WHEN 6 THEN 'Letras: Inglês, Espanhol' END"""

# Teachers: one per customer, with the nation as campus.
TEACHERS = {
    "siape": "cast(c_custkey as string)",
    "nome": "concat('Ana  Maria ', c_name)",
    "campus": "concat('Câmpus ', n_name)",
    "nome_da_disciplina": _DISCIPLINE.format(key="c_custkey"),
}
# The same teachers as seen from their papers: one per order, so most rows are copies.
TEACHER_MENTIONS = {
    "siape": "cast(o_custkey as string)",
    "nome": "concat('Ana  Maria Customer#', lpad(cast(o_custkey as string), 9, '0'))",
    "campus": "concat('Câmpus ', o_custkey % 25)",
    "nome_da_disciplina": _DISCIPLINE.format(key="o_custkey"),
}

# Lines of documents: 64 orders make a document, one order a page, one line item a line.
LINES = {
    "doc_id": "cast(floor(l_orderkey / 64) as bigint)",
    "page_no": "cast(l_orderkey % 64 as int) + 1",
    "line_no": "cast(l_linenumber as bigint) * 100000000000000000 + l_partkey * 1000 + cast(l_quantity as bigint)",
    "text": """CASE
      WHEN l_linenumber = 1 AND l_orderkey % 5 = 0 THEN '  Sumário '
      WHEN l_linenumber = 2 AND l_orderkey % 7 = 0 THEN concat('O sumário de ', p_name)
      WHEN l_quantity <= 2 THEN cast(cast(l_quantity as int) as string)
      WHEN l_quantity <= 4 THEN 'xii'
      WHEN l_quantity = 5 THEN 'civil'
      WHEN l_quantity <= 8 THEN '....'
      WHEN l_orderkey % 9 = 4 THEN concat('texto corrido sobre  ', p_name, ' e outros temas')
      WHEN l_quantity <= 30 THEN concat(l_linenumber, '. ', p_name, ' ..... ', cast(l_quantity as int))
      WHEN l_quantity <= 40 THEN concat('Introdução ao ', p_name)
      ELSE concat(p_name, ' ____ ', l_returnflag) END""",
}
LINES_FROM = "lineitem JOIN part ON l_partkey = p_partkey"


def papers(spark: SparkSession, sf_dir: str, **more: str) -> DataFrame:
    """Papers, with the columns of ``more``. An order of a few bytes becomes 31 texts that are cleaned, written or joined."""
    return spark_select(spread(load(spark, sf_dir, "orders")), {**PAPERS, **more})


def contents(spark: SparkSession, sf_dir: str, **more: str) -> DataFrame:
    items = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    return spark_select(items, {**CONTENTS, **more})


def teachers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, nations = load(spark, sf_dir, "customer"), load(spark, sf_dir, "nation")
    return spark_select(customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")), TEACHERS)


def teacher_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_select(load(spark, sf_dir, "orders"), TEACHER_MENTIONS)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag"]
    items = load(spark, sf_dir, "lineitem").select(*wanted)
    parts = load(spark, sf_dir, "part").select("p_partkey", "p_name")
    return spark_select(items.join(parts, F.col("l_partkey") == F.col("p_partkey")), LINES)


PAPERS_SQL = sql_select(PAPERS, "orders")
CONTENTS_SQL = sql_select(CONTENTS, "lineitem")
TEACHERS_SQL = sql_select(TEACHERS, "customer JOIN nation ON c_nationkey = n_nationkey")
MENTIONS_SQL = sql_select(TEACHER_MENTIONS, "orders")
LINES_SQL = sql_select(LINES, LINES_FROM)
