from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.errors import AnalysisException

from acervo import fixed_values as fixed
from acervo.operators import contents
from acervo.plans import checks, ingest, layers, models
from acervo.session import shared_dir, stored
from acervo.sources import documents, tables
from acervo.streaming.ingest import load_new_files
from tables import rows


def _write(path, *objects):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(json.dumps(o, ensure_ascii=False) for o in objects), encoding="utf-8")


PAPERS = [
    {"_id": "1", "Data do documento": "3-Fev-2020", "Título": " Ação\tÑ ", "Primeiro Orientador": "Silva, Ana Maria da",
     "Autor(es)": ["A", "B"], "_pdf_url": "https://h/a.pdf"},
    {"_id": "2", "Data do documento": "Dez-2014", "Autor(es)": "A", "Primeiro Orientador": "Plínio"},
    {"_id": "3", "Data do documento": "1-Jan-2099", "metadata.dc.contributor.referee1": "Ré"},
]
CONTENTS = [
    {"paper_id": "1", "tableOfContent": "Sumário"},
    {"paper_id": "1", "tableOfContent": "Sumário 2"},
    {"paper_id": "2", "tableOfContent": ""},
    {"paper_id": "9", "tableOfContent": "x"},
]
TEACHERS = [
    ("10", "Ana  Maria da Silva", "Câmpus A", "Física II"),
    ("11", "Ana Maria da Silva", "Câmpus B", "Artes e Música"),
    ("12", "Plínio", "Câmpus A", None),
    ("12", "Plínio", "Câmpus A", None),
]


def _settings(spark, tmp_path):
    _write(tmp_path / "papers" / "2019_2020" / "a.json", *PAPERS[:1])
    _write(tmp_path / "papers" / "2015_2016" / "b.json", *PAPERS[1:])
    _write(tmp_path / "toc" / "2019_2020" / "a.json", *CONTENTS)
    teachers = spark.createDataFrame(TEACHERS, "siape string, nome string, campus string, nome_da_disciplina string")
    there = ("papers_metadata_2015_2016", "papers_metadata_2019_2020", "papers_tableofcontent_2019_2020")
    kinds = ("papers_metadata", "papers_tableofcontent")
    empty = {documents.period_name(kind, period) for kind in kinds for period in fixed.PERIODS} - {*there}
    return layers.Settings(str(tmp_path / "papers"), str(tmp_path / "toc"), teachers, as_of="2020-12-31", empty=frozenset(empty))


def test_fixed_schema_load(spark, tmp_path):
    _write(tmp_path / "in" / "1.json", *PAPERS)
    loaded = documents.overwrite_table(documents.read_json(spark, str(tmp_path / "in"), documents.PAPERS), str(tmp_path / "t"))
    assert loaded.columns == fixed.PAPER_KEYS and len(fixed.PAPER_KEYS) == 33
    assert rows(loaded, "_id", "`Autor(es)`", "`metadata.dc.contributor.referee1`") == [
        ("1", '["A", "B"]', None), ("2", "A", None), ("3", None, "Ré"),
    ]
    again = documents.overwrite_table(documents.read_json(spark, str(tmp_path / "in"), documents.PAPERS), str(tmp_path / "t"))
    assert again.count() == 3
    mapped = documents.metadata_table(spark, str(tmp_path / "in"))
    assert mapped.columns == list(fixed.METADATA_MAPPING)
    assert rows(mapped.where("id = '1'"), "titulo", "pdf_url") == [(" Ação\tÑ ", "https://h/a.pdf")]


def test_mistyped_folder_leaves_the_old_mart(spark, tmp_path):
    settings, warehouse = _settings(spark, tmp_path), str(tmp_path / "warehouse")
    layers.build(spark, settings, warehouse)
    settings.metadata_path += "_typo"
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        layers.build(spark, settings, warehouse)
    assert tables.read_table(spark, warehouse, "gold", models.MART_FACT).count() == 6


def test_documents_written_again_replace(spark, tmp_path):
    path = str(tmp_path / "docs")
    one = spark.createDataFrame([('{"paper_id":"1","tableOfContent":"old"}',), ('{"paper_id":"2","tableOfContent":"x"}',)], "document string")
    two = spark.createDataFrame([('{"paper_id":"1","tableOfContent":"new"}',)], "document string")
    for run, df in ((1, one), (2, two), (2, two)):
        documents.append_documents(df, path, run)
    latest = documents.read_latest_documents(spark, path, documents.CONTENTS, "paper_id")
    assert rows(latest) == [("1", "new"), ("2", "x")]


def test_incremental_load_is_exactly_once(spark, tmp_path):
    args = (documents.CONTENTS, str(tmp_path / "out"), str(tmp_path / "check"))
    _write(tmp_path / "in" / "a.json", *CONTENTS[:2])
    load_new_files(spark, str(tmp_path / "in"), *args)
    _write(tmp_path / "in" / "b.json", *CONTENTS[2:])
    load_new_files(spark, str(tmp_path / "in"), *args)
    load_new_files(spark, str(tmp_path / "in"), *args)
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(CONTENTS)


def test_all_layers(spark, tmp_path):
    built = layers.build(spark, _settings(spark, tmp_path), str(tmp_path / "warehouse"))
    assert built["bronze_papers_metadata"].count() == 3
    assert rows(built["bronze_papers_metadata"], "__table_source", "_id") == [
        ("papers_metadata_2015_2016", "2"), ("papers_metadata_2015_2016", "3"), ("papers_metadata_2019_2020", "1"),
    ]
    silver = built["silver_papers"]
    assert len(silver.columns) == 34
    assert rows(silver, "silver_papers_id", "silver_papers_data_publicacao", "silver_papers_has_table_of_content", "silver_papers_titulo") == [
        ("1", dt.date(2020, 2, 3), 1, "ACAO\tÑ"),
        ("1", dt.date(2020, 2, 3), 1, "ACAO\tÑ"),
        ("2", dt.date(2014, 12, 1), 1, None),
        ("3", dt.date(2099, 1, 1), 0, None),
    ]
    advisors = built[models.MART_ADVISORS]
    assert advisors.count() == 3
    fact = built[models.MART_FACT]
    assert len(fact.columns) == 14
    f, a, c = models.MART_FACT, models.MART_ADVISORS, models.MART_CALENDAR
    # Two contents and two homonymous advisors make four rows of paper 1.
    assert rows(fact, f"{f}_id", f"{a}_id", f"{c}_id", f"{f}_qtd_publicacoes_com_orientador_identificado", f"{f}_qtd_publicacoes_com_sumario") == [
        ("1", "10", 20200203, 1, 1),
        ("1", "10", 20200203, 1, 1),
        ("1", "11", 20200203, 1, 1),
        ("1", "11", 20200203, 1, 1),
        ("2", "12", 20141201, 1, 1),
        ("3", None, 20990101, 0, 0),
    ]
    summary = models.star_summary(fact, built[c], advisors)
    assert rows(summary, "year_month", "campus", "qtd_publicacoes") == rows(
        spark.createDataFrame(
            [("2020-02", "CAMPUS A", 2), ("2020-02", "CAMPUS B", 2), (None, "CAMPUS A", 1), (None, None, 1)],
            "a string, b string, c bigint",
        )
    )
    paths = tables.export_mart({name: built[name] for name in tables.mart_tables()}, str(tmp_path / "export"))
    for name, path in paths.items():
        back = spark.read.parquet(path)
        assert back.schema.simpleString() == built[name].schema.simpleString()
        assert back.count() == built[name].count()
    assert tables.read_table(spark, str(tmp_path / "warehouse"), "gold", models.MART_FACT).count() == 6


def test_selected_tags(spark, tmp_path):
    settings, warehouse = _settings(spark, tmp_path), str(tmp_path / "warehouse")
    silver = layers.build(spark, settings, warehouse, {"silver"})
    assert set(silver) == {"silver_papers", "silver_base_docentes"}
    dims = layers.build(spark, settings, warehouse, {"dim"})
    assert set(dims) == {models.MART_ADVISORS, models.MART_CALENDAR}
    assert not (tmp_path / "warehouse" / "gold" / models.MART_FACT).exists()
    assert set(layers.build(spark, settings, warehouse, {"master_dim"})) == {"gold_master_dim_calendar", "gold_master_dim_docente"}


def test_silver_options(spark, tmp_path):
    papers = documents.read_json(spark, str(_settings(spark, tmp_path).metadata_path) + "/*", documents.PAPERS)
    contents = spark.createDataFrame([tuple(c.values()) for c in CONTENTS], "paper_id string, tableOfContent string")
    assert models.silver_papers(papers, contents).count() == 4
    assert models.silver_papers(papers, contents, dedupe=True).count() == 3
    raw = models.silver_papers(papers, contents, raw_urls=True).where("silver_papers_id = '1'").first()
    assert (raw["silver_papers_pdf_url"], raw["silver_papers_pdf_url_raw"]) == ("HTTPS://H/A.PDF", "https://h/a.pdf")


def test_teacher_table_name_prefixes_columns(spark, tmp_path):
    silver = models.silver_teachers(_settings(spark, tmp_path).teachers, "other")
    assert silver.columns[0] == "silver_other_id"
    got = models.master_teachers(silver, "other")
    assert rows(got, "gold_master_dim_docentes_disciplina_primary", "gold_master_dim_docentes_disciplina_secondary") == rows(
        spark.createDataFrame([("FISICA", ""), ("ARTES", "MUSICA"), (None, None), (None, None)], "a string, b string")
    )


def test_names():
    assert documents.period_name("papers_metadata") == "papers_metadata_2019_2020"
    assert tables.layer_schema(" gold ", "x") == "gold" and tables.layer_schema(None, "x") == "x"
    assert tables.mart_tables()[0] == "gold_datamart_publishing_analysis_dim_orientador"


def test_layer_schemas(spark):
    tables.create_layers(spark)
    tables.create_layers(spark)
    assert {r["namespace"] for r in spark.sql("SHOW SCHEMAS").collect()} >= {"stage", "bronze", "silver", "gold"}


def test_shared_folder(spark):
    assert shared_dir(spark) == shared_dir(spark)
    df = stored(spark.range(3), "numbers")
    assert df.count() == 3 and df.inputFiles()[0].split(":", 1)[1].lstrip("/").startswith(shared_dir(spark).split(":", 1)[-1].lstrip("/"))


@pytest.mark.parametrize("kind", ["papers", "contents"])
def test_schemas_are_text(kind):
    schema = documents.PAPERS if kind == "papers" else documents.CONTENTS
    assert {f.dataType.simpleString() for f in schema.fields} == {"string"}


def test_model_checks(spark, tmp_path):
    built = layers.build(spark, _settings(spark, tmp_path), str(tmp_path / "warehouse"), {"silver"})
    assert rows(checks.run_checks(built), "check", "violations", "passed") == [("not_null", 2, False), ("unique", 1, False)]
    assert checks.run_checks({}) is None


def test_pages_to_documents_to_stage(spark, tmp_path):
    table = "<table><tr><td>Título</td><td>{t}</td></tr><tr><td>Autor(es)</td><td>A</td></tr><tr><td>Autor(es)</td><td>B</td></tr></table>"
    schema = "page_id bigint, url string, html string"
    first = spark.createDataFrame([(1, "https://h/handle/p/1", table.format(t="um")), (2, "https://h/", "")], schema)
    again = spark.createDataFrame([(1, "https://h/handle/p/1", table.format(t="dois"))], schema)
    none = spark.createDataFrame([], schema)
    target = str(tmp_path / "docs")
    assert rows(ingest.store_papers(first, none, target, 1), "url", "status") == [("https://h/", 500)]
    assert ingest.store_papers(again, none, target, 2).count() == 0
    papers = documents.read_latest_documents(spark, target, documents.PAPERS, "_id")
    assert rows(papers, "_id", "`Título`", "`Autor(es)`") == [("1", "dois", '["A","B"]')]


def test_lines_to_documents(spark, tmp_path):
    entries = "\n".join(f"{i}. Capitulo numero {i} ..... {i}" for i in range(1, 30))
    pages = spark.createDataFrame([("7", 1, "Sumário\n" + entries), ("8", 1, "nada")], "doc_id string, page_no int, text string")
    rejected = ingest.store_contents(contents.page_lines(pages), str(tmp_path / "toc"), 1)
    assert rows(rejected) == [("8", 422, "error 1: No enough text")]
    stored_text = documents.contents_table(spark, str(tmp_path / "toc")).collect()
    assert [(r["paper_id"], r["table_of_content"][:28]) for r in stored_text] == [("7", "Sumário\n1. Capitulo numero 1")]


def test_labels_outside_the_list_and_lines_that_are_no_documents(spark, tmp_path):
    lines = [
        '{"_id": "1", "Novo selo": "x", "a.b": {"c": [1]}}', '{"_id": "2", "autor(ES)": "y", "Autor(es)": ["z"]}', "",
        '  {"_id": "3"} ', '{"_id": "4"', "[1]", "null", "no json", '{"_id": "5", "Novo selo": null}',
    ]
    (tmp_path / "a.json").write_text("\n".join(lines), encoding="utf-8")
    good, bad = documents.read_merged(spark, str(tmp_path), documents.PAPERS)
    assert good.columns == [*fixed.PAPER_KEYS, "Novo selo", "a.b", "autor(ES) (2)"]
    assert rows(good, "_id", "`Novo selo`", "`a.b`", "`Autor(es)`", "`autor(ES) (2)`") == [
        ("1", "x", '{"c":[1]}', None, None), ("2", None, None, '["z"]', "y"), ("3", None, None, None, None), ("5", None, None, None, None),
    ]
    assert rows(bad) == [("[1]",), ("no json",), ("null",), ('{"_id": "4"',)]
    (tmp_path / "none").mkdir()
    good, bad = documents.read_merged(spark, str(tmp_path / "none"), documents.CONTENTS)
    assert good.columns == fixed.CONTENTS_KEYS and good.count() == bad.count() == 0
