from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from acervo.functions import dates, text
from acervo.plans import models
from tables import rows


def test_clean_text_keeps_tabs_and_enye(value):
    got = value(text.clean_text, ["  ação Ñandu ", "\tÉ", "plain", "", None, "straße", "ÀÃÂÄÉÈÊËÍÌÎÏÓÒÕÔÖÚÙÛÜç"])
    assert got == ["ACAO ÑANDU", "\tE", "PLAIN", "", None, "STRASSE", "AAAAEEEEIIIIOOOOOUUUUC"]


def test_clean_text_is_idempotent(value):
    once = value(text.clean_text, [" Educação  física ", "x\ty"])
    assert value(text.clean_text, once) == once


def test_roman_suffixes(value):
    texts = ["FISICA I", "FISICA II", "FISICA III", "FISICA IV", "FISICA V", "FISICA VI", "XI", None]
    assert value(text.strip_roman_suffix, texts) == [
        "FISICA", "FISICA", "FISICA", "FISICA", "FISICA V", "FISICA VI", "XI", None,
    ]


def test_drop_right(value):
    assert value(lambda c: text.drop_right(c, 2), ["abcd", "a", None]) == ["ab", "", None]


def test_split_discipline(value):
    texts = ["ARTES E MUSICA", "LETRAS: INGLES, ESPANHOL", "FISICA", None, "A E B E C"]
    assert value(lambda c: text.split_discipline(c, 1), texts) == ["ARTES", "LETRAS", "FISICA", None, "A"]
    assert value(lambda c: text.split_discipline(c, 2), texts) == ["MUSICA", "INGLES", "", None, "B"]


def test_citation_name(value):
    texts = ["ANA  MARIA DA SILVA", "PLINIO", " ANA DA SILVA JUNIOR ", None]
    assert value(text.citation_name, texts) == ["SILVA, ANA MARIA DA", "PLINIO", "JUNIOR, ANA DA SILVA", None]


def test_flags_and_numbers(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 1234), (0, 1), (NULL, NULL) AS t(flag, cents)")
    got = df.select(
        text.null_flag(F.col("flag")), text.equals_flag(F.col("flag"), 1), text.cents_to_units(F.col("cents"))
    ).collect()
    assert [tuple(r) for r in got] == [(1, 1, 12.34), (1, 0, 0.01), (0, 0, None)]


def test_cell_text_and_labels(value):
    assert value(text.clean_cell, [" a&amp;b \n c ", "&eacute;", None, "&lt;x&gt;"]) == ["a&b c", "é", "", "<x>"]
    assert value(text.label, [" Autor : ", "Título::", ":", None]) == ["Autor", "Título", "", ""]


def test_portuguese_dates(spark):
    written = [
        ("3-Fev-2020", dt.date(2020, 2, 3)),
        ("Dez-2019", dt.date(2019, 12, 1)),
        ("3-May-2020", None),
        ("3-FEV-2020", None),
        ("JAN-2020", None),
        ("2019", None),
        ("31-Fev-2020", None),
        (None, None),
        ('["3-Fev-2020","4-Fev-2020"]', None),
        ("29-Fev-2020", dt.date(2020, 2, 29)),
    ]
    df = spark.createDataFrame(written, "`Data do documento` string, expected date")
    got = dates.with_pt_date(df, "Data do documento", "published")
    assert got.columns == ["Data do documento", "expected", "published"]
    assert got.count() == len(written)
    assert got.where(~F.col("expected").eqNullSafe(F.col("published"))).count() == 0


def test_month_map_is_broadcast(spark):
    df = spark.createDataFrame([("3-Fev-2020",), ("Mar-2020",)], "d string")
    plan = dates.with_pt_date(df, "d", "x")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_calendar(spark):
    calendar = models.master_calendar(spark)
    c = lambda name: f"gold_master_dim_calendar_{name}"
    assert len(calendar.columns) == 19
    assert calendar.count() == 13149
    assert calendar.select(c("date_id")).distinct().count() == 13149
    day = calendar.where(F.col(c("date_id")) == 20210101).first().asDict()
    expected = {
        "date": dt.date(2021, 1, 1), "year": 2021, "quarter": 1, "month": 1, "month_name": "January",
        "month_short_name": "Jan", "week_of_year": 53, "day_of_month": 1, "day_of_year": 1,
        "day_short_name": "Fri", "day_name": "Friday", "is_weekend": 0,
        "month_start_date": dt.datetime(2021, 1, 1), "month_end_date": dt.date(2021, 1, 31),
        "year_start_date": dt.datetime(2021, 1, 1), "year_end_date": dt.date(2021, 12, 31),
        "year_month": "2021-01", "year_quarter": "2021-Q1",
    }
    assert {k: day[c(k)] for k in expected} == expected
    weekend = calendar.where(F.col(c("date_id")).isin(20210102, 20210103)).select(c("is_weekend")).collect()
    assert [r[0] for r in weekend] == [1, 1]


def test_publish_calendar(spark):
    got = models.mart_publish_calendar(models.master_calendar(spark), "2015-01-03")
    assert rows(got, "gold_datamart_publishing_analysis_dim_publish_calendar_id") == [(20150101,), (20150102,), (20150103,)]
    today = models.mart_publish_calendar(models.master_calendar(spark))
    latest = today.agg(F.max("gold_datamart_publishing_analysis_dim_publish_calendar_date")).first()[0]
    assert latest <= dt.date.today()
