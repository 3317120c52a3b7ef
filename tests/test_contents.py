from __future__ import annotations

from acervo.functions import lines as rules
from acervo.operators import contents
from acervo.sources import documents
from tables import rows

PROSE = "um texto corrido sem nada de especial"


def _pages(spark, docs):
    data = [(d, p, text) for d, pages in docs.items() for p, text in pages.items()]
    return spark.createDataFrame(data, "doc_id string, page_no int, text string")


def test_line_rules(value):
    texts = ["", "xii", "12", "1234", "civil", "Sumário", "livro", "XV"]
    assert value(rules.is_noise, texts) == [True, True, True, False, True, False, False, True]
    texts = ["SUMÁRIO", "sumario", "O Sumário", "Sumário 1"]
    assert value(rules.is_marker, texts) == [True, True, False, False]
    texts = ["Algo ..... 3", "Algo ___ b", "Algo --- b", "Algo 12", "Algo vivid", "Introdução geral", "1.2 Algo", "1 Algo", "Algo", "iv", "Lista de figuras"]
    assert value(rules.is_contents_entry, texts) == [True] * 8 + [False, False, True]


def test_only_what_changes_is_replaced_and_nothing_else_differs(value):
    import itertools
    import re

    parts = ["a", " ", "\t", "\n", "\x1c", "\u00a0", "\u2003", "\x85", "·", "…", "\ufeff", "\x00"]
    texts = ["".join(t) for n in (1, 2, 3) for t in itertools.product(parts, repeat=n)]
    white = "[\t-\r \x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
    plain = [t.replace("\x00", " ").replace("\ufeff", " ").replace("·", ".").replace("…", "...") for t in texts]
    assert value(rules.normalise_line, texts) == [re.sub(white, " ", t).strip(" ") for t in plain]


def test_normalisation(value):
    assert value(rules.normalise_line, [" a\u0000b\t c… d·e ﻿", None]) == ["a b c... d.e", ""]
    assert value(rules.normalise_page, ["\n a \t b\r\n\n  \n c\n"]) == ["a b\nc"]
    assert value(rules.without_leaders, ["1. Algo ..... 5", "a ____ b --- c", "...."]) == ["1. Algo 5", "a b c", ""]
    assert value(rules.line_chars, ["  ab  c ", " ", "", None]) == [4, 0, 0, 0]


def _section(spark, pages):
    section = contents.section_lines(contents.page_lines(_pages(spark, {"d": pages})))
    return [r["line"] for r in section.orderBy("page_no", "line_no").collect()]


def test_section_runs_to_the_first_other_page(spark):
    pages = {
        1: f"Capa\n{PROSE}",
        2: "antes\nxii\nSumário\nIntrodução ..... 1\n12\nQualquer linha",
        3: None,
        4: "1. Um 2\n2. Dois 3\n3. Tres 4\ncivil",
        5: "\n".join([PROSE + " a"] * 3),
        6: "1. Depois 9\n2. Depois 10\n3. Depois 11",
    }
    assert _section(spark, pages) == ["Sumário", "Introdução ..... 1", "Qualquer linha", "1. Um 2", "2. Dois 3", "3. Tres 4"]


def test_marker_must_be_the_whole_line_and_within_the_page_limit(spark):
    assert _section(spark, {1: "Veja o Sumário\n1. Um 2"}) == []
    assert _section(spark, {36: "SUMARIO\n1. Um 2"}) == ["SUMARIO", "1. Um 2"]
    lines = contents.page_lines(_pages(spark, {"d": {35: "Sumário\n1. Um 2", 36: "2. Dois 3"}}))
    capped = contents.section_lines(contents.page_lines(_pages(spark, {"d": {36: "Sumário"}}), max_pages=35))
    assert capped.count() == 0
    assert rows(contents.page_stats(lines, max_pages=35), "page_no") == [(35,)]


def test_section_text(spark):
    pages = {1: "Sumário\nUm ..... 1\nUm --- 1\n....\n----\nDois 2", 2: "Dois 2\nUm ..... 1\nTres 3\n_____"}
    section = contents.clean_section(contents.section_lines(contents.page_lines(_pages(spark, {"d": pages}))))
    texts = {r["doc_id"]: r["section"] for r in contents.section_texts(section).collect()}
    assert texts == {"d": "Sumário\nUm 1\n\nDois 2\nUm 1\nTres 3"}
    assert rows(contents.section_sizes(section)) == [("d", len(texts["d"]))]


def test_oversized_pages_are_cut_without_a_trace(spark, monkeypatch):
    lines = ["Sumário"] + [f"Linha {i // 3} ... {i // 6}" for i in range(60)]
    pages = {"d": {1: "\n".join(lines), 2: "\n".join(lines[-4:])}, "e": {1: "Sumário"}}
    whole = contents.clean_section(contents.section_lines(contents.page_lines(_pages(spark, pages))))
    monkeypatch.setattr(contents, "LINES_PER_PART", 7)
    cut = contents.clean_section(contents.section_lines(contents.page_lines(_pages(spark, pages))))
    assert whole.select("part").distinct().count() == 1
    assert cut.select("part").distinct().count() == 9
    assert rows(cut, "doc_id", "page_no", "line_no", "line") == rows(whole, "doc_id", "page_no", "line_no", "line")
    in_parts = rows(contents.section_texts(cut))
    monkeypatch.undo()
    assert rows(contents.section_texts(whole)) == in_parts and len(in_parts) == 2


def test_page_stats(spark):
    pages = {1: "Um ..... 1\nxii\n\nalgo", 2: PROSE, 3: "a\nb\nc\nd\ne\nf\ng\nh\ni 1\nj 2"}
    stats = contents.page_stats(contents.page_lines(_pages(spark, {"d": pages})))
    got = rows(stats, "page_no", "n_lines", "n_entries", "n_numbers", "n_leaders", "n_chars", "looks_like_contents")
    assert got == [
        (1, 2, 1, 1, 1, len("Um ..... 1\nxii\nalgo"), True),
        (2, 1, 0, 0, 0, len(PROSE), False),
        (3, 8, 2, 2, 0, len(pages[3]), False),
    ]


def test_status_gates(spark):
    long = "\n".join([PROSE] * 20)
    entries = "\n".join(f"{i}. Capitulo numero {i} ..... {i}" for i in range(1, 12))
    docs = {
        "short": {1: "Sumário\nUm 1"},
        "no marker": {1: long},
        "short section": {1: "Sumário\nUm 1", 2: long},
        "good": {1: f"Sumário\n{entries}", 2: long, 3: long},
        "empty": {1: ""},
        # The page that ends the run still counts, the pages after it do not.
        "stops counting": {1: "Sumário\n" + entries[:150], 2: PROSE, 3: long},
    }
    status = contents.section_status(contents.page_lines(_pages(spark, docs)))
    got = {r["doc_id"]: (r["status"], r["message"]) for r in status.collect()}
    assert got == {
        "short": (422, "error 1: No enough text"),
        "no marker": (422, "error 2: SUMÁRIO marker not found"),
        "short section": (422, "error 3: Extracted SUMÁRIO is too short"),
        "good": (200, None),
        "empty": (422, "error 1: No enough text"),
        "stops counting": (422, "error 1: No enough text"),
    }
    good, bad = contents.split_by_status(status)
    assert good.count() + bad.count() == status.count() == len(docs)


def test_pdf_status(spark):
    objects = spark.createDataFrame(
        [("a.pdf", 1000), ("b.PDF", 999), ("c.txt", 5000)], "path string, length bigint"
    )
    assert rows(contents.pdf_status(objects), "path", "status", "message") == [
        ("a.pdf", 200, None),
        ("b.PDF", 422, "error 0: PDF file is too small. Size: 999 bytes"),
        ("c.txt", 422, "error 0: Input file is not a PDF. Received key: c.txt"),
    ]


def test_stored_objects_pass_the_same_gate(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"x" * 1000)
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b.pdf").write_bytes(b"x" * 10)
    got = contents.pdf_status(documents.stored_objects(spark, str(tmp_path)))
    assert rows(got, "length", "status") == [(10, 422), (1000, 200)]
