"""Values the results depend on: word lists, lookup tables, patterns, limits, messages.

Everything here is a fixed value of the data contract. No logic lives in this module.
"""

# --- fixed values: text cleaning -------------------------------------------------
ACCENTED_LETTERS = "ÁÀÃÂÄÉÈÊËÍÌÎÏÓÒÕÔÖÚÙÛÜÇ"
PLAIN_LETTERS = "AAAAAEEEEIIIIOOOOOUUUUC"

# --- fixed values: Portuguese dates ----------------------------------------------
MONTHS_PT = [
    ("Jan", "01"),
    ("Fev", "02"),
    ("Mar", "03"),
    ("Abr", "04"),
    ("Mai", "05"),
    ("Jun", "06"),
    ("Jul", "07"),
    ("Ago", "08"),
    ("Set", "09"),
    ("Out", "10"),
    ("Nov", "11"),
    ("Dez", "12"),
]
DAY_MONTH_YEAR = r"^([0-9]{1,2})-([A-Za-z]{3})-[0-9]{4}$"
MONTH_YEAR = r"^([A-Za-z]{3})-[0-9]{4}$"
YEAR_AT_END = r"([0-9]{4})$"

# --- fixed values: calendar ------------------------------------------------------
CALENDAR_START = "2000-01-01"
CALENDAR_END = "2035-12-31"
PUBLISH_CALENDAR_FIRST_YEAR = 2015

# --- fixed values: stored documents ----------------------------------------------
PERIODS = ["2015_2016", "2017_2018", "2019_2020", "2021_2022", "2023_2024", "2025_2026"]
DEFAULT_PERIOD = "2019_2020"

PAPER_KEYS = [
    "_id",
    "_source_url",
    "_pdf_url",
    "_parser_warning",
    "Abstract",
    "CNPq",
    "Editor",
    "Idioma",
    "Resumo",
    "Tipo",
    "URI",
    "Data do documento",
    "Aparece nas coleções",
    "Título(s) alternativo(s)",
    "Título",
    "Autor(es)",
    "Citação",
    "País",
    "Palavras-chave",
    "Primeiro Orientador",
    "Segundo Orientador",
    "Sigla da Instituição",
    "Tipo de Acesso",
    "Identificador DOI",
    "metadata.dc.contributor.advisor-co1",
    "metadata.dc.contributor.advisor-co2",
    "metadata.dc.contributor.referee1",
    "metadata.dc.contributor.referee2",
    "metadata.dc.contributor.referee3",
    "metadata.dc.contributor.referee4",
    "metadata.dc.contributor.referee5",
    "metadata.dc.publisher.department",
    "metadata.dc.publisher.program",
]
CONTENTS_KEYS = ["paper_id", "tableOfContent"]

# Column of the external metadata table <- document key.
METADATA_MAPPING = {
    "tipo": "Tipo",
    "titulo": "Título",
    "titulos_alternativos": "Título(s) alternativo(s)",
    "autores": "Autor(es)",
    "resumo": "Resumo",
    "abstract_text": "Abstract",
    "palavras_chave": "Palavras-chave",
    "cnpq": "CNPq",
    "idioma": "Idioma",
    "pais": "País",
    "editor": "Editor",
    "sigla_instituicao": "Sigla da Instituição",
    "citacao": "Citação",
    "tipo_acesso": "Tipo de Acesso",
    "uri": "URI",
    "data_documento": "Data do documento",
    "aparece_nas_colecoes": "Aparece nas coleções",
    "id": "_id",
    "source_url": "_source_url",
    "pdf_url": "_pdf_url",
}
CONTENTS_MAPPING = {"paper_id": "paper_id", "table_of_content": "tableOfContent"}

# Snake-case column <- odd document label.
LABEL_COLUMNS = {
    "aparece_nas_colecoes": "Aparece nas coleções",
    "titulos_alternativos": "Título(s) alternativo(s)",
    "titulo": "Título",
    "autores": "Autor(es)",
    "citacoes": "Citação",
    "pais": "País",
    "palavra_chave": "Palavras-chave",
    "primeiro_orientador": "Primeiro Orientador",
    "segundo_orientador": "Segundo Orientador",
    "sigla_da_instituicao": "Sigla da Instituição",
    "tipo_de_acesso": "Tipo de Acesso",
    "identificador_doi": "Identificador DOI",
    "metadata_dc_contributor_advisor_co1": "metadata.dc.contributor.advisor-co1",
    "metadata_dc_contributor_advisor_co2": "metadata.dc.contributor.advisor-co2",
    "metadata_dc_contributor_referee1": "metadata.dc.contributor.referee1",
    "metadata_dc_contributor_referee2": "metadata.dc.contributor.referee2",
    "metadata_dc_contributor_referee3": "metadata.dc.contributor.referee3",
    "metadata_dc_contributor_referee4": "metadata.dc.contributor.referee4",
    "metadata_dc_publisher_department": "metadata.dc.publisher.department",
    "metadata_dc_publisher_program": "metadata.dc.publisher.program",
    "metadata_dc_contributor_referee5": "metadata.dc.contributor.referee5",
}

# Cleaned silver column (without its prefix) <- input column, in output order.
SILVER_PAPER_TEXTS = {
    "table_of_content": "tableOfContent",
    "abstract": "Abstract",
    "aparece_nas_colecoes": "aparece_nas_colecoes",
    "autores": "autores",
    "cnpq": "CNPq",
    "citacao": "citacoes",
    "editor": "Editor",
    "idioma": "Idioma",
    "palavras_chave": "palavra_chave",
    "pais": "pais",
    "primeiro_orientador": "primeiro_orientador",
    "resumo": "Resumo",
    "segundo_orientador": "segundo_orientador",
    "sigla_da_instituicao": "sigla_da_instituicao",
    "tipo": "Tipo",
    "tipo_de_acesso": "tipo_de_acesso",
    "titulo": "titulo",
    "titulos_alternativos": "titulos_alternativos",
    "uri": "URI",
    "pdf_url": "_pdf_url",
    "source_url": "_source_url",
    "identificador_doi": "identificador_doi",
    "metadata_dc_contributor_advisor_co1": "metadata_dc_contributor_advisor_co1",
    "metadata_dc_contributor_advisor_co2": "metadata_dc_contributor_advisor_co2",
    "metadata_dc_contributor_referee1": "metadata_dc_contributor_referee1",
    "metadata_dc_contributor_referee2": "metadata_dc_contributor_referee2",
    "metadata_dc_contributor_referee3": "metadata_dc_contributor_referee3",
    "metadata_dc_contributor_referee4": "metadata_dc_contributor_referee4",
    "metadata_dc_publisher_department": "metadata_dc_publisher_department",
    "metadata_dc_publisher_program": "metadata_dc_publisher_program",
    "metadata_dc_contributor_referee5": "metadata_dc_contributor_referee5",
}

# --- fixed values: search and item pages -----------------------------------------
SEARCH_TABLE_SUMMARY = "This table browses all dspace content"
ITEM_PATH = r"/handle/[^/]+/\d+"
HANDLE_ID = r"/handle/[^/]+/(\d+)"
BITSTREAM_ID = r"/bitstream/[^/]+/(\d+)/"
BITSTREAM_HREF = r"""(?i)href=["']([^"']*?/bitstream/[^"']+)["']"""
FILES_HEADINGS = ["arquivos associados a este item", "files in this item"]
FILES_SUMMARIES = ["files associated", "arquivos associados"]
METADATA_LABEL_CLASS = "metadatafieldlabel"
METADATA_TERMS = [
    "tipo",
    "type",
    "título",
    "title",
    "autor",
    "author",
    "orientador",
    "advisor",
    "data",
    "date",
    "resumo",
    "abstract",
    "palavras",
    "keywords",
    "uri",
    "citation",
    "publisher",
    "instituição",
    "language",
    "dc.",
]
SKIPPED_LABELS = [
    "arquivo",
    "file",
    "descrição",
    "description",
    "tamanho",
    "size",
    "formato",
    "format",
    "visualizar",
    "view/open",
]
PARSER_WARNING = "No metadata fields were found in default page or show=full page."

# --- fixed values: tables of contents --------------------------------------------
MAX_PAGES_TO_SCAN = 35
MIN_EXTRACTED_TEXT_CHARS = 500
MIN_SECTION_CHARS = 100
MIN_PDF_BYTES = 1000
MIN_ENTRIES = 3
MIN_TRAILING_NUMBERS = 3
MIN_LEADERS = 2
MIN_ENTRY_RATIO = 0.45
SECTION_MARKER = r"(?iu)^SUM[ÁA]RIO$"
ROMAN_NUMBER_LINE = r"^[ivxlcdm]{1,8}$"
PAGE_NUMBER_LINE = r"^\d{1,3}$"
LEADERS = r"(\.{3,}|_{3,}|-{3,})"
TRAILING_PAGE_NUMBER = r"(?i)\s+(\d{1,4}|[IVXLCDM]{1,8})$"
NUMBERED_HEADING = r"^\d+(\.\d+)*\.?\s+"
CONTENTS_TERMS = [
    "INTRODUÇÃO",
    "INTRODUCAO",
    "CAPÍTULO",
    "CAPITULO",
    "CONSIDERAÇÕES FINAIS",
    "CONSIDERACOES FINAIS",
    "CONCLUSÃO",
    "CONCLUSAO",
    "CONCLUSÕES",
    "CONCLUSOES",
    "REFERÊNCIAS",
    "REFERENCIAS",
    "RESUMO",
    "ABSTRACT",
    "LISTA DE",
    "AGRADECIMENTOS",
    "DEDICATÓRIA",
    "DEDICATORIA",
    "EPÍGRAFE",
    "EPIGRAFE",
    "FICHA CATALOGRÁFICA",
    "FICHA CATALOGRAFICA",
    "FOLHA DE APROVAÇÃO",
    "FOLHA DE APROVACAO",
]
NOT_ENOUGH_TEXT = "error 1: No enough text"
MARKER_NOT_FOUND = "error 2: SUMÁRIO marker not found"
SECTION_TOO_SHORT = "error 3: Extracted SUMÁRIO is too short"
NOT_A_PDF = "error 0: Input file is not a PDF. Received key: "
PDF_TOO_SMALL = "error 0: PDF file is too small. Size: %d bytes"

# --- fixed values: run parameters ------------------------------------------------
RUN_MODE_PUBLISH_DATE = "PUBLISH_DATE"
RUN_MODE_DIRECT_LINK = "DIRECT_LINK"
SEARCH_QUERY = (
    "/simple-search?location=&query=&filter_field_1=dateIssued"
    "&filter_type_1=equals&filter_value_1=%s&rpp=9999"
)
METADATA_PREFIX = "Metadata"
PDF_PREFIX = "PDF"
CONTENTS_PREFIX = "TableOfContent"
BAD_DATE_RANGE = "date_end must be >= date_start"
URL_REQUIRED = "The field 'url' is required."
MISSING_URL = "Missing required field: url"
MISSING_PDF_URL = "Missing required field: pdf_url"
MISSING_BUCKET_ONLY = "Missing bucket. Send bucket or configure S3_BUCKET."
MISSING_BUCKET = "Missing bucket or pdf_s3_uri."
MISSING_KEY = "Missing key or pdf_s3_uri."
INVALID_EVENT = "Invalid event. Expected JSON object."
UNREADABLE_BODY = "The body is no readable JSON."
NO_PAPER_ID = "Could not extract paper id from URL."
NO_ID_IN_PDF_URL = "Missing id and could not extract id from URL."
NO_ID_IN_FILE_NAME = "Could not extract paper_id from file name. Send paper_id explicitly."
INVALID_STORAGE_URI = "Invalid s3_uri. Expected format: s3://bucket/key.pdf"
NON_200_RESPONSE = "Lambda returned non-200 response"
NO_RESPONSE_BODY = "Lambda response has no body"
