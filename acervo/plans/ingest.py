"""From fetched pages and extracted lines to stored documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acervo import fixed_values as fixed
from acervo.operators import contents, markup, records
from acervo.session import stored
from acervo.sources.documents import append_documents


def item_requests(search_pages: DataFrame, pattern: str = fixed.ITEM_PATH) -> DataFrame:
    """Item links of the search pages: page_id, link, first_pos."""
    return markup.item_links(markup.container_links(search_pages), pattern)


def store_papers(pages: DataFrame, full_pages: DataFrame, target: str, run: int) -> DataFrame:
    """Store the metadata documents of item pages under ``target``; returns the rejected pages."""
    found = stored(records.records_with_fallback(pages, full_pages), "papers")
    append_documents(records.documents(found), target, run)
    return records.rejected_documents(found)


def store_contents(lines: DataFrame, target: str, run: int) -> DataFrame:
    """Store the tables of contents of documents under ``target``; returns the rejected documents."""
    results = stored(contents.contents_documents(lines), "contents")
    good, bad = contents.split_by_status(results)
    append_documents(good, target, run)
    return bad.select(F.col("doc_id").cast("string").alias("key"), "status", "message")
