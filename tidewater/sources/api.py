"""Saved responses of the operations API: nested records in pages.

A response is a JSON object ``{"request_id", "page", "total_pages", "data": [record, ...]}``. A
request's records come in numbered pages. Records are unfolded to the warehouse feed's columns as
text, so that checks and types are the same as for the other sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.text import markers_to_null
from tidewater.schemas import API_PAGE, API_PATHS, API_RECORD, UNREADABLE, ddl
from tidewater.sources.readers import Paths


def _parsed(text: Column, schema: str) -> Column:
    options = {"columnNameOfCorruptRecord": UNREADABLE}
    return F.from_json(text, f"{schema}, {UNREADABLE} string", options)


def parse_pages(responses: DataFrame, text_col: str = "value") -> DataFrame:
    """(request_id, page, total_pages, data, unreadable_record), a row per response.

    ``data`` holds the records as text. A response that is no such object, or has no list of
    records, keeps only its text, in ``unreadable_record``; blank ones are left out.
    """
    text = F.col(text_col)
    pages = responses.filter(F.btrim(text) != "").select(text.alias("_text"), _parsed(text, ddl(API_PAGE)).alias("_p"))
    broken = F.col(f"_p.{UNREADABLE}").isNotNull() | F.col("_p.data").isNull()
    whole = lambda c: F.when(~broken, c)
    return pages.select(
        whole(F.col("_p.request_id")).alias("request_id"),
        whole(F.col("_p.page").try_cast("int")).alias("page"),
        whole(F.col("_p.total_pages").try_cast("int")).alias("total_pages"),
        whole(F.col("_p.data")).alias("data"),
        F.when(broken, F.col("_text")).alias(UNREADABLE),
    )


def unfold_records(pages: DataFrame) -> DataFrame:
    """The records of all pages as text columns of the warehouse feed, plus ``unreadable_record``.

    A record that does not fit the declared nesting is a row of nulls with its text, and so is an
    unreadable page; the check rejects both. A readable page without records has no row.
    """
    lost = F.array(F.lit(None).cast("string"))
    rows = pages.select(
        F.col(UNREADABLE).alias("_page"), F.explode(F.when(F.col("data").isNull(), lost).otherwise(F.col("data"))).alias("_text")
    )
    rows = rows.select("_page", "_text", _parsed(F.col("_text"), API_RECORD).alias("_r"))
    broken = F.col("_page").isNotNull() | F.col("_r").isNull() | F.col(f"_r.{UNREADABLE}").isNotNull()
    return rows.select(
        *[F.when(~broken, F.col(f"_r.{path}")).alias(name) for name, path in API_PATHS.items()],
        F.when(broken, F.coalesce("_page", "_text", F.lit("null"))).alias(UNREADABLE),
    )


def read_api_pages(spark: SparkSession, path: Paths, whole_files: bool = False) -> DataFrame:
    """Saved responses, one per line; with ``whole_files`` one per file, which cannot be split."""
    return parse_pages(spark.read.text(path, wholetext=whole_files))


def read_api(spark: SparkSession, path: Paths, whole_files: bool = False) -> DataFrame:
    """The records of saved responses as a text feed, missing-value markers as null."""
    return markers_to_null(unfold_records(read_api_pages(spark, path, whole_files)))


def missing_pages(pages: DataFrame) -> DataFrame:
    """(request_id, page) of every page that a request announced and that no response brought.

    A request announces the largest ``total_pages`` of its responses. An unreadable response has
    no page number, so its page counts as missing.
    """
    known = pages.filter("request_id IS NOT NULL")
    asked = known.groupBy("request_id").agg(F.max("total_pages").alias("total")).filter("total > 0")
    wanted = asked.select("request_id", F.explode(F.sequence(F.lit(1), F.col("total"))).alias("page"))
    return wanted.join(known.select("request_id", "page").distinct(), ["request_id", "page"], "left_anti")
