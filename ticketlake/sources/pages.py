"""Landed API pages: ``<dir>/offset=<n>/*.json``, one ``{"result": [...]}`` per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ticketlake.schemas import PAGE_LIMIT


class MissingPages(Exception):
    """The landed pages do not cover the resource."""


def read_pages(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Pages as (offset, result): every record is kept as its own JSON text.

    A page that is not valid JSON fails the read; it never shortens the result.
    ``multi_line`` reads pages that were written indented, one page per file.
    """
    return (
        spark.read.schema("result ARRAY<STRING>, offset BIGINT")
        .option("mode", "FAILFAST")
        .option("multiLine", multi_line)
        .json(path)
    )


def _trace(page):
    """A number of a page that sums up differently unless every page is there once; for columns and plain numbers."""
    page = page % 1_000_003
    return (page * page * 40_503 + page * 2_654_435_761) % 4_294_967_291


def _coverage(size, limit: int) -> list:
    short = size < limit
    page = F.col("offset").cast("bigint") / limit
    return [
        F.count(F.lit(1)).alias("pages"),
        F.sum(size).alias("records"),
        F.max("offset").alias("last_offset"),
        F.max_by(size, F.col("offset")).alias("last_page_size"),
        F.min(F.when(short, F.col("offset"))).alias("first_short_offset"),
        F.count_if(F.col("offset") % limit != 0).alias("odd_offsets"),
        F.sum(_trace(F.floor(page).cast("bigint"))).alias("trace"),
    ]


def page_coverage(pages: DataFrame, limit: int = PAGE_LIMIT) -> DataFrame:
    """One row: pages, records, highest offset, size of the last page, first short page."""
    return pages.agg(*_coverage(F.coalesce(F.size("result"), F.lit(0)), limit))


def assert_complete(found: dict, limit: int = PAGE_LIMIT) -> None:
    """Every offset up to the last page is there once, the last page is short or
    empty, and no page before the end is short."""
    last, short = found["last_offset"], found["first_short_offset"]
    ends_at = last - limit if found["last_page_size"] == 0 else last
    if last is None or found["pages"] != last // limit + 1 or short is None or short < max(ends_at, 0):
        raise MissingPages(str(found))
    if found["odd_offsets"] or found["trace"] != sum(map(_trace, range(found["pages"]))):
        raise MissingPages(f"a page is missing and another one is there twice: {found}")


def split_records(pages: DataFrame, column: str = "result") -> DataFrame:
    """Records of the pages as JSON text, with their place in the resource.

    An absent result is an empty page; null and empty records are skipped.
    """
    keep = [c for c in pages.columns if c != column]
    return pages.select(*keep, F.posexplode(column).alias("position", "record")).where(
        F.col("record").isNotNull() & ~F.col("record").isin("null", "{}")
    )


def parse_envelope(texts: DataFrame, column: str = "page") -> DataFrame:
    """Page text to records, for pages that are already a text column."""
    keep = [c for c in texts.columns if c != column]
    result = F.from_json(column, "result ARRAY<STRING>", {"mode": "FAILFAST"})["result"]
    return split_records(texts.select(*keep, result.alias("result")))


def paged_scan(
    spark: SparkSession,
    path: str,
    limit: int = PAGE_LIMIT,
    coverage: Observation | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """All records of a resource as (offset, position, record).

    The pages are checked for completeness.  With ``coverage`` that costs no
    pass of its own: the numbers are gathered while the records are first
    written, and the caller hands them to ``assert_complete`` afterwards.
    """
    pages = read_pages(spark, path, multi_line)
    if coverage is None:
        assert_complete(page_coverage(pages, limit).first().asDict(), limit)
    else:
        pages = pages.observe(coverage, *_coverage(F.coalesce(F.size("result"), F.lit(0)), limit))
    return split_records(pages)


def single_page_scan(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """A resource fetched without paging, whole."""
    return split_records(read_pages(spark, path, multi_line))


def land_pages(records: DataFrame, path: str, offset: str = "offset", column: str = "record") -> None:
    """Write records (JSON text with their page offset) as page files, and the empty last page.

    A page holds at most one page limit of records, so a group stays small.
    """
    pages = records.groupBy(F.col(offset).alias("offset")).agg(
        F.concat(F.lit('{"result":['), F.array_join(F.collect_list(column), ","), F.lit("]}")).alias("value")
    )
    last = records.agg(F.coalesce(F.max(offset) + PAGE_LIMIT, F.lit(0)).alias("offset")).select(
        "offset", F.lit('{"result":[]}').alias("value")
    )
    pages.unionByName(last).write.partitionBy("offset").text(path)
