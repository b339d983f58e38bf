"""What one asks of a single work or of the fetch log: works with all that belongs to them, and the log's pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .relational import page


def _ordered(rows: DataFrame, name: str, order: list[str], fields: list[str]) -> DataFrame:
    """(sourceWorkId, ``name``): each work's rows as an array in order."""
    key = F.struct(*[F.col(c).alias(f"o{k}") for k, c in enumerate(order)], F.struct(*fields).alias("row"))
    return rows.groupBy("sourceWorkId").agg(F.array_sort(F.collect_list(key)).alias("x")).select("sourceWorkId", F.transform("x", lambda x: x["row"]).alias(name))


def work_details(store: dict[str, DataFrame], asked: DataFrame | None = None) -> DataFrame:
    """Works with their chapters (without texts), authors, tags and series by position, comments that are shown by depth and id, and the numbers of kudos and of bookmarks that
    are shown; a work without any has an empty list or 0. ``asked``: (sourceWorkId), None for all works; only rows of these works are gathered."""
    few = (lambda df: df) if asked is None else (lambda df: df.join(asked.select("sourceWorkId").distinct(), "sourceWorkId", "left_semi"))
    shown = F.col("operation") != "hide"
    lists = {
        "chapters": _ordered(few(store["chapters"]), "chapters", ["position", "sourceChapterId"], ["sourceChapterId", "position", "title", "wordCount", "contentHash"]),
        "authors": _ordered(few(store["workAuthors"]).join(store["authors"], "sourceAuthorId"), "authors", ["position", "sourceAuthorId"], ["sourceAuthorId", "name", "profileUrl", "anonymous", "orphaned", "position"]),
        "tags": _ordered(few(store["workTags"]).join(store["tags"], "sourceTagId"), "tags", ["position", "sourceTagId"], ["sourceTagId", "type", "name", "canonical", "sourceUrl", "position"]),
        "series": _ordered(few(store["seriesWorks"]).join(store["series"], "sourceSeriesId"), "series", ["position", "sourceSeriesId"], ["sourceSeriesId", "name", "sourceUrl", "position"]),
        "comments": _ordered(few(store["comments"]).filter(shown), "comments", ["depth", "sourceCommentId"], ["sourceCommentId", "parentSourceCommentId", "authorName", "authorProfileUrl", "postedAt", "depth", "fromWorkCreator", "textHtml"]),
    }
    found = few(store["works"])
    for df in lists.values():
        found = found.join(df, "sourceWorkId", "left")
    for name, rows in (("kudosCount", store["kudos"]), ("bookmarksCount", store["bookmarks"].filter(shown))):
        found = found.join(few(rows).groupBy("sourceWorkId").agg(F.count("*").alias(name)), "sourceWorkId", "left")
    kinds = found.schema
    filled = {name: F.coalesce(name, F.array().cast(kinds[name].dataType)) for name in lists} | {c: F.coalesce(c, F.lit(0)) for c in ("kudosCount", "bookmarksCount")}
    return found.withColumns(filled)


def chapter(store: dict[str, DataFrame], work: str, chapter_id: str) -> DataFrame:
    """One chapter of a work with its texts, or no row."""
    return store["chapters"].filter((F.col("sourceWorkId") == work) & (F.col("sourceChapterId") == chapter_id)).limit(1)


def content_length(headers: Column) -> Column:
    """The number that the JSON of a response's headers has as content-length; null if it has none."""
    return F.regexp_extract(F.coalesce(F.get_json_object(headers, "$.content-length"), F.lit("")), r"^\s*(-?[0-9]+)", 1).try_cast("bigint")


def fetch_log(fetches: DataFrame, limit: int, offset: int = 0) -> DataFrame:
    """A page of fetches, newest first, of one instant that of highest id first, with the bytes that each response said it has, and the number of all fetches as ``total``. fetches: (id,
    source_work_id, url, http_status, fetched_at, parser_version, response_headers, attempts)."""
    rows = page(fetches, F.desc("fetched_at"), F.desc("id"), limit=limit, offset=offset)
    fields = ("id", "source_work_id", "url", "http_status", "fetched_at", "parser_version", "attempts")
    total = fetches.agg(F.count("*").alias("total"))
    return rows.select(*fields, content_length(F.col("response_headers")).alias("response_bytes")).crossJoin(F.broadcast(total))  # one row
