"""Queries of the page readers. The tables at hand hold no pages of works, so each query writes its pages from
them as markup, reads that back, and its SQL gives the same rows straight from the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import timing as TM
from ..operators import control, extract, transfer
from . import views as V
from .catalog import query

ORIGIN = "https://archive.example"
#: Rows on one page of a listing.
PAGE = 20


def _text(value: Column) -> Column:
    """Text as markup."""
    return F.replace(F.replace(value, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def _page(rows: DataFrame, key: list[str], order: str, item: Column, before: str, after: str) -> DataFrame:
    """(key, html): a page for each key with its rows' items in order."""
    items = rows.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), item.alias("i")))).alias("x"))
    return items.select(*key, F.concat(F.lit(before), F.array_join(F.transform("x", lambda x: x["i"]), ""), F.lit(after)).alias("html"))


def _listing(spark, sf) -> DataFrame:
    docs = V.table(spark, sf, "documents").select("doc_id", F.floor(F.col("doc_id") / PAGE).cast("bigint").alias("page"), F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.concat(F.lit("No. "), F.col("lang"))).alias("title"))
    link = F.concat(F.lit("<li class='work blurb group'><h4 class='heading'><a href='/works/"), F.col("doc_id").cast("string"), F.lit("'>"), F.col("title"), F.lit("</a></h4></li>"))
    return _page(docs, ["page"], "doc_id", link, "<ol>", "</ol>")


@query("q_read_tag_works", f"""
SELECT doc_id // {PAGE} AS page, row_number() OVER (PARTITION BY doc_id // {PAGE} ORDER BY doc_id) - 1 AS ord, doc_id::VARCHAR AS work, CASE WHEN doc_id % 3 = 0 THEN 'Work ' || doc_id ELSE 'No. ' || lang END AS title FROM documents""")
def q_read_tag_works(spark, sf):
    return extract.tag_works(_listing(spark, sf)).select("page", F.col("ord").cast("bigint"), F.col("sourceWorkId").alias("work"), "title")


@query("q_read_tag_search", """
SELECT 'tag ' || p_partkey AS name, 'p' || p_partkey AS slug, CASE p_size % 3 WHEN 0 THEN 'Fandom' WHEN 1 THEN 'Character' ELSE 'Freeform' END AS type, 1000 + p_partkey AS works FROM part""")
def q_read_tag_search(spark, sf):
    p = F.col("p_partkey").cast("string")
    parts = V.table(spark, sf, "part").select("p_partkey", F.floor(F.col("p_partkey") / PAGE).alias("page"), (F.col("p_size") % 3).alias("kind"))
    item = F.concat(F.lit("<h3>"), F.when(F.col("kind") == 0, "Fandoms").when(F.col("kind") == 1, "Characters").otherwise("More"), F.lit("</h3><ul><li><a href='/tags/p"), p, F.lit("/works'>tag "), p, F.lit("</a> ("), F.format_number(F.col("p_partkey") + 1000, 0), F.lit(")</li></ul>"))
    return extract.tag_search(_page(parts, ["page"], "p_partkey", item, "<div>", "</div>")).select("name", "slug", "type", F.col("worksCount").cast("bigint").alias("works"))


def _kudos_pages(spark, sf) -> DataFrame:
    """(sourceWorkId, n, html): customers of a nation as listings; a page has the links of a stretch of 25 * PAGE customers."""
    c = V.table(spark, sf, "customer").select(F.col("c_nationkey").cast("string").alias("sourceWorkId"), F.col("c_custkey"), F.floor(F.col("c_custkey") / (25 * PAGE)).cast("bigint").alias("n"))
    link = F.concat(F.lit("<a href='/users/c"), F.col("c_custkey").cast("string"), F.lit("'>Customer "), F.col("c_custkey").cast("string"), F.lit("</a> "))
    return _page(c, ["sourceWorkId", "n"], "c_custkey", link, "<div id='kudos'>", " and 3 guests</div>")


@query("q_read_kudos", f"SELECT c_nationkey::VARCHAR AS work, 'user:c' || c_custkey AS kudo, 'Customer ' || c_custkey AS name, '{ORIGIN}/users/c' || c_custkey AS profile FROM customer")
def q_read_kudos(spark, sf):
    pages = _kudos_pages(spark, sf).withColumns({"origin": F.lit(ORIGIN), "observedAt": F.lit("t")})
    return extract.kudos(pages).select(F.col("sourceWorkId").alias("work"), F.col("sourceKudoId").alias("kudo"), F.col("authorName").alias("name"), F.col("authorProfileUrl").alias("profile"))


@query("q_read_bookmarks", "SELECT s_nationkey::VARCHAR AS work, 'bookmark:' || s_nationkey || ':s' || s_suppkey AS bookmark, '<p>' || s_suppkey || '</p>' AS notes, CASE WHEN s_suppkey % 2 = 0 THEN 'even' ELSE '' END AS tags FROM supplier")
def q_read_bookmarks(spark, sf):
    s, k = V.table(spark, sf, "supplier"), F.col("s_suppkey").cast("string")
    tag = F.when(F.col("s_suppkey") % 2 == 0, "<ul class='tags'><li><a class='tag'>even</a></li></ul>").otherwise("")
    item = F.concat(F.lit("<li class='user short blurb'><h5 class='byline heading'><a href='/users/s"), k, F.lit("'>s"), k, F.lit("</a></h5>"), tag, F.lit("<blockquote class='userstuff'><p>"), k, F.lit("</p></blockquote></li>"))
    pages = _page(s.withColumns({"sourceWorkId": F.col("s_nationkey").cast("string"), "n": F.floor(F.col("s_suppkey") / (25 * PAGE))}), ["sourceWorkId", "n"], "s_suppkey", item, "<ol class='bookmark index'>", "</ol>").withColumn("origin", F.lit(ORIGIN))
    tags = F.array_join(F.transform("tags", lambda t: t["name"]), ",")
    return extract.bookmarks(pages).select(F.col("sourceWorkId").alias("work"), F.col("sourceBookmarkId").alias("bookmark"), F.col("notesHtml").alias("notes"), tags.alias("tags"))


@query("q_read_comments", """
WITH RECURSIVE c AS (SELECT DISTINCT conv_id, turn, role FROM conversations), d AS (
  SELECT conv_id, turn, role, 0 AS depth FROM c WHERE turn = 0 OR NOT EXISTS (SELECT 1 FROM c p WHERE p.conv_id = c.conv_id AND p.turn = c.turn - 1)
  UNION ALL SELECT c.conv_id, c.turn, c.role, d.depth + 1 FROM d JOIN c ON c.conv_id = d.conv_id AND c.turn = d.turn + 1)
SELECT conv_id::VARCHAR AS work, turn::VARCHAR AS comment, CASE WHEN turn > 0 THEN (turn - 1)::VARCHAR END AS parent, depth, role AS author, role = 'assistant' AS own FROM d""")
def q_read_comments(spark, sf):
    c = V.table(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("sourceWorkId"), "turn", "role").distinct()
    t, up = F.col("turn").cast("string"), (F.col("turn") - 1).cast("string")
    parent = F.when(F.col("turn") > 0, F.concat(F.lit("<ul class='actions'><li><a href='/comments/"), up, F.lit("'>Parent</a></li></ul>"))).otherwise("")
    item = F.concat(F.lit("<li class='comment group' id='comment_"), t, F.lit("'><h4 class='heading byline'><a href='/users/"), F.col("role"), F.lit("'>"), F.col("role"), F.lit("</a></h4><blockquote class='userstuff'><p>said</p></blockquote>"), parent, F.lit("</li>"))
    pages = _page(c, ["sourceWorkId"], "turn", item, "<ol>", "</ol>").withColumns({"origin": F.lit(ORIGIN), "creatorProfileUrls": F.array(F.lit(f"{ORIGIN}/users/assistant/"))})
    return extract.comments(pages).select(
        F.col("sourceWorkId").alias("work"), F.col("sourceCommentId").alias("comment"), F.col("parentSourceCommentId").alias("parent"), "depth", F.col("authorName").alias("author"), F.col("fromWorkCreator").alias("own"))


def _works(spark, sf) -> DataFrame:
    d = V.table(spark, sf, "documents")
    tag = F.concat(F.lit("<dd class='fandom tags'><a class='tag' href='/tags/"), F.col("source"), F.lit("/works'>"), F.col("source"), F.lit("</a></dd><dd class='freeform tags'><a class='tag' href='/tags/all/works'>all</a></dd>"))
    stats = F.concat(F.lit("<dl class='stats'><dd class='words'>"), F.format_number("n_chars", 0), F.lit("</dd><dd class='chapters'>1/"), F.when(F.col("doc_id") % 2 == 0, "1").otherwise("?"), F.lit("</dd></dl>"))
    body = F.concat(F.lit("<div id='workskin'><div class='preface group'><h2 class='title heading'>No. "), F.col("doc_id").cast("string"), F.lit("</h2><h3 class='byline heading'><a rel='author' href='/users/"), F.col("lang"), F.lit("'>"), F.col("lang"), F.lit("</a></h3></div><div id='chapters'><div class='userstuff'><p>"), _text(F.col("text")), F.lit("</p></div></div></div>"))
    html = F.concat(F.lit("<dl class='work meta group'>"), tag, F.lit("</dl>"), stats, body)
    return d.select(F.concat(F.lit(f"{ORIGIN}/works/"), F.col("doc_id").cast("string")).alias("url"), html.alias("html"), F.lit("2025-01-02").cast("timestamp_ntz").alias("captured_at"))


@query("q_read_works", "SELECT doc_id::VARCHAR AS work, 'No. ' || doc_id AS title, n_chars AS words, doc_id % 2 = 0 AS complete, 1 AS chapters, 2 AS tags, 'user:' || lang AS author FROM documents")
def q_read_works(spark, sf):
    parsed = extract.parse_works(_works(spark, sf)).filter("error is null")
    return parsed.select(
        F.col("work_id").alias("work"), F.col("work.title").alias("title"), F.col("work.words").cast("bigint").alias("words"), F.col("work.complete").alias("complete"), F.size("chapters").alias("chapters"),
        F.size("tags").alias("tags"), F.get("authors", F.lit(0))["sourceAuthorId"].alias("author"))


@query("q_read_next_page", f"SELECT page_id, CASE WHEN page_id % 2 = 0 THEN '{ORIGIN}/list?page=' || (page_id + 1) END AS next_url FROM pages")
def q_read_next_page(spark, sf):
    k = F.col("page_id")
    link = F.concat(F.lit("<ol class='pagination'><li class='next'><a href='?page="), (k + 1).cast("string"), F.lit("'>Next</a></li></ol>"))
    p = V.table(spark, sf, "pages").select("page_id", F.concat(F.lit(f"{ORIGIN}/list?page="), k.cast("string")).alias("url"), F.when(k % 2 == 0, link).otherwise("<p>end</p>").alias("html"))
    return extract.next_page(p).select("page_id", "next_url")


@query("q_import_outcome_of_works", """
SELECT doc_id::VARCHAR AS work, CASE WHEN doc_id % 4 = 0 AND doc_id % 3 <> 0 THEN 'failed' WHEN doc_id % 4 = 0 THEN 'hidden' WHEN doc_id % 3 = 0 AND doc_id % 5 = 0 THEN 'skipped' WHEN doc_id % 7 = 0 THEN 'failed' WHEN doc_id % 3 = 0 THEN 'updated' ELSE 'created' END AS outcome FROM documents WHERE NOT (doc_id % 12 = 0 AND doc_id % 5 = 0)
UNION ALL SELECT doc_id::VARCHAR, 'skipped' FROM documents WHERE doc_id % 12 = 0 AND doc_id % 5 = 0""")
def q_import_outcome_of_works(spark, sf):
    d = V.table(spark, sf, "documents").select(F.col("doc_id"), F.col("doc_id").cast("string").alias("sourceWorkId"))
    had = d.filter("doc_id % 3 = 0").select("sourceWorkId", F.when(F.col("doc_id") % 5 == 0, "new").otherwise("old").alias("contentHash"))
    none = spark.createDataFrame([], "sourceWorkId string, sourceTagId string, sourceAuthorId string")
    sets = {
        "works": d.select("sourceWorkId", F.when(F.col("doc_id") % 4 == 0, "hide").otherwise("upsert").alias("operation"), F.lit("new").alias("contentHash")), "chapters": d.filter("doc_id % 7 <> 0").select("sourceWorkId"),
        "workTags": none, "workAuthors": none, "tags": none.select("sourceTagId"), "authors": none.select("sourceAuthorId"),
    }
    return transfer.import_outcomes(had, sets).withColumnRenamed("sourceWorkId", "work")


@query("q_range_configuration", """
SELECT c_custkey AS id, CASE WHEN c_custkey % 5 <> 0 THEN c_custkey END AS start, c_custkey + c_nationkey - 3 AS "end", CASE WHEN c_custkey % 3 = 0 THEN 250 ELSE c_custkey % 1500 END AS batch_size,
CASE WHEN c_custkey % 5 = 0 THEN 'no range' WHEN c_nationkey < 3 THEN 'the range ends before it starts' WHEN c_custkey % 3 <> 0 AND NOT c_custkey % 1500 BETWEEN 1 AND 1000 THEN 'batches hold 1 to 1000 ids' END AS problem FROM customer""")
def q_range_configuration(spark, sf):
    k, n = F.col("c_custkey").cast("bigint"), F.col("c_nationkey").cast("bigint")
    config = F.to_json(F.struct(F.when(k % 5 != 0, k).alias("start"), (k + n - 3).alias("end"), F.when(k % 3 != 0, k % 1500).alias("batchSize")))
    jobs = V.table(spark, sf, "customer").select(k.alias("id"), F.lit("id_range").alias("type"), config.alias("configuration"))
    return control.range_configuration(jobs)


@query("q_byte_text", """
SELECT o_orderkey AS id, CASE WHEN n >= 1073741824 THEN printf('%.1f GB', floor(n / 1073741824 * 10 + 0.5) / 10) WHEN n >= 1048576 THEN printf('%.1f MB', floor(n / 1048576 * 10 + 0.5) / 10) WHEN n >= 1024 THEN printf('%.1f KB', floor(n / 1024 * 10 + 0.5) / 10) ELSE printf('%.0f B', n) END AS size,
CASE WHEN m < 60 THEN m || ' min' WHEN m / 60.0 < 48 THEN ceil(m / 60.0)::BIGINT || ' h' WHEN m / 1440.0 < 365 THEN ceil(m / 1440.0)::BIGINT || ' days' ELSE printf('%.1f years', floor(m / 1440.0 / 365 * 10 + 0.5) / 10) END AS span
FROM (SELECT o_orderkey, (o_orderkey * o_orderkey)::DOUBLE AS n, ceil(o_orderkey * o_orderkey * 10 / 60000.0)::BIGINT AS m FROM orders)""")
def q_byte_text(spark, sf):
    n = F.col("o_orderkey").cast("bigint")
    return V.table(spark, sf, "orders").select(n.alias("id"), TM.byte_text(n * n).alias("size"), TM.long_duration_text(n * n * 10).alias("span"))


@query("q_source_by_key", "SELECT n_nationkey::BIGINT AS id, n_name AS source_key FROM nation WHERE n_name = (SELECT min(n_name) FROM nation) LIMIT 1")
def q_source_by_key(spark, sf):
    s = V.sources(spark, sf)
    return s.join(s.agg(F.min("source_key").alias("source_key")), "source_key", "left_semi").limit(1).select("id", "source_key")


@query("q_subscribed_tags", "SELECT p_partkey AS id, p_partkey IN (SELECT s_suppkey FROM supplier) AS subscribed FROM part")
def q_subscribed_tags(spark, sf):
    subs = V.table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("tag_slug"))
    tags = V.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_partkey").cast("string").alias("slug"))
    return control.with_subscribed(tags, subs).select("id", "subscribed")


@query("q_capture_report", "SELECT count(*) AS requested, count(*) FILTER (doc_id % 9 <> 0) AS parsed, count(*) FILTER (doc_id % 9 = 0) AS failed FROM documents")
def q_capture_report(spark, sf):
    pages = _works(spark, sf).withColumn("html", F.when(F.regexp_extract("url", r"(\d+)$", 1).cast("bigint") % 9 == 0, "<p>gone</p>").otherwise(F.col("html")))
    return control.capture_report(extract.parse_works(pages).select("error"))
