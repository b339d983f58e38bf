from datetime import datetime

import pyarrow as pa
import pytest

from quillspark.functions import text as X
from quillspark.operators import extract

def tag_list(kind, *tags):
    return f'<dd class="{kind} tags">' + "".join(f'<a class="tag" href="/tags/{slug}/works">{name}</a>' for slug, name in tags) + "</dd>"


def chapter(number, content, href=None, title=""):
    head = f'<div class="chapter preface group"><h3 class="title"><a href="{href}">{title}</a></h3></div>' if href else ""
    return f'<div class="chapter" id="chapter-{number}">{head}<div class="userstuff module" role="article">{content}</div></div>'


def work_page(chapters, second_author="left"):
    meta = tag_list("rating", ("Teen", "Teen")) + tag_list("fandom", ("Sea+Charts", "Sea Charts")) + tag_list("freeform", ("Sea%20Charts", "Harbours")) + '<dd class="language">Deutsch</dd>'
    stats = "".join(f'<dd class="{k}">{v}</dd>' for k, v in {"published": "2019-07-08", "status": "2021-10-11", "words": "20,480", "chapters": "2/2"}.items())
    people = f'<a rel="author" href="/users/mira/pseuds/mira">mira</a>, <a rel="author" href="/users/orphan_account">{second_author}</a>'
    return (
        f'<dl class="work meta group">{meta}</dl><dl class="stats">{stats}</dl><div id="workskin"><div class="preface group"><h2 class="title heading">\n The  Night Ferry</h2>'
        f'<h3 class="byline heading">{people}</h3><div class="summary"><blockquote class="userstuff"><p>salt &amp; rope</p></blockquote></div></div>'
        f'<div class="series"><span class="position">Part 3 of <a href="/series/510">Crossings</a></span></div><div id="chapters">{chapters}</div></div>'
    )


WORK = work_page(chapter(1, "<p>Cast off<br>now</p>", "/works/12/chapters/8080", "Pier") + chapter(2, "<p>Ashore</p>"))


def pages(spark, *rows):
    return spark.createDataFrame([(u, h, datetime(2024, 5, 1)) for u, h in rows], "url string, html string, captured_at timestamp")


def test_work_page(spark):
    parsed = extract.parse_works(pages(spark, ("https://a.example/works/12?x=1", WORK)))
    assert parsed.first()["error"] is None
    sets = {k: [r.asDict() for r in v.collect()] for k, v in extract.record_sets(parsed).items()}
    work = sets["works"][0]
    assert (work["title"], work["languageCode"], work["words"], work["complete"], work["updatedAt"]) == ("The Night Ferry", "de", 20480, True, "2021-10-11")
    assert work["summaryHtml"] == "<p>salt &amp; rope</p>"
    assert {a["sourceAuthorId"]: a["orphaned"] for a in sets["authors"]} == {"user:mira": False, "user:orphan_account": True}
    assert sorted((c["sourceChapterId"], c["position"], c["contentHtml"]) for c in sets["chapters"]) == [("2", 2, "<p>Ashore</p>"), ("8080", 1, "<p>Cast off<br>now</p>")]
    assert {(t["sourceTagId"], t["type"]) for t in sets["tags"]} == {("tag:Rating:Teen", "Rating"), ("tag:Fandom:Sea+Charts", "Fandom"), ("tag:Freeform:Sea Charts", "Freeform")}
    assert sorted(t["position"] for t in sets["workTags"]) == [0, 1, 2]
    assert sets["seriesWorks"] == [{"sourceSeriesId": "series:510", "sourceWorkId": "12", "position": 3}]
    assert work["contentHash"].startswith("sha256:") and sets["observations"][0]["contentHash"] == work["contentHash"]


def test_hash_follows_content_only(spark):
    other = WORK.replace("Ashore", "Adrift")
    a, b, c = [r["contentHash"] for r in extract.parse_works(pages(spark, ("https://a.example/works/12", WORK), ("https://a.example/works/12", WORK.replace(">left<", ">gone<")), ("https://a.example/works/12", other))).select("contentHash").collect()]
    assert a == b != c


@pytest.mark.parametrize("url, html, error", [
    ("https://a.example/users/12", WORK, "no work number in the address https://a.example/users/12"),
    ("https://a.example/works/9", "<h2>nothing</h2>", "title missing: work 9"),
    ("https://a.example/works/9", "<div id=workskin><h2 class='title heading'>T</h2></div>", "no chapters on the page: work 9"),
    ("https://a.example/works/12", WORK.replace("<p>Ashore</p>", " "), "empty chapter: work 12, place 2"),
    ("https://a.example/works/9", None, "title missing: work 9"),
])
def test_errors_are_rows(spark, url, html, error):
    parsed = extract.parse_works(pages(spark, (url, html)))
    assert parsed.first()["error"] == error
    assert extract.record_sets(parsed)["works"].count() == 0


def test_single_chapter(spark):
    html = "<div id=workskin><h2 class='title heading'>T</h2><h3 class=byline>Anonymous</h3><div id=chapters><div class=userstuff><p>x</p></div></div></div>"
    sets = extract.record_sets(extract.parse_works(pages(spark, ("https://a.example/works/9", html))))
    assert sets["chapters"].first()["sourceChapterId"] == "work:9"
    assert sets["authors"].first()["sourceAuthorId"] == "anonymous"


def test_tag_pages(spark):
    html = """<h3>Fandoms</h3><ol><li><a href="/tags/A*s*B/works">A/B</a> (1,204)</li><li><a href="/tags/A*s*B/works">again</a></li></ol>
    <h3>Other Tags</h3><ul><li><a href="/tags/Fluff/works"></a> (3)</li><li><a href="/tags/x">no</a></li></ul>"""
    found = extract.tag_search(spark.createDataFrame([(html,)], "html string")).collect()
    assert sorted((r["name"], r["slug"], r["type"], r["worksCount"]) for r in found) == [("A/B", "A*s*B", "Fandom", 1204), ("Fluff", "Fluff", "Freeform", 3)]
    listing = "<ul><li class='work blurb group'><h4 class=heading><a href='/works/5'>Five</a></h4></li><li class='work blurb'><h4 class=heading><a href='/works/6'></a></h4></li></ul>"
    assert [(r["sourceWorkId"], r["title"]) for r in extract.tag_works(spark.createDataFrame([(listing,)], "html string")).orderBy("ord").collect()] == [("5", "Five"), ("6", "Work 6")]


def test_comments(spark):
    one = lambda n, parent, who: f"<li class='comment group' id='comment_{n}'><h4 class='heading byline'><a href='/users/{who}'>{who}</a> <span class='posted datetime'>Sat 15</span></h4><blockquote class=userstuff><p>t{n}</p></blockquote><ul class=actions>" + (f"<li><a href='/comments/{parent}'>Parent</a></li>" if parent else "") + "</ul></li>"
    html = "<ol>" + one(1, None, "bob") + one(2, 1, "ann") + one(3, 2, "") + one(4, 99, "x") + one(5, 6, "y") + one(6, 5, "z") + "</ol>"
    df = spark.createDataFrame([("12", "https://a.example", ["https://a.example/users/ann/"], html)], "sourceWorkId string, origin string, creatorProfileUrls array<string>, html string")
    got = {r["sourceCommentId"]: r for r in extract.comments(df).collect()}
    assert {k: r["depth"] for k, r in got.items()} == {"1": 0, "2": 1, "3": 2, "4": 0, "5": 2, "6": 2}
    assert got["2"]["fromWorkCreator"] and not got["1"]["fromWorkCreator"]
    assert got["3"]["authorName"] == "Anonymous" and got["1"]["textHtml"] == "<p>t1</p>"


def test_kudos_bookmarks_next(spark):
    k = spark.createDataFrame([("12", "https://a.example", "t", "<p id=kudos><a href='/users/bob%20b'>bob</a> and 3 guests <a href='/x'>no</a></p>")], "sourceWorkId string, origin string, observedAt string, html string")
    assert [(r["sourceKudoId"], r["authorProfileUrl"]) for r in extract.kudos(k).collect()] == [("user:bob b", "https://a.example/users/bob%20b")]
    html = "<ol class='bookmark index'><li class='user short blurb'><h5 class='byline heading'><a href='/users/c'>c</a></h5><p class=datetime>1 Jan</p><ul class=tags><li><a class=tag>good</a></li></ul><blockquote class=userstuff><p>n</p></blockquote></li></ol>"
    b = extract.bookmarks(spark.createDataFrame([("12", "https://a.example", html)], "sourceWorkId string, origin string, html string")).first()
    assert (b["sourceBookmarkId"], b["tags"][0]["name"], b["updatedAt"], b["notesHtml"]) == ("bookmark:12:c", "good", "1 Jan", "<p>n</p>")
    n = spark.createDataFrame([("https://a.example/w?page=1", "<ol class=pagination><li class=next><a href='?page=2'>x</a></li></ol>"), ("https://a.example/w", "<p>")], "url string, html string")
    assert [r["next_url"] for r in extract.next_page(n).collect()] == ["https://a.example/w?page=2", None]


def test_pages_are_read_a_stretch_at_a_time():
    big = pa.array(["<p>" + "x" * (1 << 20) + "</p>"] * 12 + [None, ""])
    read = []
    out = X.by_stretches(lambda page: read.append(page) or len(page or ""), pa.int64())(iter([big, big.slice(0, 0)]))
    first = next(out)
    assert 0 < len(first) == len(read) < 6
    assert [*first.to_pylist(), *(n for a in out for n in a.to_pylist())] == [(1 << 20) + 7] * 12 + [0, 0]
    assert list(X.stretches(pa.array(["a" * 9, "b", None, "c"]), 4)) == [(0, 1), (1, 4)]


def test_text_of_large_pages_is_handed_on_in_stretches():
    pages = pa.array(["<p>" + "y" * (1 << 20) + "</p>"] * 12)
    sizes = [len(a) for a in X.html_text.func(iter([pages]))]
    assert sum(sizes) == 12 and max(sizes) < 6
