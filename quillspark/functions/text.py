"""Column expressions on text: clean-up, numbers, hashes, ids, addresses."""

from __future__ import annotations

import gc
import html
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Language names that sources print, and their codes.
LANGUAGE_CODES = {
    "English": "en", "Svenska": "sv", "Español": "es", "Français": "fr", "Deutsch": "de",
    "Italiano": "it", "Português": "ptBR", "日本語": "ja", "中文": "zh",
}
DEFAULT_LANGUAGE = "en"

#: White space as browsers and scripts see it, no-break blanks and the byte order mark included.
BLANK = r"(?U)[\s\x{FEFF}]"
#: Bytes of text that a Python task makes objects of at a time.
STRETCH_BYTES = 4 << 20


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def compact(text: Column | str) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(_col(text), BLANK + "+", " "))


def parse_count(text: Column | str) -> Column:
    """A whole number with or without thousands separators, else null."""
    plain = F.regexp_replace(F.regexp_replace(_col(text), ",", ""), rf"^{BLANK}+|{BLANK}+$", "")
    return F.when(plain.rlike("^[0-9]+$"), plain.try_cast("bigint"))


def content_hash(text: Column | str) -> Column:
    """``sha256:`` and the hash of the UTF-8 text."""
    return F.concat(F.lit("sha256:"), F.sha2(_col(text), 256))


def url_hash(url: Column | str) -> Column:
    return F.sha2(_col(url), 256)


def canonical_json(*fields: Column) -> Column:
    """A JSON object of the named fields, in their order, nulls written out; escapes in lower case."""
    return lower_escapes(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}))


def lower_escapes(json: Column) -> Column:
    """Control characters as ``\\u001f``, not ``\\u001F``."""
    fixed = json
    for digit in "ABCDEF":
        fixed = F.regexp_replace(fixed, rf"(?<!\\)((?:\\\\)*)\\u00([01]){digit}", rf"$1\\u00$2{digit.lower()}")
    return fixed


def percent_decode(text: Column | str) -> Column:
    """Percent escapes decoded as in paths: a plus sign stays; null for broken escapes."""
    return F.try_url_decode(F.regexp_replace(_col(text), r"\+", "%2B"))


def percent_encode(text: Column | str) -> Column:
    """As a component of an address: blanks as %20; ``!'()~*`` stay."""
    coded = F.regexp_replace(F.url_encode(_col(text)), r"\+", "%20")
    for escape, plain in (("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%7E", "~")):
        coded = F.regexp_replace(coded, escape, plain)
    return coded


def _group(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def id_from_href(href: Column | str, fallback: Column) -> Column:
    """The user, series or tag that a link leads to, else the link itself; ``fallback`` without a link."""
    h = _col(href)
    found = F.coalesce(_group(h, "^/users/([^/]+)"), _group(h, r"^/series/(\d+)"), _group(h, "^/tags/([^/]+)"))
    return F.when(F.coalesce(h, F.lit("")) == "", fallback).otherwise(F.coalesce(percent_decode(found), found, h))


def work_id_from_url(url: Column | str) -> Column:
    """The number in ``/works/<number>`` at the start of an address's path, else null."""
    return _group(_col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/works/(\d+)")


def url_origin(url: Column | str) -> Column:
    """Scheme, host and port; null for addresses that are neither https nor on this machine."""
    origin = F.lower(F.regexp_extract(_col(url), r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)", 1))
    return F.when(origin.rlike(r"^https://|^http://127\.0\.0\.1(:|$)"), origin)


def without_slash(url: Column | str) -> Column:
    return F.regexp_replace(_col(url), "/$", "")


def with_page(url: Column | str, page: Column | int) -> Column:
    """The address of a listing's page; the first page has no parameter."""
    u, p = _col(url), page if isinstance(page, Column) else F.lit(page)
    return F.when(p > 1, F.concat(u, F.when(F.instr(u, "?") > 0, "&").otherwise("?"), F.lit("page="), p.cast("string"))).otherwise(u)


def tag_works_url(origin: Column | str, slug: Column | str, page: Column | int) -> Column:
    return with_page(F.concat(_col(origin), F.lit("/tags/"), _col(slug), F.lit("/works")), page)


def full_work_url(origin: Column | str, work_id: Column | str, comments: bool = False) -> Column:
    """The address of a work with all chapters on one page."""
    return F.concat(_col(origin), F.lit("/works/"), _col(work_id), F.lit("?view_full_work=true&view_adult=true" + ("&show_comments=true" if comments else "")))


def language_code(name: Column | str) -> Column:
    codes = F.create_map(*[F.lit(x) for pair in LANGUAGE_CODES.items() for x in pair])
    return F.coalesce(F.try_element_at(codes, _col(name)), F.lit(DEFAULT_LANGUAGE))


def chapter_counts(stat: Column | str) -> tuple[Column, Column, Column]:
    """From ``3/7`` or ``3/?``: chapters there are, chapters expected (null for ``?``), whether all are there."""
    parts = F.split(compact(stat), "/")
    current, expected = parse_count(F.get(parts, F.lit(0))), parse_count(F.get(parts, F.lit(1)))
    return current, expected, F.coalesce(current == expected, F.lit(False))


def first_filled(*texts: Column | str) -> Column:
    """The first text that is neither null nor empty."""
    return F.coalesce(*[F.nullif(_col(t), F.lit("")) for t in texts])


def series_part(text: Column | str) -> Column:
    return F.coalesce(_group(_col(text), r"(?i)Part\s+(\d+)").try_cast("int"), F.lit(1))


def comment_id(element_id: Column | str) -> Column:
    return F.regexp_replace(_col(element_id), "^comment_", "")


def parent_comment_id(href: Column | str) -> Column:
    return _group(_col(href), r"/comments/(\d+)")


def composite_id(kind: str, *parts: Column | str) -> Column:
    return F.concat_ws(":", F.lit(kind), *[_col(p) for p in parts])


def is_anonymous(byline: Column | str) -> Column:
    return F.coalesce(_col(byline).rlike("(?i)anonymous"), F.lit(False))


def is_orphaned(byline: Column | str) -> Column:
    return F.coalesce(_col(byline).rlike("(?i)orphan_account"), F.lit(False))


def is_restricted_page(page: Column | str) -> Column:
    """Whether a page only says that the work is for registered users."""
    return F.coalesce(F.contains(_col(page), F.lit("This work is only available to registered users")), F.lit(False))


def spaced_words(name: Column | str) -> Column:
    """``camelCase`` and ``snake_case`` as words."""
    return F.regexp_replace(F.regexp_replace(_col(name), "([a-z])([A-Z])", "$1 $2"), "_", " ")


def byte_length(text: Column | str) -> Column:
    return F.octet_length(F.encode(_col(text), "UTF-8"))


def storage_key(digest: Column | str) -> Column:
    """Where the body with a hash (``sha256:`` or bare hex) is kept."""
    d = F.regexp_replace(_col(digest), "^sha256:", "")
    return F.concat_ws("/", F.lit("sha256"), F.substring(d, 1, 2), F.substring(d, 3, 2), F.concat(d, F.lit(".html.gz")))


def is_iso_date(text: Column | str) -> Column:
    t = _col(text)
    return F.coalesce(t.rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_date(t, "yyyy-MM-dd").isNotNull(), F.lit(False))


def is_iso_datetime(text: Column | str) -> Column:
    t = _col(text)
    return F.coalesce(t.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$") & F.try_to_timestamp(t).isNotNull(), F.lit(False))


def is_content_hash(text: Column | str) -> Column:
    return F.coalesce(_col(text).rlike("^sha256:[a-f0-9]{64}$"), F.lit(False))


def is_uuid(text: Column | str) -> Column:
    return F.coalesce(_col(text).rlike("^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"), F.lit(False))


def is_http_url(text: Column | str) -> Column:
    return F.coalesce(_col(text).rlike(r"^https?://[^\s/?#]+\S*$"), F.lit(False))


@F.pandas_udf(T.StringType())
def absolute_url(href: pd.Series, base: pd.Series) -> pd.Series:
    """A link resolved against the address of its page; null without a link."""
    return pd.Series([urljoin(b, h) if h else None for h, b in zip(href, base)], dtype=object)


class _Text(HTMLParser):
    """Text of a page, broken at blocks."""

    BLOCKS = {"p", "li", "blockquote", "h1", "h2", "h3", "h4"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[str] = []
        self.open: list[str] = []
        self.hidden = 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style")
        if tag in self.BLOCKS:
            self._close()

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style") and self.hidden > 0
        if tag in self.BLOCKS:
            self._close()

    def handle_data(self, data):
        if not self.hidden:
            self.open.append(data)

    def _close(self):
        text = " ".join("".join(self.open).split())
        if text:
            self.blocks.append(text)
        self.open = []


def _blocks(page: str | None) -> list[str]:
    reader = _Text()
    reader.feed(page or "")
    reader.close()
    reader._close()
    return reader.blocks


def stretches(texts: pa.Array, limit: int = STRETCH_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of an array of texts with about ``limit`` bytes each; one long text is whole."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield start, end
        start = end


def by_stretches(of: Callable, kind: pa.DataType) -> Callable[[Iterator[pa.Array]], Iterator[pa.Array]]:
    """A function over batches of texts that gives each text's ``of``. Texts are made Python's, read and handed on a stretch at a time, so a task
    needs the batch as Arrow holds it and a stretch's objects besides. Trees of elements refer to themselves: they are collected with their stretch."""

    def work(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for b in batches:
            for i, j in stretches(b):
                found = pa.array([of(t) for t in b.slice(i, j - i).to_pylist()], kind)
                gc.collect()
                yield found

    work.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return work


def _joined(page: str | None) -> str:
    return " ".join(_blocks(page))


def _unescaped(text: str | None) -> str | None:
    return None if text is None else html.unescape(text)


#: Texts of the paragraphs, list items, quotations and headings of pages, and all of them as one text.
html_paragraphs = F.arrow_udf(by_stretches(_blocks, pa.list_(pa.string())), T.ArrayType(T.StringType()))
html_text = F.arrow_udf(by_stretches(_joined, pa.string()), T.StringType())
unescape_html = F.arrow_udf(by_stretches(_unescaped, pa.string()), T.StringType())
