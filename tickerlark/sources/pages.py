"""Raw HTML pages as rows.

Markup is often malformed, so the pages are read by the standard library's tolerant parser
inside Arrow batches; everything that is not markup stays in DataFrame expressions.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlark.functions import text as tx
from tickerlark.schema import ENGAGEMENT, require

# --- fixed values: marks of the fields of a post in the markup ---------------
AUTHOR_MARK, TEXT_MARK = "User-Name", "tweetText"
MOBILE_AUTHOR, MOBILE_TEXT = ("username", "user"), ("tweet-text", "status-text")
COUNT_MARKS = {"reply": 0, "retweet": 1, "like": 2, "view": 3}
VOID_TAGS = {"br", "img", "hr", "meta", "link", "input", "source", "wbr"}

# Pages whose results one Python worker holds at once.
PAGES_AT_ONCE = 64

PAGE_FIELDS = ["title", "article", "links"]
POST_FIELDS = ["author", "text", "time", *ENGAGEMENT]


class _Reader(HTMLParser):
    """Collects page facts and the posts marked up in a page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, str | None]] = []
        self.page = {"title": [], "article": []}
        self.links = 0
        self.posts: list[dict] = []

    def _field(self, tag: str, attrs: dict) -> str | None:
        mark = attrs.get("data-testid") or ""
        classes = attrs.get("class") or ""
        if mark == AUTHOR_MARK or tag == "a" and any(c in classes for c in MOBILE_AUTHOR):
            return "author"
        if mark == TEXT_MARK or tag == "div" and any(c in classes for c in MOBILE_TEXT):
            return "text"
        if tag == "time":
            return "time"
        counted = [name for name in COUNT_MARKS if name in mark]
        return f"count:{counted[0]}" if counted else None

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        self.links += tag == "a" and "href" in attrs
        field = self._field(tag, attrs)
        if field and (not self.posts or field in self.posts[-1]):
            self.posts.append({})
        if field:
            given = attrs.get("datetime") if field == "time" else None
            self.posts[-1][field] = given or ""
            field = None if given else field
        if tag not in VOID_TAGS:
            self.open.append((tag, field))

    def handle_endtag(self, tag):
        names = [name for name, _ in self.open]
        if tag in names:
            del self.open[len(names) - 1 - names[::-1].index(tag):]

    def handle_data(self, data):
        tags = {name for name, _ in self.open}
        if tags & {"script", "style"}:
            return
        for place in self.page.keys() & tags:
            self.page[place].append(data)
        for field in {f for _, f in self.open if f}:
            self.posts[-1][field] = self.posts[-1].get(field, "") + data


def _read(markup: str) -> _Reader:
    reader = _Reader()
    reader.feed(markup or "")
    reader.close()
    return reader


def _count(post: dict, name: str) -> int:
    shown = post.get(f"count:{name}", "").strip()
    return int(shown) if shown.isdecimal() else 0


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A batch holds thousands of pages; few of them are parsed, and their results held, at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, PAGES_AT_ONCE):
            yield _parsed(batch.slice(start, PAGES_AT_ONCE))


def _parsed(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = []
    for page_id, url, markup in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        page = _read(markup)
        posts = [
            {"author": p.get("author"), "text": p.get("text"), "time": p.get("time"), "counts": [_count(p, n) for n in COUNT_MARKS]}
            for p in page.posts
        ]
        title, article = "".join(page.page["title"]), "".join(page.page["article"])
        rows.append((page_id, url, title, article, page.links, posts))
    columns = list(zip(*rows)) or [()] * len(_KINDS)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS.values())], names=list(_KINDS))


_POST = pa.struct([("author", pa.string()), ("text", pa.string()), ("time", pa.string()), ("counts", pa.list_(pa.int64()))])
_KINDS = {"page_id": pa.int64(), "url": pa.string(), "title": pa.string(), "article": pa.string(), "links": pa.int64(), "posts": pa.list_(_POST)}
_PARSED = (
    "page_id bigint, url string, title string, article string, links bigint, "
    "posts array<struct<author:string,text:string,time:string,counts:array<bigint>>>"
)


def parse_pages(pages: DataFrame) -> DataFrame:
    """Title, article text, link count and marked-up posts of each page."""
    return require(pages, "page_id", "url", "html").select("page_id", "url", "html").mapInArrow(
        _parse, _PARSED
    )


def page_articles(pages: DataFrame) -> DataFrame:
    """One row per page with an article: url, title, text, number of links."""
    parsed = parse_pages(pages)
    return parsed.select(
        "page_id",
        "url",
        tx.collapse_whitespace(F.col("title")).alias("title"),
        tx.collapse_whitespace(F.col("article")).alias("content"),
        "links",
    ).filter(F.col("content") != "")


def pages_to_posts(
    pages: DataFrame, ref_ts, post_url: str = "https://twitter.com/"
) -> DataFrame:
    """Posts marked up in pages; those without author or text are dropped. The url of a post is
    ``post_url``, its author and its id."""
    now = F.lit(ref_ts).cast("timestamp")
    post = parse_pages(pages).select("page_id", F.inline("posts"))
    author = F.replace(F.trim("author"), F.lit("@"), F.lit(""))
    text = tx.collapse_whitespace(F.col("text"))
    text = F.regexp_replace(text, rf"https://t\.co/[{tx.WORD}]+", "")
    text = F.trim(F.regexp_replace(text, rf"pic\.twitter\.com/[{tx.WORD}]+", ""))
    counts = {c: F.get("counts", F.lit(i)) for i, c in enumerate(ENGAGEMENT)}
    rows = post.filter(F.col("author").isNotNull() & F.col("text").isNotNull()).select(
        author.alias("username"),
        author.alias("display_name"),
        tx.parse_relative_timestamp(F.col("time"), now).alias("post_ts"),
        text.alias("content"),
        *[c.alias(name) for name, c in counts.items()],
    )
    key = F.concat_ws("_", "username", F.unix_seconds("post_ts"))
    return rows.select(
        key.alias("id"),
        "*",
        tx.extract_tags(F.col("content"), "#").alias("hashtags"),
        tx.extract_tags(F.col("content"), "@").alias("mentions"),
        F.concat(F.lit(post_url), "username", F.lit("/status/"), key).alias("url"),
        F.lit(False).alias("is_retweet"),
        F.lit("en").alias("language"),
    )
