"""Page functions that need an HTML parser: Arrow UDFs over the standard library's."""

from __future__ import annotations

from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sievework.functions.text import col

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_OUTSIDE = {"script", "style", "nav", "footer", "aside", "header"}


class _Text(HTMLParser):
    """All text, and the text of the first main, article or role=main element, outside menus and scripts."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, bool]] = []
        self.all: list[str] = []
        self.main: list[str] = []
        self.body: list[str] = []
        self.found = False

    def handle_starttag(self, tag, attrs):
        if tag in _VOID:
            return
        skip = bool(self.open and self.open[-1][1]) or tag in _OUTSIDE
        inside = bool(self.open and self.open[-1][2])
        if not inside and not self.found and (tag in ("main", "article") or dict(attrs).get("role") == "main"):
            inside = self.found = True
        self.open.append((tag, skip, inside))

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        tag, skip, inside = self.open[-1] if self.open else ("", False, False)
        if tag not in ("script", "style"):
            self.all.append(data)
        if not skip:
            self.body.append(data)
            if inside:
                self.main.append(data)


def _read(html: str) -> _Text:
    parser = _Text()
    parser.feed(html)
    parser.close()
    return parser


def _joined(parts: list[str]) -> str:
    return " ".join(" ".join(parts).split())


class _Head(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.meta: dict[str, str] = {}

    def handle_starttag(self, tag, attrs):
        if tag == "meta":
            a = dict(attrs)
            name = a.get("property") or a.get("name")
            if name and a.get("content"):
                self.meta.setdefault(name.lower(), a["content"].strip())


@F.arrow_udf(StringType())
def _plain(column: pa.Array) -> pa.Array:
    return pa.array([_joined(_read(x.as_py()).all) if x.as_py() else "" for x in column], pa.string())


@F.arrow_udf(StringType())
def _main(column: pa.Array) -> pa.Array:
    out = []
    for x in column:
        parser = _read(x.as_py() or "")
        out.append(_joined(parser.main or parser.body))
    return pa.array(out, pa.string())


@F.arrow_udf(StructType([StructField("og_title", StringType()), StructField("image_url", StringType())]))
def _meta(html: pa.Array, url: pa.Array) -> pa.Array:
    titles, images = [], []
    for h, u in zip(html, url, strict=True):
        head = _Head()
        head.feed(h.as_py() or "")
        image = head.meta.get("og:image") or head.meta.get("twitter:image")
        titles.append(head.meta.get("og:title"))
        images.append(urljoin(u.as_py() or "", image) if image else None)
    return pa.StructArray.from_arrays([pa.array(titles, pa.string()), pa.array(images, pa.string())], ["og_title", "image_url"])


def _clipped(text: Column, most: int, ellipsis: bool) -> Column:
    end = F.concat(F.left(text, F.lit(most - 3)), F.lit("...")) if ellipsis else F.left(text, F.lit(most))
    return F.when(F.length(text) > most, end).otherwise(text)


def html_to_text(html: Column | str, max_chars: int = 2000, ellipsis: bool = False) -> Column:
    """a page's text with white space collapsed, clipped."""
    return _clipped(_plain(col(html)), max_chars, ellipsis)


def main_content(html: Column | str, max_chars: int | None = None) -> Column:
    """the whole text of the main element, or else of the body, without menus and scripts; clipped only if the caller sets ``max_chars``."""
    text = _main(col(html))
    return text if max_chars is None else _clipped(text, max_chars, False)


def page_meta(html: Column | str, url: Column | str) -> Column:
    """(og_title, image_url), the image's address made absolute."""
    return _meta(col(html), col(url))


def register_html_udfs(spark: SparkSession) -> None:
    """The page functions by name, for SQL."""
    spark.udf.register("html_plain_text", _plain)
    spark.udf.register("html_main_text", _main)
    spark.udf.register("html_page_meta", _meta)
