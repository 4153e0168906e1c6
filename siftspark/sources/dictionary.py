"""Dictionary pages: HTML to (attribute, link) rows."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftspark.functions import after_dot

# Workers get this module's functions with the task, so they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Markup of the attribute list on a dictionary page.
LIST_CLASS = "list-group"
ITEM_CLASS = "list-group-item"
TOOLTIP_CLASS = "mytip"


class _Links(HTMLParser):
    """Collects (href, text) of anchors inside ul > li, tooltips left out."""

    def __init__(self, list_class: str | None, item_class: str | None):
        super().__init__(convert_charrefs=True)
        self.wanted = {"ul": list_class, "li": item_class}
        self.open = {"ul": [], "li": []}  # per tag: does each open element match?
        self.href: str | None = None
        self.text: list[str] = []
        self.links: list[tuple[str, str]] = []

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        classes = (attrs.get("class") or "").split()
        if tag in self.open:
            self.open[tag].append(self.wanted[tag] is None or self.wanted[tag] in classes)
        elif tag == "a" and any(self.open["ul"]) and any(self.open["li"]):
            if "href" in attrs and TOOLTIP_CLASS not in classes:
                self.href, self.text = attrs["href"] or "", []

    def handle_data(self, data):
        if self.href is not None:
            self.text.append(data)

    def handle_endtag(self, tag):
        if tag in self.open and self.open[tag]:
            self.open[tag].pop()
        elif tag == "a" and self.href is not None:
            self.links.append((self.href, "".join(self.text)))
            self.href = None


def dictionary_links(
    pages: DataFrame,
    html: str = "html",
    list_class: str | None = LIST_CLASS,
    item_class: str | None = ITEM_CLASS,
) -> DataFrame:
    """Links of the attribute lists: the page's other columns + (ordinal, item, attribute, link).

    `item` is the anchor text, `attribute` the part of it after the dot.
    """
    kept = [f for f in pages.schema.fields if f.name != html]
    link = T.StructType().add("link", "string").add("item", "string")
    schema = T.StructType(list(kept)).add("_links", T.ArrayType(link))

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for page in batch.pop(html):
                parser = _Links(list_class, item_class)
                parser.feed(page or "")
                found.append([{"link": h, "item": t} for h, t in parser.links])
            batch["_links"] = found
            yield batch

    names = [f.name for f in kept]
    return (
        pages.mapInPandas(extract, schema)
        .select(*names, F.posexplode("_links").alias("ordinal", "_link"))
        .select(
            *names,
            "ordinal",
            "_link.item",
            after_dot(F.col("_link.item")).alias("attribute"),
            "_link.link",
        )
    )


def page_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """Every href on a page; a JVM-side scan for pages by the billion."""
    kept = [c for c in pages.columns if c != html]
    return pages.select(
        *kept,
        F.explode(F.regexp_extract_all(html, F.lit('href="([^"]*)"'), F.lit(1))).alias("link"),
    )
