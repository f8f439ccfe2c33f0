"""Attribute values from stored web pages."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


class _Found(Exception):
    pass


class _FirstTag(HTMLParser):
    def __init__(self, tag: str, where: str, value: str | None):
        super().__init__()
        self.wanted = (tag, where, value)
        self.attributes: dict[str, str | None] = {}

    def handle_starttag(self, tag, attrs):
        wanted_tag, where, value = self.wanted
        if tag != wanted_tag:
            return
        found = dict(reversed(attrs))
        if where not in found:
            return
        held = found[where] or ""
        names = held.split()
        if value is None or held == value or (where == "class" and (value in names or value == " ".join(names))):
            self.attributes = found
            raise _Found


def first_attribute(html: str | None, tag: str, where: str, value: str | None, attribute: str) -> str | None:
    """``attribute`` of the first ``tag`` whose ``where`` has ``value`` (any, if
    None); None when there is no such tag. A class value matches one of the
    classes or all of them together."""
    if html is None:
        return None
    page = _FirstTag(tag, where, value)
    try:
        page.feed(html)
        page.close()
    except _Found:
        return page.attributes.get(attribute)
    return None


def extract_attribute(html: Column, tag: str, where: str, value: str | Column | None, attribute: str) -> Column:
    """``first_attribute`` over a column; ``value`` may be a column too."""
    if isinstance(value, Column):

        @F.pandas_udf("string")
        def by_row(pages: pd.Series, values: pd.Series) -> pd.Series:
            return pd.Series(
                [
                    None if v is None else first_attribute(p, tag, where, v, attribute)
                    for p, v in zip(pages, values)
                ],
                dtype=object,
            )

        return by_row(html, value)

    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        return pd.Series([first_attribute(p, tag, where, value, attribute) for p in pages], dtype=object)

    return run(html)
