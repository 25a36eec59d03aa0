"""Exact text of an HTML fragment (H4): needs a tokenizer, so it is an Arrow UDF over the standard library."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from weirgate import constants as C


class _Text(HTMLParser):
    """Collect character data outside script and style; entities are decoded once by the tokenizer."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.hidden = False

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.hidden = True

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.hidden = False

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)


def fragment_text(value: str | None, maximum: int) -> str | None:
    """Visible text of one fragment, white space collapsed, cut and right-trimmed."""
    if value is None:
        return None
    text = value
    if "<" in value or "&" in value:
        parser = _Text()
        parser.feed(value)
        parser.close()
        text = "".join(parser.parts)
    return " ".join(text.split())[:maximum].rstrip()


def sanitize_html(value: Column, maximum: int | None = C.ARTICLE_TEXT_MAX) -> Column:
    """Visible text of an HTML fragment; the whole text without ``maximum``."""

    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda item: fragment_text(item, maximum))

    return F.pandas_udf(run, T.StringType())(value)
