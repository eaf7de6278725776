"""HTML to text in Arrow batches."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Elements that an empty line parts from what is before and after them.
BLOCKS = frozenset({"p", "div", "section", "article", "li", "h1", "h2", "h3", "h4", "h5", "h6", "pre"})
#: Rows in an Arrow batch: long pages make large batches.
ARROW_ROWS = 256
#: What is not text: comments, declarations, elements whose content is no markup, and tags with quoted values.
MARKUP = re.compile(
    r"<!--.*?--\s*>|<[!?][^>]*>"
    r"|<(?P<raw>script|style)\b[^>]*>(?P<inside>.*?)(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/>]*)(?:\"[^\"]*\"|'[^']*'|[^>\"'])*>",
    re.I | re.S,
)
#: References that end without a semicolon, before another character.
OPEN_REFERENCE = re.compile(r"&([a-z][-.a-z0-9]*(?![-.a-z0-9;])|#(?:[0-9]+|x[0-9a-f]+)(?![0-9a-f;]))(?=.)", re.I | re.S)


def _shown(m: re.Match) -> str:
    if m["raw"]:
        return m["inside"]
    name = (m["name"] or "").lower()
    if name in BLOCKS:
        return "\n\n"
    return "\n" if name == "br" and not m["end"] else ""


def _pieces(html: str) -> Iterator[str]:
    """Text with closed references, and what markup is shown as."""
    at = 0
    for m in MARKUP.finditer(html):
        yield OPEN_REFERENCE.sub(r"&\1;", html[at : m.start()] + "<")[:-1]
        yield _shown(m)
        at = m.end()
    yield OPEN_REFERENCE.sub(r"&\1;", html[at:])


def strip_html(html: str | None) -> str:
    """Text of markup; references are resolved once, runs of blanks are one, and at most one line stays empty."""
    lines = re.split(r"\r\n|\r|\n", unescape("".join(_pieces(html or ""))))
    return re.sub(r"\n{3,}", "\n\n", "\n".join(re.sub(r"[ \t]+", " ", line) for line in lines)).strip()


def _freed() -> None:
    """Gives freed memory back to the system, as workers are kept for later tasks."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc only
        trim(0)


def html_text(column: Column, times: int = 1) -> Column:
    """times: feeds strip twice, as escaped markup shows after the first time. Whole pages are sent, so the session's Arrow
    batches are bounded to ARROW_ROWS."""
    conf = SparkSession.active().conf
    if not 0 < int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= ARROW_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))

    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in parts:
            for _ in range(times):
                x = x.map(strip_html)
            yield x
        _freed()

    return run(column)
