"""Feeds as a Spark data source: a partition a feed; a feed that fails is a row with its error, the others go on."""

from __future__ import annotations

import hashlib
import json
import re
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from datetime import datetime, timezone
from email.utils import parsedate_to_datetime
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.html import strip_html
from ..operators.durable import kept

ITEM = "feed string, item_key string, url string, title string, author string, published string, text string, content_sha256 string, error string"
FEED = "key string, kind string, url string, view string, query string, limit int"
TRIES, WAIT, MOST_WAIT, TIMEOUT = 3, 5, 60, 30


def fetch(request: urllib.request.Request | str) -> str:
    """The body of a response. Asks again when the server is busy, after as long as it says."""
    delay = WAIT
    for n in range(TRIES):
        try:
            with urllib.request.urlopen(request, timeout=TIMEOUT) as r:
                return r.read().decode("utf-8", errors="replace")
        except urllib.error.HTTPError as e:
            if e.code not in (429, 503) or n == TRIES - 1:
                raise
            said = e.headers.get("Retry-After", "") if e.headers else ""
            time.sleep(min(MOST_WAIT, int(said) if said.isdigit() else delay))
            delay = min(15, delay * 3)
    raise RuntimeError("no answer")


def parse_time(value: str | None) -> datetime:
    """ISO or mail dates, UTC if they name no zone; now if there is none."""
    text = (value or "").strip()
    for read in (lambda s: datetime.fromisoformat(s.removesuffix("Z") + ("+00:00" if s.endswith("Z") else "")), parsedate_to_datetime):
        try:
            found = read(text)
            return (found if found.tzinfo else found.replace(tzinfo=timezone.utc)).astimezone(timezone.utc)
        except (ValueError, TypeError, IndexError):
            continue
    return datetime.now(timezone.utc)


def item(feed: str, key: str, url: str, title: str, author: str, published: datetime, body: str) -> tuple:
    text = strip_html(body)
    return (feed, key or hashlib.sha256(f"{feed}::{url}::{title}".encode()).hexdigest(), url, title, author, published.replace(microsecond=0).isoformat(), text, hashlib.sha256(text.encode()).hexdigest(), None)


def _named(node: ElementTree.Element, *names: str) -> Iterator[ElementTree.Element]:
    """Children, and then all below, whose local name is one of names, in the order of names."""
    for pool in (list(node), list(node.iter())[1:]):
        for name in names:
            yield from (x for x in pool if x.tag.rpartition("}")[2] == name)


def _text(node: ElementTree.Element, *names: str) -> str:
    return next((t for x in _named(node, *names) if (t := " ".join("".join(x.itertext()).split()))), "")


def _link(node: ElementTree.Element) -> str:
    return next((v for x in _named(node, "link") if (v := x.get("href") or (x.text or "").strip())), "")


def graphql(feed: dict, get: Callable) -> Iterator[tuple]:
    query = f'{{posts(input:{{terms:{{view:"{feed.get("view") or "new"}",limit:{feed.get("limit") or 20}}}}}){{results{{title pageUrl postedAt htmlBody user{{displayName}}}}}}}}'
    body = json.loads(get(urllib.request.Request(feed["url"], json.dumps({"query": query}).encode(), {"Content-Type": "application/json"}, method="POST")))
    results = ((body.get("data") or {}).get("posts") or {}).get("results")
    for r in (results if isinstance(results, list) else [])[: feed.get("limit") or 20]:
        yield item(feed["key"], r.get("pageUrl") or "", r.get("pageUrl") or "", r.get("title") or "", (r.get("user") or {}).get("displayName") or "", parse_time(r.get("postedAt")), strip_html(r.get("htmlBody")))


def atom(feed: dict, get: Callable) -> Iterator[tuple]:
    limit = feed.get("limit") or 20
    root = ElementTree.fromstring(get(feed.get("url") or f"http://export.arxiv.org/api/query?search_query={feed.get('query') or ''}&sortBy=submittedDate&max_results={limit}"))
    for e in [x for x in root.iter() if x.tag.rpartition("}")[2] == "entry"][:limit]:
        title = _text(e, "title")
        yield item(feed["key"], _text(e, "id"), _text(e, "id"), title, _text(e, "name"), parse_time(_text(e, "published", "updated")), f"{title}\n\n{strip_html(_text(e, 'summary'))}")


def rss(feed: dict, get: Callable) -> Iterator[tuple]:
    root = ElementTree.fromstring(get(feed["url"]))
    found = [x for x in root.iter() if x.tag.rpartition("}")[2] in ("item", "entry")]
    for e in found[: max(0, 20 if feed.get("limit") is None else feed["limit"])]:
        body = next((t for x in _named(e, "encoded", "content", "description", "summary") if (t := "".join(x.itertext()).strip())), "".join(e.itertext()))
        yield item(feed["key"], _text(e, "guid", "id") or _link(e), _link(e), _text(e, "title"), _text(e, "creator", "author", "name"), parse_time(_text(e, "pubDate", "published", "updated", "date")), strip_html(body))


KINDS = {"graphql-forum": graphql, "arxiv": atom, "rss": rss}


class _Feed(InputPartition):
    def __init__(self, config: dict):
        self.config = config


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.feeds, self.since = json.loads(options.get("feeds", "[]")), options.get("since", "")
        self.canned = json.loads(options.get("bodies", "{}"))

    def partitions(self):
        return [_Feed(f) for f in self.feeds] or [_Feed({})]

    def read(self, part):
        feed = part.config
        if not feed:
            return
        canned = self.canned.get(feed.get("key"))
        try:
            if feed.get("kind") not in KINDS:
                raise ValueError(f"unknown kind {feed.get('kind')}")
            for row in KINDS[feed["kind"]](feed, (lambda _: canned) if canned is not None else fetch):
                if row[5] >= self.since:
                    yield row
        except Exception as e:  # a feed's failure is its own warning
            yield (feed.get("key"), *[None] * 7, f"{feed.get('key')}: {e}")


class FeedSource(DataSource):
    """Options: feeds (JSON list of configs), since, and bodies (JSON of key to response, in place of the network)."""

    @classmethod
    def name(cls) -> str:
        return "feeds"

    def schema(self) -> str:
        return ITEM

    def reader(self, schema):
        return _Reader(dict(self.options))


def read_feeds(spark: SparkSession, feeds: list[dict], since: str = "", bodies: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(items, warnings). Every feed is fetched once: what was read is kept before the two are parted."""
    spark.dataSource.register(FeedSource)
    rows = spark.read.format("feeds").option("feeds", json.dumps(feeds)).option("since", since).option("bodies", json.dumps(bodies or {})).load()
    rows = kept(rows)
    return rows.where(F.col("error").isNull()).drop("error"), rows.where(F.col("error").isNotNull()).select(F.col("error").alias("warning"))


def feed_configs(path: str) -> list[dict]:
    """Configs of a YAML file of a list of flat mappings under `feeds:`; none if there is no file."""
    try:
        with open(path) as f:
            lines = f.read().splitlines()
    except FileNotFoundError:
        return []
    out: list[dict] = []
    for line in lines:
        m = re.match(r"^\s*(-\s+)?(\w+):\s*(.*?)\s*(?:#.*)?$", line)
        if not m or m[2] == "feeds" and not m[3]:
            continue
        if m[1]:
            out.append({})
        if out:
            value = m[3].strip("\"'")
            out[-1][m[2]] = int(value) if value.isdigit() else value
    return out
