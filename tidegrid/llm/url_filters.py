"""URL filter (operator 3): a trie over reversed host labels, then path segments.

A rule is (host, path prefix, verdict). It fits its host and all subdomains when the
url's path starts with the rule's path. The deepest fitting rule wins: the longest
host, and under one host the longest path. The trie is built on the driver from the
caller's list and shipped to the tasks; MAX_RULES bounds its size.

Defined cases: a null url or one without '://' has an empty host and path, fits no rule
and gets the default verdict; so does an empty table nothing. Equal rules given twice
must agree, otherwise ValueError. Repeated rows are judged one by one; columns other
than the key and the url are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm.common import map_rows, scan

ALLOW, BLOCK = "allow", "block"
MAX_RULES = 1_000_000
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


# Fixed values of the registered query.
RULES = (
    Rule("com", "/", ALLOW),
    Rule("example.com", "/en/", BLOCK),
    Rule("www.example.com", "/en/", ALLOW),
    Rule("net", "/es/", BLOCK),
    Rule("net", "/fr/", BLOCK),
)


class Node:
    """A host label or path segment; `ends` holds rules whose last segment is a prefix."""

    __slots__ = ("labels", "segments", "ends")

    def __init__(self) -> None:
        self.labels: dict[str, Node] = {}
        self.segments: dict[str, Node] = {}
        self.ends: dict[str, tuple[str, str]] = {}


def build(rules: tuple[Rule, ...]) -> Node:
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; the broadcast trie is bounded to {MAX_RULES}")
    root = Node()
    for rule in rules:
        node = root
        for label in reversed(rule.host.translate(LOWER).split(".")):
            node = node.labels.setdefault(label, Node())
        *whole, last = rule.path.split("/")
        for segment in whole:
            node = node.segments.setdefault(segment, Node())
        if node.ends.setdefault(last, (rule.name, rule.verdict)) != (rule.name, rule.verdict):
            raise ValueError(f"two verdicts for {rule.name}")
    return root


def longest_path(node: Node, segments: list[str]) -> tuple[str, str] | None:
    best, depth = None, 0
    while True:
        segment = segments[depth] if depth < len(segments) else None
        if segment is None:
            return best
        fits = [end for end in node.ends if segment.startswith(end)]
        if fits:
            best = node.ends[max(fits, key=len)]
        # a further '/' must follow for the segment to be a whole one
        node = node.segments.get(segment) if depth + 1 < len(segments) else None
        if node is None:
            return best
        depth += 1


def longest_rule(root: Node, host: str, path: str) -> tuple[str, str] | None:
    """(rule name, verdict) of the deepest rule that fits, or None."""
    best, node, segments = None, root, path.split("/")
    for label in reversed(host.split(".")):
        node = node.labels.get(label)
        if node is None:
            break
        best = longest_path(node, segments) or best
    return best


def parts(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path, without query and fragment."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = min(k for k in (rest.find("?"), rest.find("#"), len(rest)) if k >= 0)
    host, slash, path = rest[:end].partition("/")
    return host.translate(LOWER), slash + path


def filter_urls(pages: DataFrame, key: str, url: str, rules: tuple[Rule, ...], default: str = ALLOW) -> DataFrame:
    """One row per page: key, host, path, rule, verdict."""
    root = pages.sparkSession.sparkContext.broadcast(build(rules))
    dtype = pages.schema[key].dataType

    def make():
        trie = root.value

        def judge(columns):
            keys, urls = columns
            split = [parts(u) for u in urls.to_pylist()]
            found = [longest_rule(trie, host, path) or (None, default) for host, path in split]
            return [keys, [h for h, _ in split], [p for _, p in split], [r for r, _ in found], [v for _, v in found]]

        return judge

    from pyspark.sql.pandas.types import to_arrow_type

    arrow = pa.schema([(key, to_arrow_type(dtype)), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()), ("verdict", pa.string())])
    schema = f"`{key}` {dtype.simpleString()}, host string, path string, rule string, verdict string"
    return map_rows(pages.select(F.col(key), F.col(url).cast("string")), make, schema, arrow)


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(scan(spark, sf_dir, "pages"), "page_id", "url", RULES)


ORACLE = r"""
WITH split AS (
  SELECT page_id,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest
  FROM pages
), cut AS (
  SELECT page_id, coalesce(regexp_extract(rest, '^([^?#]*)', 1), '') AS body FROM split
), p AS (
  SELECT page_id,
         translate(regexp_extract(body, '^([^/]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         substr(body, length(regexp_extract(body, '^([^/]*)', 1)) + 1) AS path
  FROM cut
), r AS (
  SELECT page_id, host, path,
    CASE
      WHEN ('.' || host) LIKE '%.www.example.com' AND path LIKE '/en/%' THEN 'www.example.com/en/'
      WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/en/%' THEN 'example.com/en/'
      WHEN ('.' || host) LIKE '%.com' AND path LIKE '/%' THEN 'com/'
      WHEN ('.' || host) LIKE '%.net' AND path LIKE '/es/%' THEN 'net/es/'
      WHEN ('.' || host) LIKE '%.net' AND path LIKE '/fr/%' THEN 'net/fr/'
    END AS rule
  FROM p
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""
