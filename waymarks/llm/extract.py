"""Main text of web pages by a site style tree.

The pages of a host are merged: elements with the same path (tags, classes, ids and roles, digits
masked) are one node of the tree.  A node has a distribution of presentations (the sequence of its
children's tags) and of contents (the text of its branch).  With ``n`` pages that have the node, its
importance is ``(1 - weight) * presentation + weight * content``, where each is the entropy of the
distribution over ``log n``: 0 if all pages agree, 1 if no two do.  Branches of low importance are
removed from each page of the host, but for one that has a page's article element and most of its
text in it.  Every block
element is a node, down to paragraphs and list items.  A page that a host has several times is one
page of the tree.  The counts are Spark aggregates over (host, path, value), so a host may have any
number of pages.

HTML itself says more, as a further check: navigation, footers, asides, forms, scripts, and elements
named or hidden as such, surround the article whatever their entropy.  If a page has ``article``
elements, their text is the text; else that of ``main``; else the body's.

Defined results: NULL or empty html has the empty text.  A NULL or odd url has the empty host, whose
pages are not merged.  Hosts with fewer than ``least_pages`` different pages of a node keep it.  Rows
with one page_id are extracted each.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymarks.llm.dom import Reader
from waymarks.llm.stored import stored

NODES = "host string, page bigint, path bigint, presentation bigint, content bigint"
TEXTS = "page_id bigint, url string, text string"


def host_of(url: Column | str) -> Column:
    """Lower-case host without user and port; empty if there is none."""
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.lower(F.coalesce(found, F.lit("")))


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reader = Reader()
    for batch in batches:
        host, page, path, looks, content = [], [], [], [], []
        pages = zip(batch["host"].to_pylist(), batch["page"].to_pylist(), batch["html"])
        for of, number, html in pages:
            seen = set()
            for at, children, text in reader.read(html.as_py()).contents():
                if at not in seen:  # one count for a page
                    seen.add(at)
                    host.append(of)
                    page.append(number)
                    path.append(at)
                    looks.append(_hash(children))
                    content.append(text)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(host, pa.string()),
                *(pa.array(x, pa.int64()) for x in (page, path, looks, content)),
            ],
            ["host", "page", "path", "presentation", "content"],
        )


def _entropy(nodes: DataFrame, value: str) -> DataFrame:
    """(host, path, pages, entropy of ``value`` over log pages)."""
    counts = nodes.groupBy("host", "path", value).count()
    sums = counts.groupBy("host", "path").agg(
        F.sum("count").alias("pages"),
        F.sum(F.col("count") * F.log("count")).alias("s"),
    )
    n = F.col("pages")
    share = (F.log(n) - F.col("s") / n) / F.log(n)
    return sums.select("host", "path", "pages", F.when(n > 1, share).otherwise(1.0).alias(value))


def importance(pages: DataFrame, weight: float = 0.9) -> DataFrame:
    """(host, path, pages, presentation, content, importance) of the nodes of each host's tree."""
    rows = pages.select(host_of("url").alias("host"), "html").where("host <> ''")
    # Equal pages of a host meet as hashes of their nodes: what a page says of a path comes once.
    page = F.xxhash64("html")
    nodes = rows.withColumn("page", page).mapInArrow(_nodes, NODES)
    nodes = stored(nodes.distinct().drop("page"), "nodes")
    looks, content = _entropy(nodes, "presentation"), _entropy(nodes, "content").drop("pages")
    both = looks.join(content, ["host", "path"])
    value = (1 - weight) * F.col("presentation") + weight * F.col("content")
    return both.withColumn("importance", value)


def extract(
    pages: DataFrame, threshold: float = 0.2, least_pages: int = 4, weight: float = 0.9
) -> DataFrame:
    """page_id, url and ``text`` of every row."""
    nodes = importance(pages, weight)
    low = nodes.where((F.col("importance") < threshold) & (F.col("pages") >= least_pages))
    # Nodes of a host's templates; the written table tells Spark its size before it plans the join.
    low = stored(low.groupBy("host").agg(F.collect_set("path").alias("low")), "low")
    rows = pages.select(F.col("page_id").cast("bigint"), "url", "html", host_of("url").alias("host"))
    rows = rows.join(low, "host", "left").select("page_id", "url", "html", "low")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            texts = [
                reader.read(html.as_py()).text(frozenset(gone.as_py() or ()))
                for html, gone in zip(batch["html"], batch["low"])
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array(texts, pa.string())],
                ["page_id", "url", "text"],
            )

    return rows.mapInArrow(run, TEXTS)
