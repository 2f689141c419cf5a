"""The main text of web pages, by the template that pages of one host share.

Tokens of a page are its elements, known by their paths, and the texts of its blocks with theirs. A token's occurrence
vector over the host's pages is summed up as its number of pages and one hash, which combines in any order, so a host with
many pages is no single task. Tokens with equal vectors form a class. A class is valid if it is on at least LEAST_PAGES pages
and holds an element; its paths put it inside the elements of other classes, which nests the classes to the template.
Texts of a valid class belong to the template, as they come with its elements and never change. The slots that remain hold the
pages' own text. Of them the main one is taken: the article that most text of the host stands in, else the main element, else
the container that most text stands in or just below.

A page's text is that of its blocks in the main slot, without menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles and comments (known by their elements, roles and class names) and without the template's texts. A page that
lacks its host's main slot, or whose host has too few pages for a template or mostly copies of a page, is read by the same rules from itself.

A NULL html is empty, and an empty or text-free page has an empty text. Pages without a host have no template. Equal rows are pages of their own;
NULL and repeated page_ids do no harm. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from zlib import crc32

from tablespan.llm.markup import Page, read_page
from tablespan.llm.registry import query, read
from tablespan.sources.shared import kept

LEAST_PAGES = 10  # of a host with a template, and of a class
BROADCAST_TOKENS = 200_000  # of all templates together, that are sent to every task
BATCH_BYTES = 4 << 20  # of text in a batch that goes back to Spark
PAGE, ELEMENT, TEXT = range(3)

_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
_TOKENS = pa.schema(
    [("host", pa.string()), ("kind", pa.int32()), ("token", pa.int64()), ("vector", pa.int64()), ("weight", pa.float64()), ("region", pa.int32())]
)


def _text_token(path: int, text: str) -> int:
    data = text.encode("utf-8", "surrogatepass")
    return hash((path, crc32(data), crc32(data[::-1]), len(data)))


def _weights(page: Page) -> Counter:
    """How much text stands in each path: all of a region's, and a share that halves with each container."""
    weights: Counter = Counter()
    for block in page.blocks:
        own = len(block.text) - block.linked
        if block.region:
            weights[block.region] += own
        else:
            for k, path in enumerate(block.containers):
                weights[path] += own / 2**k
    return weights


def _page_tokens(host: str, row: int, html: str) -> Iterator[tuple]:
    page = read_page(html)
    data = html.encode("utf-8", "surrogatepass")
    yield host, PAGE, hash((crc32(data), crc32(data[::-1]), len(data))), 0, 0.0, 0
    weights = _weights(page)
    for path, n in page.elements.items():
        yield host, ELEMENT, path, hash((row, n)), float(weights[path]), page.regions.get(path, 0)
    for token, n in Counter(_text_token(b.path, b.text) for b in page.blocks).items():
        yield host, TEXT, token, hash((row, n)), 0.0, 0


def tokens(pages: DataFrame) -> DataFrame:
    """(host, kind, token, pages, vector, weight, region): tokens with their occurrence vectors; rare texts are left out."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for given in batches:
            out: list[tuple] = []
            for host, html in zip(given.column("host").to_pylist(), given.column("html"), strict=True):
                row += 1
                out += _page_tokens(host, row, html.as_py() or "")
                if len(out) > 20_000:
                    yield _batch(out, _TOKENS)
                    out = []
            yield _batch(out, _TOKENS)

    rows = pages.filter("host IS NOT NULL").select("host", "html")
    found = rows.mapInArrow(parse, "host string, kind int, token long, vector long, weight double, region int")
    summed = found.groupBy("host", "kind", "token").agg(
        F.count("*").alias("pages"), F.bit_xor("vector").alias("vector"), F.sum("weight").alias("weight"), F.max("region").alias("region")
    )
    return summed.filter((F.col("kind") != TEXT) | (F.col("pages") >= LEAST_PAGES))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def templates(found: DataFrame) -> DataFrame:
    """(host, mains, texts): paths of main slots and tokens of template texts, from `tokens`.

    A host's tokens are on a fixed share of its pages, so a template is about as long as a page.
    """
    hosts = found.filter(F.col("kind") == PAGE).groupBy("host").agg(F.sum("pages").alias("all_pages"), F.count("*").alias("contents"))
    hosts = hosts.filter((F.col("all_pages") >= LEAST_PAGES) & (2 * F.col("contents") >= F.col("all_pages")))
    elements = found.filter((F.col("kind") == ELEMENT) & (F.col("pages") >= LEAST_PAGES)).join(hosts, "host").filter(2 * F.col("pages") >= F.col("all_pages"))
    best = elements.filter("weight > 0").groupBy("host").agg(F.max(F.struct("region", "weight", "token")).alias("best"))
    classes = elements.select("host", "pages", "vector").distinct()
    texts = found.filter(F.col("kind") == TEXT).join(classes, ["host", "pages", "vector"], "left_semi")
    fixed = texts.groupBy("host").agg(F.collect_list("token").alias("texts"))
    none = F.array().cast("array<long>")
    return best.join(fixed, "host", "left").select("host", F.array("best.token").alias("mains"), F.coalesce("texts", none).alias("texts"))


def main_text(html: str, mains: frozenset[int], texts: frozenset[int]) -> str:
    """The text of a page's main slot; without one among `mains`, of the one that the page itself shows."""
    page = read_page(html, mains)
    blocks = [b for b in page.blocks if not texts or _text_token(b.path, b.text) not in texts]
    taken = [b for b in blocks if b.inside]
    if not taken:
        weights = _weights(page)
        ranked = max(((page.regions.get(path, 0), weight, path) for path, weight in weights.items() if weight > 0), default=None)
        if ranked is None:
            return ""
        again = {(b.path, b.text) for b in blocks}
        taken = [b for b in read_page(html, frozenset([ranked[2]])).blocks if b.inside and (b.path, b.text) in again]
    return "\n\n".join(b.text for b in taken)


def extracted(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every page."""
    host = F.lower(F.regexp_extract(F.col("url").cast("string"), _HOST, 1))
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.when(host != "", host).alias("host"), F.col("html").cast("string").alias("html"))
    made = kept(spark, templates(kept(spark, tokens(rows))))
    size = made.agg(F.sum(F.size("texts") + 2)).first()[0] or 0
    made = made.withColumnRenamed("host", "of_host")
    joined = rows.join(F.broadcast(made) if size <= BROADCAST_TOKENS else made, F.col("host") == F.col("of_host"), "left")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in batches:
            sets: dict = {}  # of the hosts in this batch
            begin, size, out = 0, 0, []
            hosts, mains, texts = given.column("host").to_pylist(), given.column("mains"), given.column("texts")
            for i, html in enumerate(given.column("html")):
                if hosts[i] not in sets:
                    sets[hosts[i]] = frozenset(mains[i].as_py() or ()), frozenset(texts[i].as_py() or ())
                out.append(main_text(html.as_py() or "", *sets[hosts[i]]))
                size += len(out[-1])
                if size > BATCH_BYTES or i + 1 == given.num_rows:
                    part = given.slice(begin, len(out))
                    yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(out, pa.string())], names=["page_id", "url", "text"])
                    begin, size, out = i + 1, 0, []

    kind = pages.schema["page_id"].dataType.simpleString()
    return joined.select("page_id", "url", "html", "host", "mains", "texts").mapInArrow(extract, f"page_id {kind}, url string, text string")


@query()
def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(spark, read(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
