"""HTML extraction by consensus host paths.

Each page scores its containers by the text they hold outside links, leaving out menus, notices,
adverts and the like, and votes for the path of the one that holds the whole article. Paths are general:
tags and classes, digits left out. Spark counts the votes per host; every page is then extracted again with
its host's winning path. A page without such a container, or without text in it, uses its own best one.

Votes are counted before they are shuffled, so a host of any size sends one row per path and task.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import join_small
from fleetpulse.llm.pagetext import Page


def _votes(batches):
    for batch in batches:
        paths, chars = [], []
        for source in batch.column(1):
            path, held = Page(source.as_py() or "").best()
            paths.append(path)
            chars.append(held)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(paths, pa.string()), pa.array(chars, pa.int64())], ["host", "path", "chars"])


def _texts(batches):
    for batch in batches:
        texts = []
        for source, path in zip(batch.column("html"), batch.column("path")):
            page = Page(source.as_py() or "")
            text = page.text(path.as_py()) if path.is_valid else None
            texts.append(text or page.text(page.best()[0]))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def host_of(url):
    """The host of a URL in lower case, without port; empty if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def winning_paths(pages: DataFrame) -> DataFrame:
    """(host, path): the path with most votes, then most text, then the first in order."""
    counted = pages.select("host", "html").mapInArrow(_votes, "host string, path string, chars bigint").filter("chars > 0")
    counted = counted.groupBy("host", "path").agg(F.count("*").alias("_votes"), F.sum("chars").alias("_chars"))
    best = F.min_by("path", F.struct(-F.col("_votes"), -F.col("_chars"), F.col("path")))
    return counted.groupBy(F.col("host").alias("_host")).agg(best.alias("path"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The main text of every page: (page_id, url, text, n_chars).

    Null or empty html, or html without text, gives an empty text. Pages without a host vote
    together. Repeated rows are extracted each time and vote each time; an empty table gives no
    row; further columns are ignored.
    """
    own = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
        host_of(F.col(url_col).cast("string")).alias("host"),
    )
    joined = join_small(own, winning_paths(own), F.col("host") == F.col("_host"), "left", "paths")
    kind = dict(own.dtypes)["page_id"]
    texts = joined.select("page_id", "url", "html", "path").mapInArrow(_texts, f"page_id {kind}, url string, text string")
    return texts.select("*", F.length("text").cast("bigint").alias("n_chars"))
