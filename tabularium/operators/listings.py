"""Operators over listing pages: one row per page, with its text in ``html``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabularium.functions.links import hrefs, month_text, snapshot_month
from tabularium.layouts import SNAPSHOT_PATTERN


def extract_links(pages: DataFrame) -> DataFrame:
    """One row per anchor with an href: the page's columns but ``html``, ``pos`` and ``href``."""
    kept = [c for c in pages.columns if c != "html"]
    return pages.select(*kept, F.posexplode(hrefs(F.col("html"))).alias("pos", "href"))


def latest_snapshot(pages: DataFrame, base: str | Column) -> DataFrame:
    """Each page's newest ``YYYY-MM`` link, as ``snapshot`` (its month) and ``snapshot_url``.

    Of equally new links the first on the page counts; links with an impossible month
    do not. A page without such a link has NULLs. The maximum is taken inside the row, so no
    shuffle is needed and no page's links are spread over rows.
    """
    kept = [c for c in pages.columns if c != "html"]
    # Months compare as text. Links without anything like one are dropped before they are ranked; one
    # with an impossible month is empty there and loses to all others.
    ranked = F.transform(
        F.filter(hrefs(F.col("html")), lambda href: href.rlike(SNAPSHOT_PATTERN)),
        lambda href, pos: F.struct(
            month_text(href).alias("__month"), (-pos).alias("__rank"), href.alias("__href")
        ),
    )
    # As the output of a generator the scan of the page is not repeated in filters on the result.
    newest = pages.select(*kept, F.inline_outer(F.array(F.array_max(ranked))))
    prefix = F.lit(base) if isinstance(base, str) else base
    return newest.select(
        *kept,
        F.concat("__month", F.lit("-01")).try_cast("date").alias("snapshot"),
        F.when(F.col("__month") != "", F.concat(prefix, "__href")).alias("snapshot_url"),
    )


def newest_link(links: DataFrame, base: str, *by: str) -> DataFrame:
    """The newest ``YYYY-MM`` link per ``by``, over links that are rows (``pos``, ``href``).

    The same choice as ``latest_snapshot``, for listings of many pages; a key without such a link has
    NULLs as well. Spark keeps one link per key and task before it shuffles, so a site with very many
    links costs no more than others.
    """
    dated = links.withColumn("snapshot", snapshot_month(F.col("href")))
    # A maximum leaves out rows whose order is NULL, as it is without a month.
    order = F.when(F.col("snapshot").isNotNull(), F.struct("snapshot", -F.col("pos")))
    newest = dated.groupBy(*by).agg(
        F.max_by(F.struct("snapshot", "href"), order).alias("newest")
    )
    return newest.select(
        *by,
        F.col("newest.snapshot").alias("snapshot"),
        F.concat(F.lit(base), F.col("newest.href")).alias("snapshot_url"),
    )
