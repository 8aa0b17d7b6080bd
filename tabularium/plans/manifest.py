"""From saved listing pages to the files to download."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from tabularium.layouts import WANTED_ENTITIES
from tabularium.operators.filters import wanted_files
from tabularium.operators.listings import extract_links, latest_snapshot


def build_manifest(
    index_pages: DataFrame,
    snapshot_pages: DataFrame,
    base: str | Column,
    entities: Iterable[str] = WANTED_ENTITIES,
    by: Iterable[str] = (),
) -> DataFrame:
    """The wanted files of the newest snapshot: ``snapshot_url``, ``href``, ``url``, ``file_name``.

    ``index_pages`` (``html``) list the snapshots below ``base``; however many are saved, of one month or
    several, the newest snapshot on any of them counts, or with ``by`` the newest for each value of these
    columns, such as sites; ``base`` may be an expression over them. ``snapshot_pages`` (``url``, ``html``)
    are the saved pages of snapshots. Links are taken from the pages before the newest
    ones are chosen, so that links are joined and page texts are never shuffled.
    """
    by = list(by)
    dated = latest_snapshot(index_pages.select(*by, "html"), base)
    choice = F.max_by("snapshot_url", F.struct("snapshot", "snapshot_url"))
    newest = dated.where("snapshot is not null").groupBy(*by).agg(choice.alias("snapshot_url"))
    newest = newest.select("snapshot_url").distinct()
    pages = snapshot_pages.select(F.col("url").alias("snapshot_url"), "html")
    links = wanted_files(extract_links(pages).drop("pos"), F.col("snapshot_url"), entities)
    return links.join(newest, "snapshot_url", "left_semi")
