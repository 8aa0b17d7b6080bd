"""Row filters. All are plain predicates, so Spark pushes them towards the scan."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from tabularium.functions.links import file_name
from tabularium.layouts import ARCHIVE_SUFFIX, DENTAL_ACTIVITIES, WANTED_ENTITIES


def filter_activity(facts: DataFrame, codes: Iterable[str] = DENTAL_ACTIVITIES) -> DataFrame:
    """Establishments whose main activity is one of ``codes``; dental clinics by default.

    Secondary activities do not count.
    """
    return facts.filter(F.col("cd_cnae_fiscal").isin(list(codes)))


def is_wanted(link: Column, entities: Iterable[str] = WANTED_ENTITIES) -> Column:
    """Whether a link is an archive (exact-case suffix) of an entity (in any case)."""
    lowered = F.lower(link)
    named = reduce(or_, (lowered.contains(e) for e in entities), F.lit(False))
    return link.endswith(ARCHIVE_SUFFIX) & named


def wanted_files(
    links: DataFrame, base: str | Column, entities: Iterable[str] = WANTED_ENTITIES
) -> DataFrame:
    """The links to download, with their ``url`` (``base`` put before the href) and ``file_name``.
    """
    prefix = F.lit(base) if isinstance(base, str) else base
    url = F.concat(prefix, F.col("href"))
    return links.filter(is_wanted(F.col("href"), entities)).withColumns(
        {"url": url, "file_name": file_name(url)}
    )
