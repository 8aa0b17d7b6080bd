"""Connected components of links, by alternating star steps.

A link joins ``a < b``. With ``least(b)``, the smallest partner below ``b``, each round turns links so
that they point at smaller ids: first ``(a, b)`` to ``(least(a), b)``, then ``(a, b)`` to
``(a, least(b))`` and ``(b, least(b))``. Components stay as they are, and after a number of rounds
that grows with the logarithm of the graph (squared, at worst) every component is a star around its
smallest id. Nothing but two numbers per round comes to the driver; links of a hot id are split
over tasks, as both sides of the joins are read from tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabularium.llm.tables import keep, release


def _turned(links: DataFrame) -> DataFrame:
    """Links as distinct ``a < b``, without loops."""
    return links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _fingerprint(links: DataFrame) -> tuple:
    mark = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(links.agg(F.count(F.lit(1)), mark).first())


def _least(links: DataFrame) -> DataFrame:
    return keep(links.groupBy(F.col("b").alias("of")).agg(F.min("a").alias("least")), "least")


def components(links: DataFrame) -> DataFrame:
    """``id, component`` for the ids of ``a, b`` links; the component is its smallest id.

    Links with a null end, loops and repeated links change nothing.
    """
    found = keep(_turned(links.where("a is not null and b is not null").select("a", "b")), "links")
    before = _fingerprint(found)
    while True:
        least = _least(found)
        large = found.join(least, F.col("a") == F.col("of"), "left").select(
            F.coalesce("least", "a").alias("a"), "b"
        )
        old, found = (found, least), keep(_turned(large), "links")
        release(*old)
        least = _least(found)
        below = found.join(least, F.col("b") == F.col("of")).select("a", F.col("least").alias("b"))
        small = below.unionAll(least.select("least", "of"))
        old, found = (found, least), keep(_turned(small), "links")
        release(*old)
        after = _fingerprint(found)
        if after == before:
            break
        before = after
    ends = found.select(F.col("b").alias("id"), F.col("a").alias("component"))
    return ends.unionAll(found.select("a", "a").distinct())
