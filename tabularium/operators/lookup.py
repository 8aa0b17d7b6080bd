"""Left lookup of a description by code."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

_SLICE = "__slice"
#: Code rows that are broadcast in place of a shuffle of the facts.
FEW = 100_000


def lookup(
    facts: DataFrame,
    codes: DataFrame,
    key: str,
    label: str,
    hot: Iterable[str | None] = (),
    slices: int = 256,
) -> DataFrame:
    """All columns of ``facts`` plus the ``descricao`` of ``codes`` as ``label``.

    No match or a NULL key gives a NULL label; a code listed twice gives two rows.

    No join hint is set: Spark broadcasts ``codes`` when its size estimate is under the
    session's threshold, and otherwise shuffles. For the shuffled case rows with a NULL key, which
    match nothing, are spread over ``slices`` join keys, and so are those of the codes in ``hot``, which
    hold a large share of ``facts`` (see ``hot_codes``); only the few hot rows of ``codes`` are repeated.
    """
    hot = [code for code in dict.fromkeys(hot) if code is not None]
    described = codes.select(F.col("codigo").alias(key), F.col("descricao").alias(label))
    # Content and input partition give each row a slice that a retried task gives it again.
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *facts.columns), F.lit(slices)).cast("int")
    is_spread = F.col(key).isNull() | _is_one_of(F.col(key), hot)
    sliced = facts.withColumn(_SLICE, F.when(is_spread, spread).otherwise(F.lit(0)))
    every_slice = F.sequence(F.lit(0), F.lit(slices - 1))
    # An array even without hot codes: as a constant, the slice would be no join key.
    repeated = described.withColumn(
        _SLICE,
        F.explode(F.when(_is_one_of(F.col(key), hot), every_slice).otherwise(F.array(F.lit(0)))),
    )
    return sliced.join(repeated, [key, _SLICE], "left").select(*facts.columns, label)


def _is_one_of(code: Column, values: list[str]) -> Column:
    return F.coalesce(code.isin(values), F.lit(False))


def hot_codes(facts: DataFrame, key: str, share: float = 0.01) -> list[str | None]:
    """The codes, None for NULL, that hold about ``share`` of the rows or more.

    One aggregate over one column with a mergeable sketch, so nothing is shuffled by key, and the
    answer has at most ``1 / share`` codes. It is an estimate, and it only steers how rows are
    spread; the result of the lookup does not depend on it. The sketch's size bounds ``share``: it is
    from 0.0001 to 1.
    """
    if not 1e-4 <= share <= 1:
        raise ValueError(f"share must be from 0.0001 to 1, not {share}")
    most = max(1, round(1 / share))
    sketch = F.expr(f"approx_top_k(`{key}`, {most}, {min(1_000_000, most * 100)})")
    total, top = facts.agg(F.count("*"), sketch).first()
    return [item for item, rows in top or () if rows >= share * total]


def used_codes(facts: DataFrame, codes: DataFrame, key: str) -> DataFrame:
    """The rows of ``codes`` whose code occurs in ``facts``; all a lookup needs.

    For a large code table of which few codes are in use. It reads one column of ``facts`` once more, and
    shuffles distinct keys only, one per task and key.
    """
    used = facts.select(F.col(key).alias("codigo")).distinct()
    return codes.join(used, "codigo", "left_semi")


def few_used(facts: DataFrame, codes: DataFrame, key: str, few: int = FEW) -> DataFrame:
    """``codes`` as they are, or of a table of more than ``few`` rows only the used ones, to be broadcast, if these are few.

    A lookup in a large table shuffles whole rows of ``facts``; where they use few of its codes, shuffling distinct
    keys is enough. What is found comes to the driver, as what is broadcast does, and stays as it was at this
    time. No job runs for a table that Spark broadcasts by its size; of others rows are counted, as far as ``few``.
    """
    state = facts.sparkSession._jsparkSession.sessionState()
    size = codes._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if size <= state.conf().autoBroadcastJoinThreshold() or codes.limit(few + 1).count() <= few:
        return codes
    found = used_codes(facts, codes, key).limit(few + 1).collect()
    return F.broadcast(facts.sparkSession.createDataFrame(found, codes.schema)) if len(found) <= few else codes
