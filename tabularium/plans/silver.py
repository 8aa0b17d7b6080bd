"""The silver table: establishments with derived columns, dates and descriptions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabularium.functions.registry import branch_label, compact_date, full_id, status_label
from tabularium.layouts import (
    ACTIVITIES,
    COUNTRIES,
    DATE_FIELDS,
    DERIVED_AFTER,
    DOCUMENTED_CODES,
    DOCUMENTED_COLUMNS,
    ESTABLISHMENTS,
    MUNICIPALITIES,
    REASONS,
    SILVER_COLUMNS,
    Entity,
)
from tabularium.operators.counts import Counts
from tabularium.operators.filters import filter_activity
from tabularium.operators.loads import is_complete
from tabularium.operators.lookup import few_used, lookup
from tabularium.sources.archives import extract_archives, refuse_broken
from tabularium.sources.entities import read_entity
from tabularium.sources.files import list_files
from tabularium.sources.silver import publish_silver, write_silver


# The establishment field that holds a code table's codes.
CODE_COLUMNS = {
    REASONS: "cd_motivo_situacao_cadastral",
    ACTIVITIES: "cd_cnae_fiscal",
    COUNTRIES: "pais",
    MUNICIPALITIES: "municipio",
}


def derive(facts: DataFrame, dates: str = "legacy") -> DataFrame:
    """Add the id and the two labels, and turn the three compact dates into dates."""
    return facts.withColumns(
        {
            DERIVED_AFTER["cnpj_dv"]: full_id(
                F.col("cnpj_basico"), F.col("cnpj_ordem"), F.col("cnpj_dv")
            ),
            DERIVED_AFTER["cd_matriz_filial"]: branch_label(F.col("cd_matriz_filial")),
            DERIVED_AFTER["cd_situacao_cadastral"]: status_label(F.col("cd_situacao_cadastral")),
            **{name: compact_date(F.col(name), dates) for name in DATE_FIELDS},
        }
    )


def build_silver(
    facts: DataFrame,
    reasons: DataFrame,
    activities: DataFrame,
    countries: DataFrame | None = None,
    municipalities: DataFrame | None = None,
    only_activities: Iterable[str] | None = None,
    dates: str = "legacy",
    hot: Mapping[str, Iterable[str | None]] | None = None,
    counts: Counts | None = None,
) -> DataFrame:
    """The silver table: 35 columns, or the 37 documented ones with both further code tables.

    ``only_activities`` keeps the establishments with one of these main activities. ``hot`` is for
    code tables too large to broadcast: the codes, by column, that hold a large share of the rows.
    Rows without a code need not be named. ``counts`` (see ``silver_counts``) count the rows read; pass
    them to the writer as well.
    """
    if (countries is None) != (municipalities is None):
        raise ValueError("the documented layout needs both countries and municipalities")
    if counts is not None:
        facts = counts.read(facts)
    if only_activities is not None:
        facts = filter_activity(facts, only_activities)
    silver = derive(facts, dates)
    descriptions = [
        ("cd_motivo_situacao_cadastral", reasons, DERIVED_AFTER["cd_motivo_situacao_cadastral"]),
        ("cd_cnae_fiscal", activities, DERIVED_AFTER["cd_cnae_fiscal"]),
    ]
    columns = SILVER_COLUMNS
    if countries is not None:
        silver = silver.withColumnsRenamed(DOCUMENTED_CODES)
        descriptions += [
            (DOCUMENTED_CODES["pais"], countries, "pais"),
            (DOCUMENTED_CODES["municipio"], municipalities, "municipio"),
        ]
        columns = DOCUMENTED_COLUMNS
    for key, codes, label in descriptions:
        silver = lookup(silver, codes, key, label, hot=(hot or {}).get(key, ()))
    return silver.select(*columns)


def silver_counts(documented: bool = False) -> Counts:
    """Counters of a load of the silver table: rows read and written, and codes that no code table has."""
    labels = {code: DERIVED_AFTER[code] for code in ("cd_motivo_situacao_cadastral", "cd_cnae_fiscal")}
    if documented:
        labels |= {code: label for label, code in DOCUMENTED_CODES.items()}
    return Counts(labels)


def silver_entities(documented: bool = False) -> tuple[Entity, ...]:
    """What the silver table is made of."""
    further = (COUNTRIES, MUNICIPALITIES) if documented else ()
    return (ESTABLISHMENTS, REASONS, ACTIVITIES, *further)


def silver_from_folder(
    spark: SparkSession,
    root: str,
    documented: bool = False,
    encodings: Mapping[str, str] | None = None,
    escape: str = "\\",
    **options,
) -> DataFrame:
    """``build_silver`` over the entity folders below ``root``.

    No job runs but for code tables that are too large for Spark to broadcast: of one of more than ``FEW`` rows the codes
    in use are looked up first (see ``few_used``), so that the wide rows need not be shuffled.

    ``encodings``, by folder name, replace the entities' own; with ``auto`` that of each file is told by its bytes.
    """
    entities = silver_entities(documented)
    facts, *codes = (
        read_entity(spark, root, entity, (encodings or {}).get(entity.folder), escape=escape)
        for entity in entities
    )
    keys = [CODE_COLUMNS[entity] for entity in entities[1:]]
    codes = [few_used(facts, table, key) for table, key in zip(codes, keys, strict=True)]
    return build_silver(facts, *codes, **options)


def refresh_silver(
    spark: SparkSession,
    archives: str,
    extracted: str,
    silver: str,
    by: str | None = None,
    documented: bool = False,
    manifest: DataFrame | None = None,
    verify: bool = True,
    distinct: bool = False,
    retain: int | None = None,
    cluster: Iterable[str] = (),
    blooms: Iterable[str] = (),
    counts: str | None = None,
    **options,
) -> dict[str, int] | None:
    """Archives to silver table: extract, derive, enrich, write. Replaces both outputs.

    With a ``manifest`` nothing starts before all of its files have landed. Unless ``verify`` is false the archives
    are read through first, and if one is not whole nothing is replaced (``BrokenArchives``). With ``distinct``
    a member that an entity has twice is taken once.

    With ``retain`` the table is published by versions, of which so many are kept: readers have the one before
    until the new one is whole. ``by``, ``cluster`` and ``blooms`` lay it out as ``write_silver`` says. ``counts`` is the path of a
    table of the load's counts, which are gathered while the rows are written; they are also returned.
    """
    if manifest is not None and not is_complete(manifest, list_files(spark, archives)):
        raise FileNotFoundError(f"{archives} lacks files of the manifest")
    names = [entity.folder for entity in silver_entities(documented)]
    if verify:
        refuse_broken(spark, archives, names)
    extract_archives(spark, archives, extracted, names, distinct=distinct)
    return load_silver(
        spark, extracted, silver, documented, counts, retain, {"by": by, "cluster": cluster, "blooms": blooms}, **options
    )


def load_silver(
    spark: SparkSession,
    source: str,
    silver: str,
    documented: bool = False,
    counts: str | None = None,
    retain: int | None = None,
    layout: Mapping[str, object] | None = None,
    **options,
) -> dict[str, int] | None:
    """Entity folders below ``source`` to silver table; the last half of ``refresh_silver``."""
    counters = silver_counts(documented) if counts is not None else None
    table = silver_from_folder(spark, source, documented, counts=counters, **options)
    layout = {**(layout or {}), "counts": counters}
    if retain is None:
        write_silver(table, silver, **layout)
    else:
        publish_silver(table, silver, retain, **layout)
    if counters is None:
        return None
    counters.table(spark).write.mode("overwrite").parquet(counts)
    return counters.get()
