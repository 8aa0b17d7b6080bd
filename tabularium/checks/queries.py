"""One query per operator. Each runs over whole tables and is lazy but for the files it first lays
down.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabularium.checks import inputs
from tabularium.checks.scratch import new_folder
from tabularium.functions import (
    branch_label,
    compact_date,
    entity_name,
    file_name,
    full_id,
    status_label,
)
from tabularium.layouts import ACTIVITIES, ESTABLISHMENT, ESTABLISHMENTS, REASONS
from tabularium.operators import (
    extract_links,
    filter_activity,
    hot_codes,
    latest_snapshot,
    lookup,
    missing_files,
    newest_link,
    used_codes,
    wanted_files,
)
from tabularium.plans import (
    CODE_COLUMNS,
    build_manifest,
    build_silver,
    load_silver,
    refresh_silver,
    silver_from_folder,
)
from tabularium.sources import (
    archived_lines,
    archived_rows,
    check_archives,
    extract_archives,
    publish_silver,
    read_checked,
    read_delimited,
    read_entity,
    read_members,
    read_mixed,
    read_pages,
    read_silver,
    write_checked,
    write_silver,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

CHOSEN_ACTIVITIES = ("0000004", "0000100", "0001777")
COUNTED_ACTIVITIES = ("0000000", "0000004", "0000100", "0001777", "0002499")
INDEX_BASE = "https://h/"


def query(build: Query) -> Query:
    """Register under the function's name; a trailing underscore sets it apart from an operator."""
    QUERIES[build.__name__.rstrip("_")] = build
    return build


def _facts(spark: SparkSession, sf_dir: str, *fields: str) -> DataFrame:
    return inputs.in_spark(spark, sf_dir, inputs.establishments_sql(*fields))


# Whole pipelines


@query
def flagship_silver(spark, sf_dir):
    return silver_from_folder(spark, inputs.raw_folder(spark, sf_dir))


@query
def silver_documented(spark, sf_dir):
    return silver_from_folder(spark, inputs.raw_folder(spark, sf_dir), documented=True)


def _silver_over(spark, sf_dir, prepare, **options):
    """The documented silver table with each code table prepared for its lookup."""
    root = inputs.raw_folder(spark, sf_dir)
    facts = read_entity(spark, root, ESTABLISHMENTS)
    codes = [
        prepare(facts, read_entity(spark, root, entity), column) for entity, column in CODE_COLUMNS.items()
    ]
    return build_silver(facts, *codes, **options)


@query
def silver_cut_codes(spark, sf_dir):
    return _silver_over(spark, sf_dir, used_codes)


@query
def silver_shuffled_codes(spark, sf_dir):
    hot = {"cd_pais": ["000", None], "cd_motivo_situacao_cadastral": ["01"]}
    return _silver_over(spark, sf_dir, lambda facts, codes, key: codes.hint("merge"), hot=hot)


@query
def silver_filtered(spark, sf_dir):
    return silver_from_folder(
        spark, inputs.raw_folder(spark, sf_dir), only_activities=CHOSEN_ACTIVITIES
    )


@query
def archive_to_silver(spark, sf_dir):
    silver = new_folder(spark, "silver_from_archives")
    extracted = new_folder(spark, "extracted")
    refresh_silver(spark, inputs.archive_folder(spark, sf_dir), extracted, silver)
    return spark.read.parquet(silver)


# Sources and sinks


@query
def csv_fact_read(spark, sf_dir):
    return read_entity(spark, inputs.raw_folder(spark, sf_dir), ESTABLISHMENTS)


@query
def csv_code_table(spark, sf_dir):
    return read_entity(spark, inputs.raw_folder(spark, sf_dir), REASONS)


@query
def csv_code_table_latin1(spark, sf_dir):
    return read_entity(spark, inputs.raw_folder(spark, sf_dir), ACTIVITIES)


@query
def csv_multi_file(spark, sf_dir):
    root = inputs.split_folder(spark, sf_dir)
    return read_delimited(spark, [f"{root}/head", f"{root}/rest"], ESTABLISHMENT)


@query
def csv_permissive_int(spark, sf_dir):
    facts = read_entity(spark, inputs.raw_folder(spark, sf_dir), ESTABLISHMENTS)
    return facts.select("cep", "cd_matriz_filial", "numero")


@query
def parquet_overwrite(spark, sf_dir):
    path = new_folder(spark, "silver")
    facts = read_entity(spark, inputs.raw_folder(spark, sf_dir), ESTABLISHMENTS)
    write_silver(facts.select("cep", "uf"), path)
    write_silver(facts, path)
    return spark.read.parquet(path)


@query
def parquet_by_state(spark, sf_dir):
    path = new_folder(spark, "silver_by_state")
    write_silver(flagship_silver(spark, sf_dir), path, by="uf")
    return read_silver(spark, path)


@query
def parquet_by_code(spark, sf_dir):
    path = new_folder(spark, "silver_by_code")
    write_silver(flagship_silver(spark, sf_dir), path, by="cd_situacao_cadastral")
    return read_silver(spark, path)


@query
def parquet_publish(spark, sf_dir):
    path = new_folder(spark, "silver_published")
    silver = flagship_silver(spark, sf_dir)
    publish_silver(silver.where("uf = 'BA'"), path)
    publish_silver(silver, path, by="uf")
    return read_silver(spark, path)


@query
def silver_pruned(spark, sf_dir):
    path = new_folder(spark, "silver_clustered")
    write_silver(flagship_silver(spark, sf_dir), path, by="uf", cluster=["cd_cnae_fiscal"], blooms=["cep"])
    return read_silver(spark, path).where(F.col("uf") == "SP").where(F.col("cd_cnae_fiscal").between("0000100", "0000400"))


@query
def silver_counts(spark, sf_dir):
    path, counts = new_folder(spark, "silver_counted"), new_folder(spark, "counts")
    only = {"only_activities": COUNTED_ACTIVITIES}
    load_silver(spark, inputs.raw_folder(spark, sf_dir), path, documented=True, counts=counts, **only)
    return spark.read.parquet(counts)


@query
def archive_integrity(spark, sf_dir):
    return check_archives(spark, inputs.fragile_folder(spark, sf_dir)).drop("archive")


@query
def archive_distinct(spark, sf_dir):
    members = read_members(spark, inputs.repeated_folder(spark, sf_dir), [ESTABLISHMENTS.folder, REASONS.folder], distinct=True)
    return archived_lines(members).select("entity", "line")


@query
def csv_mixed_encodings(spark, sf_dir):
    return read_mixed(spark, inputs.mixed_folder(spark, sf_dir), ACTIVITIES.schema, recursive=True)


@query
def csv_rejects(spark, sf_dir):
    path = new_folder(spark, "checked")
    schema = inputs.PLANTED_SCHEMA
    write_checked(read_checked(spark, inputs.planted_folder(spark, sf_dir), schema), path, schema)
    rows = spark.read.parquet(path)
    return rows.select(*schema.names, "line", F.array_join("faults", ",").alias("faults"), F.col("faulty").cast("boolean"))


@query
def archive_expand(spark, sf_dir):
    folder = inputs.archive_folder(spark, sf_dir)
    tables = [
        archived_rows(spark, folder, entity).select(F.lit(entity.folder).alias("entity"), "*")
        for entity in (REASONS, ACTIVITIES)
    ]
    return tables[0].unionByName(tables[1])


@query
def archive_extract(spark, sf_dir):
    extracted = new_folder(spark, "extracted_all")
    extract_archives(spark, inputs.archive_folder(spark, sf_dir), extracted)
    # Bytes are kept, so each entity's text is still in its encoding.
    latin1 = F.col("entity") == ACTIVITIES.folder
    decoded = F.decode(F.col("value").cast("binary"), ACTIVITIES.encoding)
    value = F.when(latin1, decoded).otherwise(F.col("value"))
    return spark.read.text(extracted).select("entity", value.alias("value"))


@query
def row_count(spark, sf_dir):
    facts = read_entity(spark, inputs.raw_folder(spark, sf_dir), ESTABLISHMENTS)
    return facts.agg(F.count("*").alias("n"))


@query
def preview(spark, sf_dir):
    facts = read_entity(spark, inputs.raw_folder(spark, sf_dir), ESTABLISHMENTS)
    return facts.orderBy("cep").limit(20)


# Column expressions


@query
def full_id_(spark, sf_dir):
    facts = _facts(spark, sf_dir, "id", "cnpj_basico", "cnpj_ordem", "cnpj_dv")
    parts = (F.col(c) for c in ("cnpj_basico", "cnpj_ordem", "cnpj_dv"))
    return facts.select("id", full_id(*parts).alias("cnpj"))


@query
def branch_label_(spark, sf_dir):
    facts = _facts(spark, sf_dir, "id", "cd_matriz_filial")
    return facts.withColumn("matriz_filial", branch_label(F.col("cd_matriz_filial")))


@query
def status_label_(spark, sf_dir):
    facts = _facts(spark, sf_dir, "id", "cd_situacao_cadastral")
    return facts.withColumn("situacao_cadastral", status_label(F.col("cd_situacao_cadastral")))


def _dates(spark, sf_dir, mode):
    names = ("data_situacao_cadastral", "data_inicio_atividades", "data_situacao_especial")
    facts = _facts(spark, sf_dir, "id", *names)
    return facts.withColumns({name: compact_date(F.col(name), mode) for name in names})


@query
def date_parse_legacy(spark, sf_dir):
    return _dates(spark, sf_dir, "legacy")


@query
def date_parse_strict(spark, sf_dir):
    return _dates(spark, sf_dir, "strict")


@query
def date_parse_ragged(spark, sf_dir):
    ragged = inputs.in_spark(spark, sf_dir, inputs.RAGGED_DATES_SQL)
    return ragged.select(
        "id",
        compact_date(F.col("s")).alias("legacy"),
        compact_date(F.col("s"), "strict").alias("strict"),
    )


# Lookups and filters


@query
def lookup_reason(spark, sf_dir):
    facts = _facts(spark, sf_dir, "id", "cd_motivo_situacao_cadastral")
    reasons = inputs.in_spark(spark, sf_dir, inputs.REASONS_SQL)
    return lookup(facts, reasons, "cd_motivo_situacao_cadastral", "motivo_situacao_cadastral")


@query
def lookup_activity(spark, sf_dir):
    facts = _facts(spark, sf_dir, "id", "cd_cnae_fiscal")
    activities = inputs.in_spark(spark, sf_dir, inputs.ACTIVITIES_SQL)
    return lookup(facts, activities, "cd_cnae_fiscal", "cnae_fiscal")


@query
def lookup_fanout(spark, sf_dir):
    facts = _facts(spark, sf_dir, "id", "cd_motivo_situacao_cadastral")
    reasons = inputs.in_spark(spark, sf_dir, inputs.REASONS_SQL)
    twice = reasons.unionAll(reasons)
    return lookup(facts, twice, "cd_motivo_situacao_cadastral", "motivo_situacao_cadastral")


@query
def lookup_country(spark, sf_dir):
    facts = _facts(spark, sf_dir, "id", "pais").withColumnRenamed("pais", "cd_pais")
    countries = inputs.in_spark(spark, sf_dir, inputs.COUNTRIES_SQL)
    return lookup(facts, countries, "cd_pais", "pais")


@query
def lookup_municipality(spark, sf_dir):
    facts = _facts(spark, sf_dir, "id", "municipio").withColumnRenamed("municipio", "cd_municipio")
    municipalities = inputs.in_spark(spark, sf_dir, inputs.MUNICIPALITIES_SQL)
    return lookup(facts, municipalities, "cd_municipio", "municipio")


@query
def lookup_hot_code(spark, sf_dir):
    facts = _facts(spark, sf_dir, "id", "pais").withColumnRenamed("pais", "cd_pais")
    countries = inputs.in_spark(spark, sf_dir, inputs.COUNTRIES_SQL)
    hot = hot_codes(facts, "cd_pais", 0.01)
    return lookup(facts, countries.hint("merge"), "cd_pais", "pais", hot=hot)


@query
def filter_activity_(spark, sf_dir):
    facts = read_entity(spark, inputs.raw_folder(spark, sf_dir), ESTABLISHMENTS)
    return filter_activity(facts, CHOSEN_ACTIVITIES)


# Listings and loads


@query
def extract_links_(spark, sf_dir):
    return extract_links(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html"))


@query
def latest_snapshot_(spark, sf_dir):
    pages = inputs.in_spark(spark, sf_dir, inputs.INDEX_PAGES_SQL)
    return latest_snapshot(inputs.spread(pages), INDEX_BASE)


@query
def read_pages_(spark, sf_dir):
    pages = read_pages(spark, inputs.page_folder(spark, sf_dir), "*.html")
    page_id = F.regexp_extract("path", r"(\d+)\.html$", 1).cast("long")
    return pages.select(page_id.alias("page_id"), "html")


@query
def newest_link_by_site(spark, sf_dir):
    return newest_link(inputs.in_spark(spark, sf_dir, inputs.SITE_LINKS_SQL), INDEX_BASE, "site")


@query
def manifest_filter(spark, sf_dir):
    return wanted_files(inputs.in_spark(spark, sf_dir, inputs.LINKS_SQL), INDEX_BASE)


@query
def listing_to_manifest(spark, sf_dir):
    return build_manifest(
        inputs.spread(inputs.in_spark(spark, sf_dir, inputs.SITE_PAGES_SQL)),
        inputs.spread(inputs.in_spark(spark, sf_dir, inputs.SNAPSHOT_PAGES_SQL)),
        F.concat(F.lit(INDEX_BASE), F.col("site").cast("string"), F.lit("/")),
        by=["site"],
    )


@query
def file_name_entity(spark, sf_dir):
    links = inputs.in_spark(spark, sf_dir, inputs.LINKS_SQL)
    name = file_name(F.concat(F.lit(INDEX_BASE), F.col("href")))
    return links.select(
        "link_id", name.alias("file_name"), entity_name(name).alias("entity")
    )


@query
def load_completeness(spark, sf_dir):
    manifest = inputs.in_spark(spark, sf_dir, inputs.ORDERED_FILES_SQL)
    return missing_files(manifest, inputs.in_spark(spark, sf_dir, inputs.SHIPPED_FILES_SQL))
