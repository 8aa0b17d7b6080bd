"""The whole chain: listing to manifest, archives to silver table; and the plans Spark makes of it.
"""

import datetime
import re
import zipfile

import pytest
from pyspark.sql import functions as F
from tabularium.__main__ import main
from tabularium.layouts import (
    ACTIVITIES,
    DOCUMENTED_COLUMNS,
    ESTABLISHMENT_FIELDS,
    ESTABLISHMENTS,
    REASONS,
    SILVER_COLUMNS,
)
from tabularium.operators import used_codes
from tabularium.plans import build_silver, refresh_silver, silver_from_folder
from tabularium.checks import inputs
from tabularium.checks.queries import QUERIES
from tabularium.sources import read_entity, read_silver, write_silver

SF_DIR = "/root/testdata/sf0.001"

CLINIC = dict.fromkeys(ESTABLISHMENT_FIELDS, "") | {
    "cnpj_basico": "32998915",
    "cnpj_ordem": "0001",
    "cnpj_dv": "80",
    "cd_matriz_filial": "1",
    "nome_fantasia": "CLINICA SORRISO",
    "cd_situacao_cadastral": "02",
    "data_situacao_cadastral": "20190218",
    "cd_motivo_situacao_cadastral": "00",
    "nome_cidade_exterior": "LISBOA",
    "pais": "105",
    "data_inicio_atividades": "20190218",
    "cd_cnae_fiscal": "8630504",
    "cd_cnae_fiscal_secundario": "0151202",
    "numero": "55",
    "uf": "BA",
    "municipio": "3597",
    "data_situacao_especial": "20190218",
}
SHOP = CLINIC | {"cnpj_ordem": "0002", "cd_cnae_fiscal": "4711302", "cd_matriz_filial": "2"}
TABLES = {
    "Motivos": [("00", "SEM MOTIVO")],
    "Cnaes": [("8630504", "Atividade odontológica")],
    "Paises": [("105", "BRASIL")],
    "Municipios": [("3597", "ITABUNA")],
    "Estabelecimentos": [CLINIC.values(), SHOP.values()],
}


@pytest.fixture
def archives(tmp_path):
    root = tmp_path / "archives"
    root.mkdir()
    for entity, rows in TABLES.items():
        text = "".join(";".join(f'"{v}"' for v in row) + "\n" for row in rows)
        encoding = "utf-8" if entity in ("Motivos", "Estabelecimentos") else "latin-1"
        with zipfile.ZipFile(root / f"{entity}0.zip", "w") as archive:
            archive.writestr(f"{entity}.CSV", text.encode(encoding))
    return str(root)


def test_clinic_comes_out_as_documented(spark, archives, tmp_path):
    silver = str(tmp_path / "silver")
    options = ["--documented", "--activities", "--by", "uf"]
    assert main(["refresh", archives, str(tmp_path / "raw"), silver, *options], spark) == 0
    table = read_silver(spark, silver, documented=True)
    assert table.columns == DOCUMENTED_COLUMNS
    (row,) = table.collect()
    day = datetime.date(2019, 2, 18)
    assert row.cnpj == "32998915000180"
    assert (row.matriz_filial, row.situacao_cadastral) == ("Matriz", "Ativa")
    assert row.motivo_situacao_cadastral == "SEM MOTIVO"
    assert row.cnae_fiscal == "Atividade odontológica"
    assert (row.cd_pais, row.pais) == ("105", "BRASIL")
    assert (row.cd_municipio, row.municipio) == ("3597", "ITABUNA")
    assert (row.numero, row.cep) == (55, None)
    assert row.data_situacao_cadastral == row.data_inicio_atividades == day
    assert row.data_situacao_especial == day


def test_stages_one_by_one(spark, archives, tmp_path):
    raw, silver = str(tmp_path / "raw"), str(tmp_path / "silver")
    assert main(["extract", archives, raw, "--entities", "Cnaes"], spark) == 0
    assert main(["extract", archives, raw], spark) == 0
    assert main(["transform", raw, silver], spark) == 0
    table = spark.read.parquet(silver)
    assert table.columns == SILVER_COLUMNS
    assert {r.cnpj: r.cnae_fiscal for r in table.collect()} == {
        "32998915000180": "Atividade odontológica",
        "32998915000280": None,
    }


def test_refresh_partitioned_by_a_code(spark, archives, tmp_path):
    raw, silver = str(tmp_path / "raw"), str(tmp_path / "silver")
    options = ["--hot", "cd_pais=105", "cd_pais=", "--documented", "--by", "cd_situacao_cadastral"]
    assert main(["refresh", archives, raw, silver, *options], spark) == 0
    table = read_silver(spark, silver, documented=True)
    assert table.columns == DOCUMENTED_COLUMNS
    assert {r.cd_situacao_cadastral for r in table.collect()} == {"02"}
    assert table.dtypes == silver_from_folder(spark, raw, documented=True).dtypes
    with pytest.raises(ValueError):
        write_silver(table, silver, by="unknown")


def test_refresh_documented(spark, archives, tmp_path):
    raw, silver = str(tmp_path / "raw"), str(tmp_path / "silver")
    refresh_silver(spark, archives, raw, silver, documented=True)
    labels = ("motivo_situacao_cadastral", "cnae_fiscal", "pais", "municipio")
    rows = spark.read.parquet(silver).orderBy("cnpj").select(*labels).collect()
    assert tuple(rows[0]) == ("SEM MOTIVO", "Atividade odontológica", "BRASIL", "ITABUNA")
    assert tuple(rows[1]) == ("SEM MOTIVO", None, "BRASIL", "ITABUNA")


def test_reading_options(spark, tmp_path):
    raw, silver = tmp_path / "raw", str(tmp_path / "silver")
    row = CLINIC | {"nome_fantasia": 'CLÍNICA ""X""; Y'}
    for entity, rows in (TABLES | {"Estabelecimentos": [row.values()]}).items():
        (raw / entity).mkdir(parents=True)
        text = "".join(";".join(f'"{v}"' for v in values) + "\n" for values in rows)
        (raw / entity / "part").write_bytes(text.encode("latin-1"))
    options = ["--encodings", "Estabelecimentos=ISO-8859-1", "--escape", '"']
    assert main(["transform", str(raw), silver, *options], spark) == 0
    (row,) = spark.read.parquet(silver).collect()
    assert row.nome_fantasia == 'CLÍNICA "X"; Y'
    assert row.cnae_fiscal == "Atividade odontológica"


def test_silver_types(spark):
    types = dict(silver_from_folder(spark, inputs.raw_folder(spark, SF_DIR)).dtypes)
    special = {name: "date" for name in types if name.startswith("data_")}
    special |= {"cd_matriz_filial": "int", "numero": "int"}
    assert types == dict.fromkeys(SILVER_COLUMNS, "string") | special


def test_stages_write_whole_answers(spark, tmp_path):
    pages, newest = tmp_path / "pages", str(tmp_path / "newest")
    pages.mkdir()
    for k in range(30):
        (pages / f"{k}.html").write_text(f'<a href="20{10 + k}-05/">x</a>')
    assert main(["latest", str(pages), "https://h/", newest], spark) == 0
    assert spark.read.parquet(newest).count() == 30

    wanted, absent = str(tmp_path / "wanted"), str(tmp_path / "absent")
    names = [(f"Cnaes{k}.zip", f"https://h/Cnaes{k}.zip") for k in range(40)]
    spark.createDataFrame(names, "file_name string, url string").write.parquet(wanted)
    assert main(["missing", wanted, str(pages), absent], spark) == 1
    assert sorted(tuple(r) for r in spark.read.parquet(absent).collect()) == sorted(names)


def test_manifest_of_the_newest_snapshot_on_any_index_page(spark, tmp_path):
    index, pages, target = tmp_path / "index", tmp_path / "pages", str(tmp_path / "manifest")
    index.mkdir()
    (index / "old.html").write_text('<a href="2024-01/">x</a>')
    (index / "new.html").write_text('<a href="2024-01/">x</a><a href="2024-02/">x</a>')
    (index / "none.html").write_text("<p>")
    for month in ("2024-01", "2024-02"):
        (pages / month).mkdir(parents=True)
        (pages / month / "index.html").write_text('<a href="Cnaes.zip">x</a><a href="leia.txt">x</a>')
    assert main(["manifest", str(pages), "https://h/", target, "--index", str(index)], spark) == 0
    assert [r.url for r in spark.read.parquet(target).collect()] == ["https://h/2024-02/Cnaes.zip"]


def test_most_snapshot_pages_of_the_query_are_not_the_newest(spark):
    pages = inputs.in_spark(spark, SF_DIR, inputs.SNAPSHOT_PAGES_SQL)
    assert 0 < QUERIES["listing_to_manifest"](spark, SF_DIR).count() < pages.count() / 2


def test_codes_are_as_many_as_keys(spark):
    row = {"supplier": inputs.MUNICIPALITIES_SQL, "part": inputs.ACTIVITIES_SQL}
    for table, sql in row.items():
        key = "s_suppkey" if table == "supplier" else "p_partkey"
        big = spark.range(9_000, 12_000).union(spark.range(9_999_000, 10_002_000))
        named = big.select(F.col("id").alias(key), F.lit("x").alias(key.replace("suppkey", "name").replace("partkey", "name")))
        assert spark.sql(sql, **{table: named}).select("codigo").distinct().count() == 6_000


def test_listing_to_completeness(spark, archives, tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()
    (pages / "index.html").write_text('<a href="2024-10/">x</a><a href="2024-11/">x</a>')
    newest = str(tmp_path / "newest")
    assert main(["latest", str(pages), "https://h/", newest], spark) == 0
    assert [r.snapshot_url for r in spark.read.parquet(newest).collect()] == ["https://h/2024-11/"]

    month = tmp_path / "month"
    month.mkdir()
    names = ("Cnaes0.zip", "Motivos0.zip", "Empresas0.zip", "leia.txt")
    (month / "p.html").write_text("".join(f'<a href="{n}">x</a>' for n in names))
    manifest = str(tmp_path / "manifest")
    assert main(["manifest", str(month), "https://h/2024-11/", manifest], spark) == 0
    assert sorted(r.url for r in spark.read.parquet(manifest).collect()) == [
        "https://h/2024-11/Cnaes0.zip",
        "https://h/2024-11/Motivos0.zip",
    ]
    absent = str(tmp_path / "absent")
    assert main(["missing", manifest, archives, absent], spark) == 0
    assert main(["missing", manifest, str(pages), absent], spark) == 1

    refresh = ["refresh", archives, str(tmp_path / "raw"), str(tmp_path / "silver")]
    assert main([*refresh, "--manifest", manifest], spark) == 0
    (month / "q.html").write_text('<a href="Estabelecimentos9.zip">x</a>')
    assert main(["manifest", str(month), "https://h/2024-11/", manifest], spark) == 0
    with pytest.raises(FileNotFoundError):
        main([*refresh, "--manifest", manifest], spark)


def test_documented_layout_needs_both_tables(spark):
    with pytest.raises(ValueError):
        build_silver(None, None, None, countries=spark.range(1))


def test_hot_codes_do_not_change_the_silver_table(spark):
    root = inputs.raw_folder(spark, SF_DIR)
    hot = {"cd_pais": [None], "cd_cnae_fiscal": ["0000001"], "cd_motivo_situacao_cadastral": ["00"]}
    plain = silver_from_folder(spark, root, documented=True)
    spread = silver_from_folder(spark, root, documented=True, hot=hot)
    assert plain.exceptAll(spread).isEmpty() and spread.exceptAll(plain).isEmpty()


def test_layout_sizes():
    assert (len(SILVER_COLUMNS), len(DOCUMENTED_COLUMNS)) == (35, 37)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_silver_does_not_shuffle_establishments(spark):
    text = plan(silver_from_folder(spark, inputs.raw_folder(spark, SF_DIR), documented=True))
    assert text.count("BroadcastHashJoin") == 4
    assert "hashpartitioning" not in text and "SinglePartition" not in text
    assert "Python" not in text and "InArrow" not in text


def test_planning_starts_no_job(spark):
    raw = inputs.raw_folder(spark, SF_DIR)
    spark.sparkContext.setJobGroup("planning", "")
    try:
        silver_from_folder(spark, raw, documented=True)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_shuffled_lookups_spread_missing_codes(spark):
    text = plan(QUERIES["silver_shuffled_codes"](spark, SF_DIR))
    assert text.count("SortMergeJoin") == 4 and "BroadcastHashJoin" not in text
    assert text.count("__slice") > 8
    # the slice is part of the key by which rows are dealt out
    assert len(re.findall(r"hashpartitioning\([^,]+, __slice", text)) == 8


def test_large_code_tables_of_few_used_codes_are_broadcast_after_cutting(spark):
    raw = inputs.raw_folder(spark, SF_DIR)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    # As if the activities were too large: a limit below their size and above that of those in use.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "5k")
    try:
        assert "SortMergeJoin" in plan(silver_from_folder(spark, raw))
        facts = read_entity(spark, raw, ESTABLISHMENTS).filter("cd_cnae_fiscal < '0000010'")
        codes = used_codes(facts, read_entity(spark, raw, ACTIVITIES), "cd_cnae_fiscal")
        silver = build_silver(facts, read_entity(spark, raw, REASONS), codes)
        assert silver.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_activity_filter_reaches_both_scans(spark):
    text = plan(QUERIES["silver_filtered"](spark, SF_DIR))
    assert "In(cd_cnae_fiscal, [0000004,0000100,0001777])" in text
    assert "In(codigo, [0000004,0000100,0001777])" in text


def test_only_needed_fields_are_parsed(spark):
    text = plan(QUERIES["csv_permissive_int"](spark, SF_DIR))
    assert "ReadSchema: struct<cd_matriz_filial:int,numero:int,cep:string>" in text


@pytest.mark.parametrize("name", ["extract_links", "manifest_filter", "full_id"])
def test_row_local_queries_do_not_shuffle(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "Exchange" not in text and "Python" not in text


@pytest.mark.parametrize("name, scans", [("latest_snapshot", 1), ("listing_to_manifest", 2)])
def test_pages_are_scanned_once(spark, name, scans):
    text = plan(QUERIES[name](spark, SF_DIR).filter("snapshot_url is not null"))
    assert text.count("regexp_extract_all") == scans


def test_page_texts_are_not_joined(spark):
    text = plan(QUERIES["listing_to_manifest"](spark, SF_DIR))
    assert text.index("LeftSemi") < text.index("Generate posexplode")


def test_newest_link_is_aggregated_before_the_shuffle(spark):
    text = plan(QUERIES["newest_link_by_site"](spark, SF_DIR))
    assert text.index("partial_max_by") > text.index("hashpartitioning")
    assert text.count("hashpartitioning") == 1


def test_archive_contents_are_not_read_by_the_scan(spark):
    text = plan(QUERIES["archive_expand"](spark, SF_DIR))
    assert "content" not in text
    assert "entity" in text
    assert "Scan binaryFile" not in text
