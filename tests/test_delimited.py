"""Reading rules, on hand-written files."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType
from tabularium.layouts import ACTIVITIES, CODE_TABLE, ESTABLISHMENT, REASONS, SILVER_COLUMNS
from tabularium.sources import read_delimited, read_entity, write_silver

EDGE = StructType(
    [
        StructField("name", StringType()),
        StructField("number", IntegerType()),
        StructField("text", StringType()),
    ]
)


@pytest.fixture
def read(spark, tmp_path):
    def run(content, **options):
        path = tmp_path / "edge.csv"
        path.write_bytes(content if isinstance(content, bytes) else content.encode())
        rows = read_delimited(spark, str(path), EDGE, **options).collect()
        return {r["name"]: (r["number"], r["text"]) for r in rows}

    return run


def test_empty_values_are_null(read):
    rows = read('"empty";"";""\nunq;;\n')
    assert rows == {"empty": (None, None), "unq": (None, None)}


def test_bad_integers_are_null_and_spare_the_row(read):
    rows = read(
        '"sn";"S/N";"x"\n"zpad";"007";"x"\n"ovf";"2147483648";"x"\n"sp";" 12";" y "\n"dec";"12.5";"x"\n'
    )
    assert rows == {
        "sn": (None, "x"),
        "zpad": (7, "x"),
        "ovf": (None, "x"),
        "sp": (None, " y "),
        "dec": (None, "x"),
    }


def test_short_long_and_blank_rows(read):
    rows = read('"short";"5"\n\n"long";"5";"z";"extra"\n')
    assert rows == {"short": (5, None), "long": (5, "z")}


def test_line_break_ends_the_row_even_in_quotes(read):
    assert len(read('"a";"1";"x\ny"\n')) == 2


def test_quotes(read):
    text = '"semi";"5";"A;B"\n"dq";"5";"A ""B"" C"\n'
    assert read(text)["semi"] == (5, "A;B")
    assert read(text)["dq"] == (5, '"A ""B"" C"')
    assert read(text, escape='"')["dq"] == (5, 'A "B" C')
    backslash = '"bs";"5";"RUA X\\";"n"\n'
    assert read(backslash)["bs"] == (5, '"RUA X";"n"')
    assert read(backslash, escape='"')["bs"] == (5, "RUA X\\")


def test_encoding_is_per_read(read):
    latin = '"lat";"5";"ODONTOLÓGICA"\n'.encode("latin-1")
    assert read(latin)["lat"] == (5, "ODONTOL�GICA")
    assert read(latin, encoding="ISO-8859-1")["lat"] == (5, "ODONTOLÓGICA")


def test_folder_of_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"00";"A"\n')
    (tmp_path / "b").write_text('"01";"B"\n')
    (tmp_path / "_hidden").write_text('"02";"C"\n')
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "c.csv").write_text('"03";"D"\n')
    flat = read_delimited(spark, str(tmp_path), CODE_TABLE)
    deep = read_delimited(spark, str(tmp_path), CODE_TABLE, recursive=True)
    assert {r.codigo for r in flat.collect()} == {"00", "01"}
    assert {r.codigo for r in deep.collect()} == {"00", "01", "03"}
    assert len(flat.inputFiles()) == 2


def test_an_entity_has_one_folder(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="0 folders of Motivos"):
        read_entity(spark, str(tmp_path), REASONS)
    for folder in ("Motivos", "entity=Motivos"):
        (tmp_path / folder).mkdir()
    with pytest.raises(FileNotFoundError, match="2 folders of Motivos"):
        read_entity(spark, str(tmp_path), REASONS)


def test_entity_folders_plain_and_extracted(spark, tmp_path):
    for folder, code in (("Cnaes", "1"), ("entity=Motivos", "2")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "f").write_bytes(f'"{code}";"É"\n'.encode("latin-1"))
    assert [tuple(r) for r in read_entity(spark, str(tmp_path), ACTIVITIES).collect()] == [("1", "É")]
    assert read_entity(spark, str(tmp_path), REASONS).columns == ["codigo", "descricao"]
    assert read_entity(spark, str(tmp_path), REASONS).count() == 1


def test_layouts():
    assert len(ESTABLISHMENT) == 30
    assert len(SILVER_COLUMNS) == 35
    assert {f.name for f in ESTABLISHMENT if f.dataType == IntegerType()} == {
        "cd_matriz_filial",
        "numero",
    }


def test_write_replaces(spark, tmp_path):
    path = str(tmp_path / "out")
    write_silver(spark.range(10).withColumn("uf", F.lit("SP")), path)
    write_silver(spark.range(3).withColumn("uf", F.lit("BA")), path, by="uf")
    assert spark.read.parquet(path).groupBy("uf").count().collect() == [("BA", 3)]


def test_early_dates_survive_parquet(spark, tmp_path):
    path = str(tmp_path / "out")
    days = ["0001-01-01", "1582-10-15", "9999-01-01"]
    write_silver(spark.createDataFrame([(d,) for d in days], "s string").select(F.to_date("s").alias("d")), path)
    assert sorted(str(r.d) for r in spark.read.parquet(path).collect()) == days


def test_hot_state_is_split_over_tasks(spark, tmp_path):
    states = F.when(F.col("id") % 3 == 0, "BA").otherwise("SP")
    rows = spark.range(400_000).select(F.sha2(F.col("id").cast("string"), 256).alias("x"), states.alias("uf"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        write_silver(rows, str(tmp_path / "out"), by="uf")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(list((tmp_path / "out" / "uf=SP").glob("*.parquet"))) > 4
    assert spark.read.parquet(str(tmp_path / "out")).count() == 400_000
