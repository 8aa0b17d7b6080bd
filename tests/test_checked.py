"""What the permissive reader changes, and encodings told by bytes."""

import random

import pytest
from pyspark.sql import Observation
from pyspark.sql.types import StructType
from tabularium.__main__ import main
from tabularium.layouts import ACTIVITIES, CODE_TABLE, ESTABLISHMENT, ESTABLISHMENTS
from tabularium.sources import (
    check_entity,
    count_faults,
    file_encodings,
    quarantine,
    read_checked,
    read_delimited,
    read_entity,
    read_mixed,
    write_checked,
)

SCHEMA = StructType().add("a", "string").add("n", "integer").add("b", "string").add("m", "integer")

LINES = {
    '"a";1;"x";2': [],
    "a;;x;": [],
    ";;;": [],
    "a;007;x;2": [],
    '"A ""B"" C";1;"x";2': [],
    '"a";S/N;"x";2': ["value:n"],
    "a; 12;x;12.5": ["value:n", "value:m"],
    "a;1;x;2147483648": ["value:m"],
    "a;1;x": ["short"],
    "a": ["short"],
    "a;1;x;2;": ["long"],
    "a;1;x;2;y;z": ["long"],
    r'"RUA X\";1;"next";2': ["short"],  # the quote goes on into the next field
    '"A ;""B"" C;";1;"x";2': ["short"],
    '"a;1;x;2': ["quote"],
    '"a";1;"x";"2': ["quote"],
}


@pytest.fixture
def write(tmp_path):
    def write(name, lines, encoding="utf-8"):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(b"".join(x + b"\n" if isinstance(x, bytes) else (x + "\n").encode(encoding) for x in lines))
        return str(path)

    return write


def test_faults_by_line(spark, write):
    path = write("in/lines.csv", [*LINES, "", "  \t ", "é;1;ü;2"])
    rows = read_checked(spark, path, SCHEMA).collect()
    assert {r.line: r.faults for r in rows} == LINES | {"é;1;ü;2": []}
    assert {r.path for r in rows} == {"file:" + path} or all(r.path.endswith("in/lines.csv") for r in rows)
    # and the rows are those of the permissive reader
    assert [tuple(r)[:4] for r in rows] == [tuple(r) for r in read_delimited(spark, path, SCHEMA).collect()]


@pytest.mark.parametrize("escape", ["\\", '"'])
def test_rows_are_those_of_the_permissive_reader(spark, write, escape):
    rng = random.Random(escape)
    parts = ['"', ";", "\\", "a", "1", " ", '";"', '""', "2147483648", "é", "-3"]
    lines = ["".join(rng.choices(parts, k=rng.randint(1, 14))) for _ in range(3000)]
    path = write("lines.csv", lines)
    checked = read_checked(spark, path, SCHEMA, escape=escape).collect()
    plain = read_delimited(spark, path, SCHEMA, escape=escape).collect()
    assert [tuple(r)[:4] for r in checked] == [tuple(r) for r in plain]
    sound = [r for r in checked if not r.faults]
    assert 0 < len(sound) < len(checked)
    # the marks put behind lines come out nowhere
    assert not any("\x00" in str(value) for r in checked for value in r)


def test_bytes_that_are_not_in_the_encoding(spark, write):
    path = write("lines.csv", [b"\xc9;1;x;2", "É;x;x;2", "a;1"])
    rows = read_checked(spark, path, SCHEMA).collect()
    assert [r.faults for r in rows] == [["encoding"], ["value:n"], ["short"]]
    assert rows[0].a == "�"
    latin = read_checked(spark, path, SCHEMA, "ISO-8859-1").collect()
    assert [r.faults for r in latin] == [[], ["value:n"], ["short"]]
    assert latin[0].a == "É"


def test_quarantine_and_counts_in_one_scan(spark, write, tmp_path):
    path = write("in/lines.csv", [*LINES, b"\xc9;1;x"])
    checked = read_checked(spark, path, SCHEMA)
    target = str(tmp_path / "out")
    for _ in range(2):
        counts = write_checked(checked, target, SCHEMA)
    faulty = [line for line, faults in LINES.items() if faults]
    assert counts == {
        "lines": len(LINES) + 1, "faulty": len(faulty) + 1, "short": 5, "long": 2, "quote": 2, "encoding": 1,
        "value:n": 2, "value:m": 2,
    }
    kept = spark.read.parquet(f"{target}/faulty=true")
    assert {r.line for r in kept.collect()} == {*faulty, "�;1;x"}
    rows = spark.read.parquet(f"{target}/faulty=false").collect()
    assert len(rows) == len(LINES) - len(faulty) and all(r.line is None for r in rows)
    assert {r.line for r in quarantine(checked).collect()} == {*faulty, "�;1;x"}
    plan = count_faults(checked, Observation(), SCHEMA)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Python" not in plan


def test_all_fields_of_text_and_empty_files(spark, write):
    path = write("codes.csv", ['"1";"A"', "2", '"3";"B";"C"'])
    rows = read_checked(spark, path, CODE_TABLE).collect()
    assert [(r.codigo, r.faults) for r in rows] == [("1", []), ("2", ["short"]), ("3", ["long"])]
    assert read_checked(spark, write("none.csv", []), CODE_TABLE).collect() == []


def test_rejects_as_a_job(spark, tmp_path, write, capsys):
    folder = ESTABLISHMENTS.folder
    write(f"{folder}/a.csv", [";" * 29, ";" * 28])
    source, target = str(tmp_path), str(tmp_path / "out")
    assert main(["rejects", source, target, "--most", "1"], spark) == 0
    assert "short\t1" in capsys.readouterr().out
    assert main(["rejects", source, target, "--most", "0"], spark) == 1
    assert check_entity(spark, source, ESTABLISHMENTS).select(ESTABLISHMENT.names).count() == 2


def test_each_file_is_read_in_its_own_encoding(spark, tmp_path, write):
    words = ["ação", "São João", "ODONTOLÓGICA", "plain"]
    lines = [f'"{k}";"{word}"' for k, word in enumerate(words)]
    write("Cnaes/utf8.csv", lines)
    write("Cnaes/latin [1] ção%20.csv", lines, "latin-1")
    write("Cnaes/ascii.csv", lines[-1:])
    write("Cnaes/empty.csv", [])
    write("Cnaes/mostly.csv", [*lines * 3, b'"9";"\xe9"'])
    folder = str(tmp_path / "Cnaes")
    found = {r.path.rsplit("/")[-1]: (r.lines, r.accented, r.broken, r.encoding) for r in file_encodings(spark, folder).collect()}
    assert sorted(found.values()) == [
        (1, 0, 0, "UTF-8"), (4, 0, 3, "ISO-8859-1"), (4, 3, 0, "UTF-8"), (13, 9, 1, "UTF-8"),
    ]
    expected = sorted([*enumerate(words)] * 5 + [(3, "plain"), (9, "�")])
    for table in (read_mixed(spark, folder, CODE_TABLE), read_entity(spark, str(tmp_path), ACTIVITIES, "auto")):
        assert sorted((int(r.codigo), r.descricao) for r in table.collect()) == expected


def test_a_folder_of_empty_files_is_an_empty_table(spark, tmp_path, write):
    write("Cnaes/empty.csv", [])
    table = read_mixed(spark, str(tmp_path / "Cnaes"), CODE_TABLE)
    assert table.columns == CODE_TABLE.names and table.collect() == []
