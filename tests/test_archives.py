"""Archives with awkward members."""

import zipfile
from types import SimpleNamespace

import pytest
from hypothesis import given, strategies as st
from tabularium.__main__ import main
from tabularium.layouts import ACTIVITIES, REASONS
from tabularium.plans import refresh_silver
from tabularium.sources import (
    BrokenArchives,
    archived_lines,
    archived_rows,
    check_archives,
    extract_archives,
    list_archives,
    read_entity,
    read_members,
    refuse_broken,
)
from tabularium.sources import archives as module
from tabularium.sources.archives import BLOCK_BYTES, _dealt, _whole_lines, distinct_members, locate


@pytest.fixture
def folder(tmp_path):
    def pack(name, **members):
        with zipfile.ZipFile(tmp_path / name, "w", zipfile.ZIP_DEFLATED) as archive:
            for member, content in members.items():
                archive.writestr(member.replace("__", "/"), content)

    pack("Motivos.zip", a='"00";"SEM MOTIVO"\r\n\r\n"01";"A;B"\r\n', empty="", sub__b='"02";"C"')
    pack("Cnaes0.zip", a='"1";"ODONTOLÓGICA"\n'.encode("latin-1"))
    pack("Cnaes12.zip", a='"2";"É"\n'.encode("latin-1"))
    pack("CNAES.ZIP", a='"3";"no"\n')
    pack("notes.txt", a='"4";"no"\n')
    with zipfile.ZipFile(tmp_path / "Motivos.zip", "a") as archive:
        archive.mkdir("folder")
    return str(tmp_path)


def test_list_archives(spark, folder):
    rows = list_archives(spark, folder).select("entity").collect()
    assert sorted(r.entity for r in rows) == ["Cnaes", "Cnaes", "Motivos"]


def test_members_and_lines(spark, folder):
    members = read_members(spark, folder, ["Motivos"])
    assert {(r.member, r.block_no) for r in members.collect()} == {("a", 0), ("sub/b", 0)}
    lines = archived_lines(members).collect()
    assert sorted(r.line for r in lines) == ['"00";"SEM MOTIVO"', '"01";"A;B"', '"02";"C"']
    assert {r.archive.rsplit("/")[-1] for r in lines} == {"Motivos.zip"}


def test_rows_and_encodings(spark, folder):
    assert sorted(archived_rows(spark, folder, REASONS).collect()) == [
        ("00", "SEM MOTIVO"),
        ("01", "A;B"),
        ("02", "C"),
    ]
    rows = sorted(archived_rows(spark, folder, ACTIVITIES).collect())
    assert rows == [("1", "ODONTOLÓGICA"), ("2", "É")]


@pytest.mark.parametrize("entities", [None, ["Motivos", "Cnaes"]])
def test_extracted_equals_direct(spark, folder, tmp_path_factory, entities):
    target = str(tmp_path_factory.mktemp("out"))
    for _ in range(2):
        extract_archives(spark, folder, target, entities)
    for entity in (REASONS, ACTIVITIES):
        extracted = sorted(read_entity(spark, target, entity).collect())
        assert extracted == sorted(archived_rows(spark, folder, entity).collect())


@pytest.mark.parametrize("entities", [None, ["Motivos", "Cnaes"]])
def test_extracting_beside_the_archives_spares_them(spark, folder, entities):
    for _ in range(2):
        extract_archives(spark, folder, folder, entities)
    assert list_archives(spark, folder).count() == 3
    assert read_entity(spark, folder, ACTIVITIES).count() == 2


def test_bytes_that_are_not_utf8_read_alike_both_ways(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "Motivos.zip", "w") as archive:
        archive.writestr("a", '"1";"ODONTOLÓGICA"\n'.encode("latin-1"))
    extract_archives(spark, str(tmp_path), str(tmp_path / "out"))
    direct = archived_rows(spark, str(tmp_path), REASONS).collect()
    assert direct == read_entity(spark, str(tmp_path / "out"), REASONS).collect()
    assert direct == [("1", "ODONTOL�GICA")]


def test_entity_without_archives_is_an_error(spark, folder, tmp_path):
    with pytest.raises(FileNotFoundError):
        extract_archives(spark, folder, str(tmp_path / "out"), ["Paises"])


def test_many_members_are_dealt_out(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "Motivos.zip", "w") as archive:
        for i in range(40):
            archive.writestr(f"m{i}", f'"{i}";"x"\n')
    members = read_members(spark, str(tmp_path), tasks=20)
    per_task = members.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(per_task) == 40
    assert max(per_task) <= 4


def test_more_bytes_are_more_tasks(spark, folder, monkeypatch):
    plain = sorted(archived_lines(read_members(spark, folder)).collect())
    large = [SimpleNamespace(bytes=module.TASK_BYTES)] * 1000
    assert module._tasks(spark, None, large) == 1000
    assert module._tasks(spark, None, large[:1]) == 4 * spark.sparkContext.defaultParallelism
    assert module._tasks(spark, 3, large) == 3
    monkeypatch.setattr(module, "TASK_BYTES", 1)
    assert sorted(archived_lines(read_members(spark, folder)).collect()) == plain


def test_odd_lines_read_alike_both_ways(spark, tmp_path):
    lines = ["", " ", "\t", " \t\x0b ", '"1";"a"', "  ", '2;b\t', ' "3";" c "', '"4";"d', ";", '5', '"6";"\\"e"']
    with zipfile.ZipFile(tmp_path / "Motivos.zip", "w") as archive:
        archive.writestr("unix", "\n".join(lines))
        archive.writestr("dos", "\r\n".join(lines))
    extract_archives(spark, str(tmp_path), str(tmp_path))
    direct = archived_rows(spark, str(tmp_path), REASONS).collect()
    extracted = read_entity(spark, str(tmp_path), REASONS).collect()
    assert sorted(direct, key=str) == sorted(extracted, key=str)
    assert len(direct) == 2 * 7


def test_byte_order_marks_are_dropped(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "Motivos.zip", "w") as archive:
        for code in "12":
            archive.writestr(code, f'"{code}";"É"\n'.encode("utf-8-sig"))
    extract_archives(spark, str(tmp_path), str(tmp_path), ["Motivos"], tasks=1)
    assert sorted(read_entity(spark, str(tmp_path), REASONS).collect()) == [("1", "É"), ("2", "É")]
    assert sorted(archived_rows(spark, str(tmp_path), REASONS).collect()) == [("1", "É"), ("2", "É")]


@pytest.mark.parametrize("prefix", ["", "file:", "file://"])
def test_local_paths_in_all_spellings(spark, folder, prefix):
    system, path = locate(f"{prefix}{folder}/Motivos.zip")
    assert system.get_file_info(path).is_file
    assert archived_rows(spark, f"{prefix}{folder}", REASONS).count() == 3


class Stream:
    def __init__(self, content):
        self.content = content

    def read(self, size):
        head, self.content = self.content[:size], self.content[size:]
        return head


@pytest.mark.parametrize(
    "content",
    [
        b"",
        b"\n",
        b"a",
        b"a\n",
        b"a\n\nb",
        b"x" * (3 * BLOCK_BYTES) + b"\ny\n",
        b"ab\n" * BLOCK_BYTES,
        (b"z" * (BLOCK_BYTES - 1) + b"\n") * 2 + b"end",
    ],
)
def test_blocks_cut_at_line_breaks_only(content):
    blocks = list(_whole_lines(Stream(content)))
    written = b"".join(block + b"\n" for block in blocks)
    assert written == content + (b"" if content.endswith(b"\n") or not content else b"\n")


def test_a_member_of_carriage_returns_is_cut_as_well():
    content = b"line\r" * (BLOCK_BYTES // 2)
    blocks = list(_whole_lines(Stream(content)))
    assert max(map(len, blocks)) <= BLOCK_BYTES
    assert b"\r".join(blocks) + b"\r" == content


def test_a_line_that_is_too_long_is_an_error(monkeypatch):
    monkeypatch.setattr(module, "LINE_BYTES", 2 * BLOCK_BYTES)
    with pytest.raises(ValueError):
        list(_whole_lines(Stream(b"x" * (4 * BLOCK_BYTES))))


def test_members_are_dealt_by_size():
    row = lambda name, size: SimpleNamespace(archive="a", entity="e", member=name, bytes=size)
    dealt = _dealt([row("big", 100), *(row(f"s{k}", 10) for k in range(9)), row("empty", 0)], 3)
    load = {task: sorted(m for _, _, m, t in dealt if t == task) for task in range(3)}
    assert ["big"] in load.values() and len(dealt) == 11
    assert max(len(members) for members in load.values()) <= 6


@given(st.lists(st.sampled_from([b"a", b"\n", b"\r\n", b";x", b"\xc3\x89"])), st.integers(1, 7))
def test_blocks_of_any_size_keep_every_byte(pieces, size):
    content = b"".join(pieces)
    before, module.BLOCK_BYTES = module.BLOCK_BYTES, size
    try:
        blocks = list(_whole_lines(Stream(content)))
    finally:
        module.BLOCK_BYTES = before
    written = b"".join(block + b"\n" for block in blocks)
    assert written == content + (b"" if content.endswith(b"\n") or not content else b"\n")


@pytest.fixture
def damaged(tmp_path):
    """A whole archive, one cut off, one with a byte changed, one of no archive, one empty, one encrypted."""

    def pack(name, members, method=zipfile.ZIP_DEFLATED):
        with zipfile.ZipFile(tmp_path / name, "w", method) as archive:
            for member, content in members.items():
                archive.writestr(member, content)
        return tmp_path / name

    text = "".join(f'"{k}";"{k * k}"\n' for k in range(5000))
    pack("Motivos0.zip", {"a": text, "b": text})
    cut = pack("Motivos1.zip", {"a": text})
    cut.write_bytes(cut.read_bytes()[:-40])
    for number, method in ((2, zipfile.ZIP_DEFLATED), (3, zipfile.ZIP_STORED)):
        changed = pack(f"Cnaes{number}.zip", {"a": text, "b": text}, method)
        data = bytearray(changed.read_bytes())
        data[len(data) // 4] ^= 1
        changed.write_bytes(data)
    (tmp_path / "Motivos4.zip").write_bytes(b"<html>busy, try later</html>")
    pack("Motivos5.zip", {})
    (tmp_path / "Motivos6.zip").write_bytes(b"")
    locked = pack("Cnaes7.zip", {"a": text})
    data = bytearray(locked.read_bytes())
    for signature, flag in ((b"PK\x03\x04", 6), (b"PK\x01\x02", 8)):
        data[data.index(signature) + flag] |= 1
    locked.write_bytes(data)
    return tmp_path


def test_broken_archives_are_named(spark, damaged):
    rows = {r.file_name: r for r in check_archives(spark, str(damaged)).collect()}
    assert {name: r.fault for name, r in rows.items()} == {
        "Motivos0.zip": None,
        "Motivos1.zip": "directory",
        "Cnaes2.zip": "a: content",
        "Cnaes3.zip": "a: content",
        "Motivos4.zip": "directory",
        "Motivos5.zip": None,
        "Motivos6.zip": "directory",
        "Cnaes7.zip": "a: encrypted or of an unknown method",
    }
    size = 2 * len("".join(f'"{k}";"{k * k}"\n' for k in range(5000)))
    assert (rows["Motivos0.zip"].members, rows["Motivos0.zip"].bytes) == (2, size)
    assert (rows["Motivos5.zip"].members, rows["Motivos5.zip"].bytes) == (0, 0)
    assert (rows["Motivos1.zip"].members, rows["Motivos1.zip"].bytes) == (None, None)
    only = check_archives(spark, str(damaged), ["Cnaes"], tasks=1).collect()
    assert sorted(r.file_name for r in only) == ["Cnaes2.zip", "Cnaes3.zip", "Cnaes7.zip"]


def test_no_archives_are_whole(spark, tmp_path):
    (tmp_path / "other.txt").write_text("x")
    assert check_archives(spark, str(tmp_path)).collect() == []
    refuse_broken(spark, str(tmp_path))


def test_a_refresh_with_broken_archives_replaces_nothing(spark, damaged):
    raw, silver = damaged / "raw", damaged / "silver"
    for kept in (raw, silver):
        kept.mkdir()
        (kept / "kept.txt").write_text("x")
    with pytest.raises(BrokenArchives, match=r"Cnaes2\.zip \(a: content\).*Motivos1\.zip \(directory\)"):
        refresh_silver(spark, str(damaged), str(raw), str(silver))
    assert [p.name for p in raw.iterdir()] == [p.name for p in silver.iterdir()] == ["kept.txt"]
    report = str(damaged / "report")
    assert main(["verify", str(damaged), report], spark) == 1
    assert spark.read.parquet(report).where("fault is null").count() == 2
    assert main(["verify", str(damaged), report, "--entities", "none"], spark) == 0


def test_a_member_that_is_there_twice_is_read_once(spark, tmp_path):
    def pack(name, **members):
        with zipfile.ZipFile(tmp_path / name, "w") as archive:
            for member, content in members.items():
                archive.writestr(member, content)

    pack("Motivos0.zip", a="one\n", b="two\n", c="two\n")
    pack("Motivos1.zip", renamed="one\n", d="three\n")
    pack("Cnaes0.zip", a="one\n")  # of another entity
    pack("Motivos2.zip", e="", f="")
    lines = archived_lines(read_members(spark, str(tmp_path), distinct=True)).collect()
    assert sorted((r.entity, r.member, r.line) for r in lines) == [
        ("Cnaes", "a", "one"), ("Motivos", "a", "one"), ("Motivos", "b", "two"), ("Motivos", "d", "three"),
    ]
    assert archived_lines(read_members(spark, str(tmp_path))).count() == 6
    for entities in (["Motivos"], None):
        extract_archives(spark, str(tmp_path), str(tmp_path / "out"), entities, distinct=True)
        assert spark.read.text(str(tmp_path / "out" / "entity=Motivos")).count() == 3


def test_equal_checksums_are_not_enough(spark, tmp_path, monkeypatch):
    for name, content in (("Motivos0.zip", "one\n"), ("Motivos1.zip", "two\n")):
        with zipfile.ZipFile(tmp_path / name, "w") as archive:
            archive.writestr("a", content)
    row = lambda name: SimpleNamespace(archive=str(tmp_path / name), entity="Motivos", member="a", bytes=4, crc=7)
    alike = [row("Motivos0.zip"), row("Motivos1.zip")]
    assert distinct_members(spark, alike) == alike
    assert distinct_members(spark, [alike[0], alike[0]])[:1] == alike[:1]
