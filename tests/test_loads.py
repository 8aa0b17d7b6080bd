import pytest
from pyspark.errors import AnalysisException
from tabularium.operators import is_complete, missing_files
from tabularium.sources import list_files


def test_missing_files(spark):
    manifest = spark.createDataFrame(
        [("a.zip", 1), ("b.zip", 2), ("b.zip", 3), (None, 4)], "file_name string, n int"
    )
    landed = spark.createDataFrame([("a.zip",)] * 3 + [("c.zip",), (None,)], "file_name string")
    absent = missing_files(manifest, landed)
    assert sorted(r.n for r in absent.collect()) == [2, 3, 4]
    assert not is_complete(manifest, landed)
    assert is_complete(manifest.filter("n = 1"), landed)


def test_list_files(spark, tmp_path):
    (tmp_path / "Cnaes.zip").write_bytes(b"12345")
    (tmp_path / "other.txt").write_bytes(b"1")
    (tmp_path / "out" / "entity=Cnaes").mkdir(parents=True)
    (tmp_path / "out" / "entity=Cnaes" / "deep.zip").write_bytes(b"1")
    rows = list_files(spark, str(tmp_path)).collect()
    assert [(r.file_name, r.bytes) for r in rows] == [("Cnaes.zip", 5)]
    assert list_files(spark, str(tmp_path), "*.none").collect() == []
    with pytest.raises(AnalysisException):
        list_files(spark, str(tmp_path / "nowhere"))
