import hashlib
import random

import pytest
from pyspark.sql import functions as F
from tabularium.llm import merkle

SCHEMA = "page_id long, url string, html string, offset long, hash string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, 0, "") for i, u, h in rows], SCHEMA).repartition(3)


def differences(one, other):
    left, right = ({(r.file, r.offset): r.hash for r in merkle.hash_records(x).collect()} for x in (one, other))
    return sorted(k for k in left.keys() | right.keys() if left.get(k) != right.get(k))


@pytest.mark.parametrize("range_bits, fanout_bits", [(16, 4), (10, 1), (7, 2)])
def test_damage_is_found_wherever_it_is(spark, monkeypatch, range_bits, fanout_bits):
    monkeypatch.setattr(merkle, "RANGE_BITS", range_bits)
    monkeypatch.setattr(merkle, "FANOUT_BITS", fanout_bits)
    monkeypatch.setattr(merkle, "FILE_PAGES", 70)
    rng = random.Random(range_bits)
    rows = [(i, f"http://h/{i}", "x" * rng.randrange(300)) for i in range(200)]
    one = merkle.warc_records(pages(spark, rows))
    bad, gone = [0, 66, 150], [3, 69, 199]
    record = F.when(F.col("record_id").isin(bad), F.lower("record")).otherwise(F.col("record"))
    other = one.withColumn("record", F.when(~F.col("record_id").isin(gone), record))
    found = merkle.audit(one, other).collect()
    assert sorted((r.file, r.offset) for r in found) == differences(one, other)
    assert {r.record_id: r.status for r in found} == {i: "corrupt" for i in bad} | {i: "missing" for i in gone}
    back = merkle.audit(other, one).collect()
    assert {r.record_id: r.status for r in back} == {i: "corrupt" for i in bad} | {i: "extra" for i in gone}
    assert merkle.audit(one, one).collect() == []


def test_offsets_are_those_of_the_bytes(spark):
    records = merkle.warc_records(pages(spark, [(k, "u", "é" * k) for k in range(20)])).orderBy("record_id").collect()
    table = spark.createDataFrame(records)
    at = 0
    for row, placed in zip(records, merkle.hash_records(table).orderBy("record_id").collect(), strict=True):
        data = row.record.encode()
        assert (placed.offset, placed.length) == (at, len(data))
        assert placed.hash == hashlib.sha256(data).hexdigest()
        body = row.record.split("\r\n\r\n", 1)
        assert f"Content-Length: {2 * row.record_id}" in body[0] and body[1] == "é" * row.record_id + "\r\n\r\n"
        at += len(data)


def test_awkward_rows(spark):
    rows = [(1, None, None), (1, None, None), (2, "u", ""), (None, "a", "b"), (None, "a", "b"), (3, "u", "x" * 400_000)]
    one = merkle.warc_records(pages(spark, rows))
    assert one.count() == 6
    lost = one.withColumn("record", F.expr("if(record_id = 3 or record_id is null, record, null)"))
    found = merkle.audit(one, lost)
    assert {r.record_id for r in found.collect()} == {1, 2}
    assert merkle.audit(one, one.limit(0)).select("file", "offset").distinct().count() == 6
    assert merkle.audit(one.limit(0), one.limit(0)).collect() == []


def test_only_differing_branches_are_followed(spark, monkeypatch):
    monkeypatch.setattr(merkle, "RANGE_BITS", 8)
    one = merkle.hash_records(merkle.warc_records(pages(spark, [(k, "u", "x" * 200) for k in range(300)])))
    levels = merkle.levels_for(one)
    other = one.withColumn("hash", F.when(F.col("record_id") == 5, F.lit("?")).otherwise(F.col("hash")))
    trees = [merkle.tree(x, levels) for x in (one, other)]
    assert trees[0][-1].count() == 1
    suspects = merkle._differing(trees[0][-1], trees[1][-1])
    for level in range(levels - 2, -1, -1):
        children = [merkle._below(t[level], "node", merkle.FANOUT_BITS, suspects) for t in trees]
        assert children[0].count() <= 1 << merkle.FANOUT_BITS
        suspects = merkle._differing(*children)
    assert suspects.count() == 1


def test_a_record_of_another_length_shifts_no_others(spark):
    one = merkle.warc_records(pages(spark, [(k, "u", "x" * 200) for k in range(100)]))
    cut = F.expr("substring(record, 1, length(record) - 7)")
    longer = F.concat("record", F.lit("more"))
    changed = F.when(F.col("record_id") == 5, cut).when(F.col("record_id") == 60, longer).otherwise(F.col("record"))
    other = one.withColumn("record", changed).withColumn("length", F.octet_length("record").cast("long"))
    assert {r.record_id: r.status for r in merkle.audit(one, other).collect()} == {5: "corrupt", 60: "corrupt"}
    assert {r.record_id: r.status for r in merkle.audit(other, one).collect()} == {5: "corrupt", 60: "corrupt"}
