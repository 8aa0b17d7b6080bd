"""Fixity audit of WARC replicas by Merkle trees over offset ranges.

Each record is hashed. The records of a file that begin within one range of ``2**RANGE_BITS`` bytes,
in order of offset, give the hash of that range; ``2**FANOUT_BITS`` neighbouring ranges that of the range
above them; and so on up to one root per file. Ranges are cut by offset, so a node has a bounded
number of children however large the file is, and replicas have the same nodes without
agreeing on anything beforehand.

An audit compares roots and goes down from those that differ only, level by level, to the records. Trees
are written once (some 100 bytes a record); after that, what is read again follows the damage, not the
archive. Both replicas are placed by the lengths that the first one's index tells, so a record that is longer or shorter in the
second does not shift those after it. A record of the second that the first does not have, or whose id is there more than once, has its own length.

Rows without a file take no part; a null record is a hole, whose length is known; repeated rows are
records of their own. Of files that one replica lacks every record is reported. Empty replicas have empty
trees. Records are placed by a window over one file of the index, so files are as large as a task can sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabularium.llm.tables import keep

RANGE_BITS, FANOUT_BITS = 16, 4

#: Pages in one WARC file, by id.
FILE_PAGES = 1000


def warc_records(pages: DataFrame) -> DataFrame:
    """``file, record_id, length, record`` of ``page_id, url, html``.

    Records are WARC/1.1 resources. A file holds the pages of a range of ids, in order of id; pages
    without an id are spread over files of their own. Null urls and pages are written as empty.
    """
    url, html = (F.coalesce(F.col(c), F.lit("")) for c in ("url", "html"))
    record = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        url,
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(html).cast("string"),
        F.lit("\r\n\r\n"),
        html,
        F.lit("\r\n\r\n"),
    )
    file = F.coalesce(
        F.expr(f"concat('pages-', page_id div {FILE_PAGES}, '.warc')"),
        F.concat(F.lit("other-"), F.pmod(F.xxhash64(url, html), F.lit(1 << 16)), F.lit(".warc")),
    )
    rows = pages.select(file.alias("file"), F.col("page_id").cast("long").alias("record_id"), record.alias("record"))
    return rows.withColumn("length", F.octet_length("record").cast("long"))


def index_records(records: DataFrame) -> DataFrame:
    """``file, record_id, length, hash``: SHA-256 as hex. Records are hashed where they are read; null ones have no hash."""
    return records.where("file is not null").select(
        "file",
        F.col("record_id").cast("long"),
        F.coalesce(F.col("length").cast("long"), F.lit(0).cast("long")).alias("length"),
        F.sha2(F.col("record").cast("binary"), 256).alias("hash"),
    )


def place_records(index: DataFrame) -> DataFrame:
    """``file, offset, length, record_id, hash``: records one after the other by id; holes are not there."""
    order = Window.partitionBy("file").orderBy("record_id", "length", "hash")
    before = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1))
    placed = index.withColumn("offset", F.coalesce(before, F.lit(0).cast("long")))
    return placed.where("hash is not null").select("file", "offset", "length", "record_id", "hash")


def hash_records(records: DataFrame) -> DataFrame:
    """``file, offset, length, record_id, hash``: where each record lies, and its SHA-256 as hex.

    Records are placed one after the other by id. They are hashed where they are read; what is
    sorted to place them is this index only. A null record is a hole: it takes its length, but is not there.
    """
    return place_records(index_records(records))


def _lengths_of(index: DataFrame, other: DataFrame) -> DataFrame:
    """``other`` with the lengths that ``index`` tells for its records, as far as an id is there once."""
    known = (
        index.groupBy("file", "record_id")
        .agg(F.count(F.lit(1)).alias("n"), F.min("length").alias("told"))
        .where("n = 1 and record_id is not null")
        .drop("n")
    )
    joined = other.join(known, ["file", "record_id"], "left")
    return joined.withColumn("length", F.coalesce("told", "length")).select(other.columns)


def _hash_of(place: str) -> Column:
    """Hash of a node from the places and hashes of its children, in order."""
    children = F.sort_array(F.collect_set(F.struct(place, "hash")))
    lines = F.transform(children, lambda c: F.concat_ws(":", c[place].cast("string"), c["hash"]))
    return F.sha2(F.array_join(lines, "\n").cast("binary"), 256).alias("hash")


def levels_for(*leaves: DataFrame) -> int:
    """How many levels above the records lead to one node per file."""
    ends = [leaf.agg(F.max("offset")).first()[0] or 0 for leaf in leaves]
    levels = 1
    while max(ends) >> (RANGE_BITS + FANOUT_BITS * (levels - 1)):
        levels += 1
    return levels


def tree(leaves: DataFrame, levels: int) -> list[DataFrame]:
    """Tables ``file, node, hash``, from the lowest ranges to the roots."""
    lowest = F.shiftright("offset", RANGE_BITS).alias("node")
    nodes = [keep(leaves.groupBy("file", lowest).agg(_hash_of("offset")), "ranges")]
    for _ in range(levels - 1):
        above = nodes[-1].groupBy("file", F.shiftright("node", FANOUT_BITS).alias("parent")).agg(_hash_of("node"))
        nodes.append(keep(above.withColumnRenamed("parent", "node"), "ranges"))
    return nodes


def _differing(one: DataFrame, other: DataFrame) -> DataFrame:
    """``file, node`` whose hash differs or that one side lacks."""
    left, right = (t.select("file", "node", F.col("hash").alias(h)) for t, h in ((one, "a"), (other, "b")))
    return left.join(right, ["file", "node"], "full").where(~F.col("a").eqNullSafe(F.col("b"))).select("file", "node")


def _below(nodes: DataFrame, place: str, bits: int, parents: DataFrame) -> DataFrame:
    """Those whose parent is listed."""
    listed = parents.select("file", F.col("node").alias("parent"))
    return (
        nodes.withColumn("parent", F.shiftright(place, bits))
        .join(listed, ["file", "parent"], "left_semi")
        .drop("parent")
    )


def audit(one: DataFrame, other: DataFrame) -> DataFrame:
    """Records in which two replicas differ: ``file, offset, length, record_id, status, hash_a, hash_b``.

    Both are as from :func:`warc_records`. ``status`` is ``corrupt``, ``missing`` (the second has no record at
    that offset) or ``extra`` (the first has none).
    """
    first, second = (keep(index_records(records), "index") for records in (one, other))
    leaves = [keep(place_records(index), "records") for index in (first, _lengths_of(first, second))]
    levels = levels_for(*leaves)
    trees = [tree(leaf, levels) for leaf in leaves]
    suspects = keep(_differing(trees[0][-1], trees[1][-1]), "suspects")
    for level in range(levels - 2, -1, -1):
        children = [_below(nodes[level], "node", FANOUT_BITS, suspects) for nodes in trees]
        suspects = keep(_differing(*children), "suspects")
    found = []
    for leaf, side in zip(leaves, "ab", strict=True):
        rows = _below(leaf, "offset", RANGE_BITS, suspects).distinct()
        names = [F.col(c).alias(f"{c}_{side}") for c in ("length", "record_id", "hash")]
        found.append(rows.select("file", "offset", *names))
    status = F.when(F.col("hash_b").isNull(), "missing").when(F.col("hash_a").isNull(), "extra").otherwise("corrupt")
    return (
        found[0]
        .join(found[1], ["file", "offset"], "full")
        .where(~F.col("hash_a").eqNullSafe(F.col("hash_b")))
        .select(
            "file",
            "offset",
            F.coalesce("length_a", "length_b").alias("length"),
            F.coalesce("record_id_a", "record_id_b").alias("record_id"),
            status.alias("status"),
            "hash_a",
            "hash_b",
        )
    )
