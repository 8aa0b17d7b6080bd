"""Registry-shaped inputs over the test tables.

Each SQL text runs unchanged in Spark and in the oracle; ``{orders}`` and the like stand for tables.
"""

from __future__ import annotations

import itertools
import re
import shutil
import tempfile
import zipfile
from collections.abc import Iterator
from typing import IO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tabularium.checks.scratch import written_once
from tabularium.layouts import (
    ACTIVITIES,
    COUNTRIES,
    ESTABLISHMENT_FIELDS,
    ESTABLISHMENTS,
    FIELD_SEPARATOR,
    MUNICIPALITIES,
    REASONS,
)
from tabularium.sources.archives import list_archives, locate, open_file

_ORDER_DATE = "replace(cast(cast(o.o_orderdate as date) as string), '-', '')"


def _padded(number: str, width: int, digit: int = 0) -> str:
    """A number as text of at least so many digits; longer ones are not cut, so keys stay apart."""
    text = f"cast({number} as string)"
    return f"case when length({text}) < {width} then lpad({text}, {width}, '{digit}') else {text} end"


# Field expressions over orders o (and customer c for the trade name).
_ESTABLISHMENT = {
    "cnpj_basico": _padded("o.o_custkey", 8),
    "cnpj_ordem": _padded("o.o_orderkey % 10000", 4),
    "cnpj_dv": "case when o.o_orderkey % 17 = 0 then null"
    f" else {_padded('o.o_orderkey % 100', 2)} end",
    "cd_matriz_filial": "cast(case when o.o_orderkey % 7 = 0 then null"
    " else o.o_orderkey % 2 + 1 end as int)",
    "nome_fantasia": "c.c_name",
    "cd_situacao_cadastral": "case cast(o.o_orderkey % 6 as int) when 0 then '01' when 1 then '02'"
    " when 2 then '03' when 3 then '04' when 4 then '08' else null end",
    "data_situacao_cadastral": "case when o.o_orderkey % 11 = 0 then '00000000'"
    f" when o.o_orderkey % 13 = 0 then '0' else {_ORDER_DATE} end",
    "cd_motivo_situacao_cadastral": _padded("o.o_orderkey % 30", 2),
    "nome_cidade_exterior": "case when o.o_orderkey % 50 = 0 then 'LISBOA' else null end",
    "pais": "case when o.o_orderkey % 5 = 0"
    f" then {_padded('o.o_orderkey % 7', 3)} else null end",
    "data_inicio_atividades": _ORDER_DATE,
    "cd_cnae_fiscal": _padded("o.o_orderkey % 2500", 7),
    "cd_cnae_fiscal_secundario": "case when o.o_orderkey % 3 = 0"
    " then '0000001,0000002' else null end",
    "tipo_logradouro": "case cast(o.o_orderkey % 3 as int) when 0 then 'RUA'"
    " when 1 then 'AVENIDA' else null end",
    "logradouro": "o.o_orderpriority",
    "numero": "case when o.o_orderkey % 5 = 0 then 'SN'"
    " else cast(o.o_orderkey % 999 as string) end",
    "complemento": "case when o.o_orderkey % 4 = 0 then 'ANDAR 4; SALA 40' else null end",
    "bairro": "'CENTRO'",
    "cep": _padded("o.o_orderkey", 8),
    "uf": "case cast(o.o_orderkey % 3 as int) when 0 then 'BA' when 1 then 'SP' else 'RJ' end",
    "municipio": _padded("o.o_orderkey % 120", 4),
    "ddd1": _padded("o.o_orderkey % 90 + 10", 2),
    "telefone1": _padded("o.o_orderkey", 8, 3),
    "ddd2": "case when o.o_orderkey % 9 = 0 then '24' else null end",
    "telefone2": "case when o.o_orderkey % 9 = 0"
    f" then {_padded('o.o_custkey', 8, 2)} else null end",
    "ddd_fax": "case when o.o_orderkey % 10 = 0 then '24' else null end",
    "fax": "case when o.o_orderkey % 10 = 0"
    f" then {_padded('o.o_custkey', 8, 9)} else null end",
    "correio_eletronico": "'C' || cast(o.o_custkey as string) || '@MAIL.COM'",
    "cd_situacao_especial": "case when o.o_orderkey % 200 = 0 then 'FALIDO' else null end",
    "data_situacao_especial": f"case when o.o_orderkey % 200 = 0 then {_ORDER_DATE}"
    " else null end",
}


def establishments_sql(*fields: str) -> str:
    """Raw establishment fields, all of them by default, and ``id`` where asked for.

    ``numero`` is text here, as in a file. The customer join is there only if its field is.
    """
    fields = fields or tuple(ESTABLISHMENT_FIELDS)
    columns = {"id": "o.o_orderkey", **_ESTABLISHMENT}
    select = ",\n  ".join(f"{columns[f]} as {f}" for f in fields)
    named = "left join {customer} c on o.o_custkey = c.c_custkey"
    return f"select {select}\nfrom {{orders}} o {named if 'nome_fantasia' in fields else ''}"


REASONS_SQL = (
    f"select {_padded('n_nationkey', 2)} as codigo, 'RAZÃO ' || n_name as descricao from {{nation}}"
)
ACTIVITIES_SQL = (
    f"select {_padded('p_partkey', 7)} as codigo,"
    " 'DESCRIÇÃO ' || p_name as descricao from {part}"
)
COUNTRIES_SQL = (
    f"select {_padded('r_regionkey', 3)} as codigo, r_name as descricao from {{region}}"
)
MUNICIPALITIES_SQL = (
    f"select {_padded('s_suppkey', 4)} as codigo, s_name as descricao from {{supplier}}"
)

# Index pages: the order's month and its neighbours as folders in changing order, two folders of one
# month, and links that must not count: commented out, impossible month, no month, no href.
INDEX_PAGES_SQL = """
select page_id,
  '<html><!-- <a href="9999-12/">x</a> --><a name="9998-01">n</a><a href="/docs/">d</a>' ||
  '<a href="9997-13/">x</a><p><a class="m" href="' ||
  case cast(page_id % 3 as int)
    when 0 then before || '/">x</a><A HREF=''' || after || '/''>x</A><a href="' || during
    when 1 then after || '/">x</a><a href=' || during || '/>x</a><a href="' || before
    else during || '/">x</a><a href="' || during || '/b/">x</a><a href="' || before end ||
  '/">x</a></p></html>' as html
from (select o_orderkey as page_id,
    substr(cast(cast(o_orderdate as date) - 40 as string), 1, 7) as before,
    substr(cast(cast(o_orderdate as date) as string), 1, 7) as during,
    substr(cast(cast(o_orderdate as date) + 40 as string), 1, 7) as after
  from {orders}) t
"""

# Index pages of many dates by site, so that most of the months they list are not the newest.
SITE_PAGES_SQL = f"""
select o.o_custkey % 100 as site, p.html
from ({INDEX_PAGES_SQL}) p join {{orders}} o on p.page_id = o.o_orderkey
"""

# Saved snapshot pages, many for one month of a site, with wanted and unwanted files by order.
SNAPSHOT_PAGES_SQL = """
select 'https://h/' || cast(o_custkey % 100 as string) || '/' ||
  substr(cast(cast(o_orderdate as date) + 40 as string), 1, 7) || '/' as url,
  '<a href="Cnaes.zip">x</a><a href="leia.txt">x</a><a href="Estabelecimentos' ||
  cast(o_orderkey as string) || '.zip">x</a><a href="Empresas0.zip">x</a>' as html
from {orders}
"""

# Links by site, with a third of all links on one site, and links without a month.
SITE_LINKS_SQL = """
select case when o_orderkey % 3 = 0 then 0 else o_custkey end as site, o_orderkey as pos,
  case when o_orderkey % 10 = 1 then '/docs/'
    else substr(cast(cast(o_orderdate as date) as string), 1, 7) || '/' ||
      cast(o_orderkey as string) || '/' end as href
from {orders}
"""

# Download links with case and suffix traps.
LINKS_SQL = """
select o_orderkey as link_id,
  case cast(o_orderkey % 7 as int)
    when 0 then 'Cnaes.zip' when 1 then 'Motivos.zip'
    when 2 then concat('Estabelecimentos', cast(o_orderkey % 10 as string), '.zip')
    when 3 then concat('Empresas', cast(o_orderkey % 10 as string), '.zip')
    when 4 then 'CNAES.ZIP' when 5 then 'motivos.txt' else 'ESTABELECIMENTOS3.zip' end as href
from {orders}
"""

# One download per order, and the deliveries, with repeats, of the lines that have shipped.
ORDERED_FILES_SQL = (
    "select o_orderkey as link_id,"
    " concat('Estabelecimentos', cast(o_orderkey as string), '.zip') as file_name from {orders}"
)
SHIPPED_FILES_SQL = (
    "select concat('Estabelecimentos', cast(l_orderkey as string), '.zip') as file_name"
    " from {lineitem} where l_linestatus = 'F'"
)

# Ragged compact dates.
RAGGED_DATES_SQL = """
select o_orderkey as id, case cast(o_orderkey % 8 as int)
    when 0 then d when 1 then d || 'x' when 2 then substr(d, 1, 7) when 3 then d || '1'
    when 4 then '00000000' when 5 then '' when 6 then ' ' || d else substr(d, 1, 6) end as s
from (select o_orderkey, replace(cast(cast(o_orderdate as date) as string), '-', '') as d
      from {orders}) t
"""

_TABLE = re.compile(r"\{(\w+)\}")


def in_spark(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in _TABLE.findall(sql)}
    return spark.sql(sql, **tables)


def in_oracle(sql: str) -> str:
    return _TABLE.sub(r"\1", sql)


def write_delimited(df: DataFrame, folder: str, encoding: str = "UTF-8") -> None:
    """Headerless, every field quoted, as the published files are."""
    df.write.csv(folder, sep=FIELD_SEPARATOR, header=False, quoteAll=True, encoding=encoding)


def write_archives(df: DataFrame, folder: str, entity: str, encoding: str = "UTF-8") -> None:
    """One archive per partition, ``<entity><number>.zip``, with members of one to four shares of its lines."""
    line = F.to_csv(F.struct(*df.columns), {"sep": FIELD_SEPARATOR, "quoteAll": "true"})

    def zip_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"{entity}{task.partitionId()}.zip"
        system, root = locate(folder)
        system.create_dir(root, recursive=True)
        # Attempts of one task do not write the same file; the last to end names it.
        unfinished = f"{root}/_{name}.{task.taskAttemptId()}"
        rows = 0
        with (
            system.open_output_stream(unfinished) as sink,
            zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED) as archive,
        ):
            for number, batch in enumerate(batches):
                lines = batch.column("line").to_pylist()
                cuts = [0, len(lines) // 7, 3 * len(lines) // 7, len(lines)]
                for part, (start, end) in enumerate(itertools.pairwise(cuts)):
                    text = "".join(f"{line}\n" for line in lines[start:end])
                    archive.writestr(f"{name}.{number}.{part}.csv", text.encode(encoding))
                rows += len(lines)
        system.move(unfinished, f"{root}/{name}")
        yield pa.RecordBatch.from_pydict({"rows": pa.array([rows], pa.int64())})

    zipped = df.select(line.alias("line")).mapInArrow(zip_partition, "rows bigint")
    zipped.agg(F.sum("rows")).collect()


TABLES = {
    ESTABLISHMENTS: establishments_sql(),
    REASONS: REASONS_SQL,
    ACTIVITIES: ACTIVITIES_SQL,
    COUNTRIES: COUNTRIES_SQL,
    MUNICIPALITIES: MUNICIPALITIES_SQL,
}


def raw_folder(spark: SparkSession, sf_dir: str) -> str:
    """All five entities as delimited files, one folder each."""

    def write(root: str) -> None:
        for entity, sql in TABLES.items():
            write_delimited(
                in_spark(spark, sf_dir, sql), f"{root}/{entity.folder}", entity.encoding
            )

    return written_once(spark, "raw", sf_dir, write)


def split_folder(spark: SparkSession, sf_dir: str) -> str:
    """The establishments as two folders of files, head offices and the rest."""

    def write(root: str) -> None:
        facts = in_spark(spark, sf_dir, establishments_sql())
        head_office = F.col("cd_matriz_filial").eqNullSafe(1)
        write_delimited(facts.filter(head_office), f"{root}/head")
        write_delimited(facts.filter(~head_office), f"{root}/rest")

    return written_once(spark, "split", sf_dir, write)


#: The fewest archives of an entity, and how many rows each holds where there are more.
ARCHIVES, ARCHIVE_ROWS = 4, 250_000


def in_archives(df: DataFrame) -> DataFrame:
    """The rows dealt out over partitions, one for each archive; a larger table has more of them, not larger ones."""
    return df.repartition(max(ARCHIVES, -(-df.count() // ARCHIVE_ROWS)))


def archive_folder(spark: SparkSession, sf_dir: str) -> str:
    """The establishments and both code tables that the silver table needs, as archives."""

    def write(root: str) -> None:
        for entity in (ESTABLISHMENTS, REASONS, ACTIVITIES):
            df = in_archives(in_spark(spark, sf_dir, TABLES[entity]))
            write_archives(df, root, entity.folder, entity.encoding)

    return written_once(spark, "archives", sf_dir, write)


#: How many archives of establishments are laid down to be broken; of four the second is cut, the third changed.
FRAGILE = 12
_NOTE = b"dados abertos\n"


def fragile_folder(spark: SparkSession, sf_dir: str) -> str:
    """Archives ``Estabelecimentos<n>.zip`` by order, of which some are cut off and some have a byte changed.

    Each holds its lines as ``<n>.csv`` and a short note.
    """

    def write(root: str) -> None:
        line = F.to_csv(F.struct(*ESTABLISHMENT_FIELDS), {"sep": FIELD_SEPARATOR, "quoteAll": "true"})
        facts = in_spark(spark, sf_dir, establishments_sql("id", *ESTABLISHMENT_FIELDS))
        lines = facts.select((F.col("id") % FRAGILE).cast("int").alias("n"), line.alias("line"))

        def zip_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = ((r["n"], r["line"]) for batch in batches for r in batch.to_pylist())
            for n, group in itertools.groupby(rows, key=lambda row: row[0]):
                with tempfile.TemporaryFile() as file:
                    with zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED) as archive:
                        with archive.open(f"{n}.csv", "w") as member:
                            for _, text in group:
                                member.write(f"{text}\n".encode())
                        archive.writestr("note.txt", _NOTE)
                        info = archive.getinfo(f"{n}.csv")
                    size = file.seek(0, 2)
                    if n % 4 == 1:
                        file.truncate(2 * size // 3)
                    elif n % 4 == 2:
                        at = info.header_offset + 30 + len(info.filename) + info.compress_size // 2
                        file.seek(at)
                        changed = bytes([file.read(1)[0] ^ 0x10])
                        file.seek(at)
                        file.write(changed)
                    file.seek(0)
                    _put(root, f"{ESTABLISHMENTS.folder}{n}.zip", file)
                yield pa.RecordBatch.from_pydict({"n": pa.array([1], pa.int64())})

        grouped = lines.repartitionByRange(FRAGILE, "n").sortWithinPartitions("n")
        grouped.mapInArrow(zip_groups, "n bigint").agg(F.sum("n")).collect()

    return written_once(spark, "fragile", sf_dir, write)


def _put(folder: str, name: str, file: IO[bytes]) -> None:
    """A file of a shared folder, whole or not at all, whichever attempt of a task writes it."""
    system, root = locate(folder)
    system.create_dir(root, recursive=True)
    unfinished = f"{root}/_{name}.{TaskContext.get().taskAttemptId()}"
    with system.open_output_stream(unfinished) as sink:
        shutil.copyfileobj(file, sink)
    system.move(unfinished, f"{root}/{name}")


def repeated_folder(spark: SparkSession, sf_dir: str) -> str:
    """The archives of ``archive_folder``, each also under another name and with other names of its members."""

    def write(root: str) -> None:
        archives = list_archives(spark, archive_folder(spark, sf_dir)).select("archive", "entity")

        def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    number = re.search(r"(\d+)\.zip$", row["archive"])[1]
                    for first, prefix in ((1, ""), (2, "again-")):
                        with open_file(row["archive"]) as source, zipfile.ZipFile(source) as old, tempfile.TemporaryFile() as file:
                            with zipfile.ZipFile(file, "w", zipfile.ZIP_STORED if prefix else zipfile.ZIP_DEFLATED) as new:
                                for info in old.infolist():
                                    with old.open(info) as member, new.open(f"{prefix}{info.filename}", "w") as out:
                                        shutil.copyfileobj(member, out)
                            file.seek(0)
                            _put(root, f"{row['entity']}{first}{number}.zip", file)
                yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

        archives.repartition(max(8, archives.count())).mapInArrow(copy, "n bigint").agg(F.sum("n")).collect()

    return written_once(spark, "repeated", sf_dir, write)


def mixed_folder(spark: SparkSession, sf_dir: str) -> str:
    """The activities as files of which some are in UTF-8 and some in ISO-8859-1."""

    def write(root: str) -> None:
        activities = in_spark(spark, sf_dir, ACTIVITIES_SQL)
        for digit, encoding in enumerate(("UTF-8", "ISO-8859-1")):
            mine = activities.where(F.expr(f"cast(codigo as bigint) % 2 = {digit}"))
            write_delimited(mine.repartition(3), f"{root}/part{digit}", encoding)

    return written_once(spark, "mixed", sf_dir, write)


# Lines of five fields, two of them numbers, with faults by order. The text is put together here, so that
# both engines see the same bytes.
PLANTED_LINES_SQL = """
select id, n, case n
    when 1 then concat('"', name, '";S/N;"', city, '";', key, ';"z"')
    when 2 then concat('"', name, '";1;"', city, '";', key)
    when 3 then concat('"', name, '";1;"', city, '";', key, ';"z";"more"')
    when 4 then concat('"', name, chr(92), '";1;"', city, '";', key, ';"z"')
    when 5 then concat('"', name, '";1;"', city, '";', key, ';"z')
    when 6 then concat('"', name, '";007;"";3000000000;')
    when 7 then concat(name, ';;', city, '; 5;z')
    else concat('"', name, '";', key, ';"', city, '; A";', key, ';"z"') end as line
from (select o_orderkey as id, cast(o_orderkey % 11 as int) as n, cast(o_orderkey as string) as key,
    concat('C', cast(o_custkey as string)) as name, o_orderpriority as city from {orders}) t
"""
PLANTED_SCHEMA = StructType(
    [StructField(name, IntegerType() if name in ("number", "key") else StringType()) for name in ("name", "number", "city", "key", "mark")]
)


def planted_folder(spark: SparkSession, sf_dir: str) -> str:
    """The planted lines as text files."""

    def write(root: str) -> None:
        in_spark(spark, sf_dir, PLANTED_LINES_SQL).select("line").write.text(root)

    return written_once(spark, "planted", sf_dir, write)


def page_folder(spark: SparkSession, sf_dir: str) -> str:
    """The saved pages as files, ``<page_id>.html``."""

    def write(root: str) -> None:
        def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            system, folder = locate(root)
            system.create_dir(folder, recursive=True)
            for batch in batches:
                for page in batch.to_pylist():
                    with system.open_output_stream(f"{folder}/{page['page_id']}.html") as file:
                        file.write(page["html"].encode())
                yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

        pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html")
        pages.mapInArrow(save, "n bigint").agg(F.sum("n")).collect()

    return written_once(spark, "pages", sf_dir, write)


def spread(pages: DataFrame) -> DataFrame:
    """Small tables are one split, pages made of them should not be one task."""
    return pages.repartition(pages.sparkSession.sparkContext.defaultParallelism)
