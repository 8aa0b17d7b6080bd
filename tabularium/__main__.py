"""The stages as jobs: ``spark-submit`` this file, or ``python -m tabularium``, with a stage name.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession, functions as F

from tabularium.functions.links import last_month, month_text
from tabularium.layouts import DENTAL_ACTIVITIES, ENTITIES, ESTABLISHMENTS, WANTED_ENTITIES
from tabularium.operators import extract_links, latest_snapshot, missing_files, wanted_files
from tabularium.plans import build_manifest, load_silver, refresh_silver
from tabularium.sources import (
    check_archives,
    check_entity,
    extract_archives,
    list_files,
    read_pages,
    write_checked,
)


def latest(spark: SparkSession, args) -> int:
    """Write the newest snapshot folder on each saved index page."""
    latest_snapshot(read_pages(spark, args.pages), args.base).write.mode("overwrite").parquet(args.target)
    return 0


def manifest(spark: SparkSession, args) -> int:
    """Write the files to download, from saved snapshot pages.

    With index pages, those of the newest snapshot only; the snapshot of a page is then the month in
    the name of its file or folder.
    """
    if args.index is None:
        wanted = wanted_files(extract_links(read_pages(spark, args.pages)), args.base, args.entities)
    else:
        pages = read_pages(spark, args.pages, recursive=True)
        url = F.concat(F.lit(args.base), month_text(last_month(F.col("path"))), F.lit("/"))
        pages = pages.select(url.alias("url"), "html")
        wanted = build_manifest(read_pages(spark, args.index), pages, args.base, args.entities)
    wanted.write.mode("overwrite").parquet(args.target)
    return 0


def missing(spark: SparkSession, args) -> int:
    """Write what of a manifest has not landed; fail if anything has not."""
    absent = missing_files(spark.read.parquet(args.manifest), list_files(spark, args.archives))
    absent.select("file_name", "url").write.mode("overwrite").parquet(args.target)
    return 0 if spark.read.parquet(args.target).isEmpty() else 1


def verify(spark: SparkSession, args) -> int:
    """Write which archives are whole; fail if any is not."""
    check_archives(spark, args.archives, args.entities).write.mode("overwrite").parquet(args.target)
    return 0 if spark.read.parquet(args.target).where("fault is not null").isEmpty() else 1


def rejects(spark: SparkSession, args) -> int:
    """Write an entity's sound and faulty lines apart, and print the counts; fail if too many have faults."""
    entity = ENTITIES[args.entity]
    checked = check_entity(spark, args.source, entity, args.encoding, escape=args.escape)
    counts = write_checked(checked, args.target, entity.schema)
    for name, n in counts.items():
        print(f"{name}\t{n}")
    return 0 if args.most is None or counts["faulty"] <= args.most else 1


def extract(spark: SparkSession, args) -> int:
    """Extract archives into entity folders."""
    extract_archives(spark, args.archives, args.target, args.entities, distinct=args.distinct)
    return 0


def transform(spark: SparkSession, args) -> int:
    """Entity folders to silver table."""
    layout = {"by": args.by, "cluster": args.cluster, "blooms": args.blooms}
    load_silver(
        spark, args.source, args.target, args.documented, args.counts, args.retain, layout, **_options(args)
    )
    return 0


def refresh(spark: SparkSession, args) -> int:
    """Archives to silver table."""
    manifest = args.manifest and spark.read.parquet(args.manifest)
    refresh_silver(
        spark,
        args.archives,
        args.extracted,
        args.target,
        by=args.by,
        documented=args.documented,
        manifest=manifest,
        verify=not args.unverified,
        distinct=args.distinct,
        retain=args.retain,
        cluster=args.cluster,
        blooms=args.blooms,
        counts=args.counts,
        **_options(args),
    )
    return 0


def _options(args) -> dict:
    return {
        "only_activities": args.activities,
        "dates": args.dates,
        "encodings": dict(pair.split("=", 1) for pair in args.encodings),
        "escape": args.escape,
        "hot": _hot(args.hot),
    }


def _hot(pairs: list[str]) -> dict[str, list[str | None]]:
    """``COLUMN=CODE`` pairs by column; no code stands for NULL."""
    hot: dict[str, list[str | None]] = {}
    for pair in pairs:
        column, _, code = pair.partition("=")
        hot.setdefault(column, []).append(code or None)
    return hot


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tabularium")
    stages = parser.add_subparsers(required=True)

    def stage(run, *positional):
        sub = stages.add_parser(run.__name__, help=run.__doc__)
        sub.set_defaults(run=run)
        for name in positional:
            sub.add_argument(name)
        return sub

    stage(latest, "pages", "base", "target")
    files = stage(manifest, "pages", "base", "target")
    files.add_argument("--entities", nargs="+", default=WANTED_ENTITIES)
    files.add_argument("--index", help="saved index pages, to take the newest snapshot only")
    stage(missing, "manifest", "archives", "target")
    stage(verify, "archives", "target").add_argument("--entities", nargs="+")
    faulty = stage(rejects, "source", "target")
    faulty.add_argument("--entity", default=ESTABLISHMENTS.folder, choices=ENTITIES)
    faulty.add_argument("--encoding", help="if not the entity's own")
    faulty.add_argument("--escape", default="\\", help="what escapes a quote in a quoted field")
    faulty.add_argument("--most", type=int, help="fail if more lines than these have faults")
    extracted = stage(extract, "archives", "target")
    extracted.add_argument(
        "--entities", nargs="+", help="one job for each, all at once, without sorting; otherwise one for all"
    )
    whole = stage(refresh, "archives", "extracted", "target")
    whole.add_argument("--manifest", help="start only if all of its files have landed")
    whole.add_argument("--unverified", action="store_true", help="do not read the archives through first")
    for sub in (extracted, whole):
        sub.add_argument("--distinct", action="store_true", help="take a member that an entity has twice once")
    for sub in (stage(transform, "source", "target"), whole):
        sub.add_argument("--counts", metavar="PATH", help="where to leave the counts of the load")
        sub.add_argument(
            "--retain", type=int, help="publish the table by versions and keep so many; otherwise it is overwritten"
        )
        sub.add_argument("--cluster", nargs="*", default=[], metavar="COLUMN", help="order the rows for readers that filter by these")
        sub.add_argument("--blooms", nargs="*", default=[], metavar="COLUMN", help="columns that get Bloom filters")
        sub.add_argument("--by", help="partition the table by this column, such as uf")
        sub.add_argument("--documented", action="store_true", help="the 37-column layout")
        sub.add_argument("--dates", choices=("legacy", "strict"), default="legacy")
        sub.add_argument(
            "--encodings", nargs="*", default=[], metavar="ENTITY=ENCODING", help="if not the usual; auto tells it by the bytes"
        )
        sub.add_argument(
            "--hot", nargs="*", default=[], metavar="COLUMN=CODE", help="codes that hold a large share of rows"
        )
        sub.add_argument("--escape", default="\\", help="what escapes a quote in a quoted field")
        sub.add_argument(
            "--activities",
            nargs="*",
            help=f"keep these main activities only; without values {' '.join(DENTAL_ACTIVITIES)}",
        )
    return parser


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(arguments)
    if getattr(args, "activities", None) == []:
        args.activities = DENTAL_ACTIVITIES
    return args.run(spark or SparkSession.builder.appName("tabularium").getOrCreate(), args)


if __name__ == "__main__":
    sys.exit(main())
