"""The folders of entities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabularium.layouts import Entity
from tabularium.sources.checked import read_checked
from tabularium.sources.delimited import read_delimited
from tabularium.sources.encodings import read_mixed
from tabularium.sources.files import exists

#: Instead of an encoding: tell that of each file by its bytes.
AUTO = "auto"


def read_entity(
    spark: SparkSession, root: str, entity: Entity, encoding: str | None = None, **options
) -> DataFrame:
    """Read an entity's folder below ``root``, in the entity's own encoding unless told otherwise.

    That is ``<root>/<entity>``, or ``<root>/entity=<entity>`` as ``extract_archives`` writes it.
    Both or neither is an error, so that nothing is read twice or taken for empty. With ``auto`` each file is
    read in the encoding that its bytes tell (see ``file_encodings``), which is one more scan.
    """
    folder = entity_folder(spark, root, entity)
    if encoding == AUTO:
        return read_mixed(spark, folder, entity.schema, **options)
    return read_delimited(spark, folder, entity.schema, encoding or entity.encoding, **options)


def check_entity(
    spark: SparkSession, root: str, entity: Entity, encoding: str | None = None, **options
) -> DataFrame:
    """``read_checked`` of an entity's folder below ``root``."""
    folder = entity_folder(spark, root, entity)
    return read_checked(spark, folder, entity.schema, encoding or entity.encoding, **options)


def entity_folder(spark: SparkSession, root: str, entity: Entity) -> str:
    """The one folder of an entity below ``root``."""
    folders = (f"{root}/{entity.folder}", f"{root}/entity={entity.folder}")
    found = [folder for folder in folders if exists(spark, folder)]
    if len(found) != 1:
        raise FileNotFoundError(f"{len(found)} folders of {entity.folder} in {root}, not one")
    return found[0]
