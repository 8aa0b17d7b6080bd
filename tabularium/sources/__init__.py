from tabularium.sources.archives import (
    BrokenArchives,
    archived_lines,
    archived_rows,
    check_archives,
    extract_archives,
    list_archives,
    read_members,
    refuse_broken,
)
from tabularium.sources.checked import count_faults, quarantine, read_checked, write_checked
from tabularium.sources.delimited import read_delimited
from tabularium.sources.encodings import file_encodings, read_mixed
from tabularium.sources.entities import AUTO, check_entity, read_entity
from tabularium.sources.files import list_files, read_pages
from tabularium.sources.silver import publish_silver, read_silver, write_silver
from tabularium.sources.versions import current_version, publish, vacuum, versions

__all__ = [
    "AUTO",
    "BrokenArchives",
    "archived_lines",
    "archived_rows",
    "check_archives",
    "check_entity",
    "count_faults",
    "current_version",
    "extract_archives",
    "file_encodings",
    "list_archives",
    "list_files",
    "publish",
    "publish_silver",
    "quarantine",
    "read_checked",
    "read_delimited",
    "read_entity",
    "read_members",
    "read_mixed",
    "read_pages",
    "read_silver",
    "refuse_broken",
    "vacuum",
    "versions",
    "write_checked",
    "write_silver",
]
