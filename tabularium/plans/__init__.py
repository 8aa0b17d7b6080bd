from tabularium.plans.manifest import build_manifest
from tabularium.plans.silver import (
    CODE_COLUMNS,
    build_silver,
    derive,
    load_silver,
    refresh_silver,
    silver_counts,
    silver_from_folder,
)

__all__ = [
    "CODE_COLUMNS",
    "build_manifest",
    "build_silver",
    "derive",
    "load_silver",
    "refresh_silver",
    "silver_counts",
    "silver_from_folder",
]
