from tabularium.functions.links import entity_name, file_name, hrefs, snapshot_month
from tabularium.functions.registry import branch_label, compact_date, full_id, status_label

__all__ = [
    "branch_label",
    "compact_date",
    "entity_name",
    "file_name",
    "full_id",
    "hrefs",
    "snapshot_month",
    "status_label",
]
