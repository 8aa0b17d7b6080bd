from tabularium.operators.counts import Counts
from tabularium.operators.filters import filter_activity, wanted_files
from tabularium.operators.listings import extract_links, latest_snapshot, newest_link
from tabularium.operators.loads import is_complete, missing_files
from tabularium.operators.lookup import few_used, hot_codes, lookup, used_codes

__all__ = [
    "Counts",
    "extract_links",
    "few_used",
    "filter_activity",
    "hot_codes",
    "is_complete",
    "latest_snapshot",
    "lookup",
    "missing_files",
    "newest_link",
    "used_codes",
    "wanted_files",
]
