"""Column expressions of the establishment table. All are built-in Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tabularium.layouts import BRANCH, HEAD_OFFICE, HEAD_OFFICE_CODE, STATUS_DEFAULT, STATUS_LABELS


def full_id(root: Column, order: Column, check: Column) -> Column:
    """The 14-digit id from its 8, 4 and 2 digit parts; NULL if any part is."""
    return F.concat(root, order, check)


def branch_label(code: Column) -> Column:
    """Head office for code 1; everything else, NULL too, is a branch."""
    return F.when(code.eqNullSafe(HEAD_OFFICE_CODE), HEAD_OFFICE).otherwise(BRANCH)


def status_label(code: Column) -> Column:
    """Label of a two-digit registration status; unknown, unpadded and NULL codes get the default.
    """
    labels = [F.when(code == value, text) for value, text in STATUS_LABELS.items()]
    return F.coalesce(*labels, F.lit(STATUS_DEFAULT))


# Four year digits (not year 0), two month digits, then all remaining digits are the day.
_RAGGED_DATE = r"(?s)^(?!0000)(\d{4})(\d{2})0*([1-9]\d?)(?!\d).*$"


def compact_date(text: Column, mode: str = "legacy") -> Column:
    """Parse ``yyyyMMdd`` text; bad input is NULL and never fails the job.

    ``mode="strict"`` takes exactly eight digits. ``mode="legacy"`` also takes what the
    ``LEGACY`` time parser policy takes: trailing text after the day, and a day of one
    or of more than two digits. It needs no session setting. Known differences from that
    policy: blanks, signs or non-ASCII digits inside are NULL here, 5 to 14 October 1582 are
    ordinary days here, and 29 February of the Julian-only leap years is NULL here.

    Nearly all values are well-formed or plainly empty, so the eight-character case goes through the
    cheap ISO date cast, and the regular expressions run only where that yields nothing.
    """
    if mode not in ("legacy", "strict"):
        raise ValueError(f"mode must be 'legacy' or 'strict', not {mode!r}")
    year = F.substring(text, 1, 4)
    iso = F.concat_ws("-", year, F.substring(text, 5, 2), F.substring(text, 7, 2))
    if mode == "strict":
        return F.when(text.rlike(r"^\d{8}\z"), iso.try_cast("date"))
    plain = F.when((F.length(text) == 8) & (year != "0000"), iso.try_cast("date"))
    ragged = F.regexp_replace(text, _RAGGED_DATE, "$1-$2-$3").try_cast("date")
    return F.coalesce(plain, F.when(text.rlike(_RAGGED_DATE), ragged))
