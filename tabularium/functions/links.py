"""Column expressions over listing pages, links and archive names."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, functions as F

from tabularium.layouts import ARCHIVE_TAIL_PATTERN, SNAPSHOT_PATTERN

# One attribute. Possessive quantifiers keep the matcher from recursing on long or broken tags.
_VALUE = r"""(?:'[^']*+'|"[^"]*+"|(?!['"])[^>\s]*+)"""
_ATTRIBUTE = rf"[^\s/>][^\s/=>]*+(?:\s*+=++\s*+{_VALUE})?+"
_ATTRIBUTES = rf"(?:[\s/]++|{_ATTRIBUTE})*+"
_HREF = rf"href(?=[\s/=>])(?:\s*+=++\s*+{_VALUE})?+"
# All markup is matched, in one pass, so that nothing inside comments, scripts, styles or
# attributes of other tags is taken for an anchor. Only an anchor's href attribute is captured, of
# repeated ones the last, and only after a look ahead that the tag ends.
_ANCHOR = (
    r"(?is)<(?:!--(?:-?>|.*?(?:--!?>|\z))"
    rf"|script(?=[\s/>]){_ATTRIBUTES}>.*?(?:</script\s*>|\z)"
    rf"|style(?=[\s/>]){_ATTRIBUTES}>.*?(?:</style\s*>|\z)"
    rf"|a(?=[\s/])(?={_ATTRIBUTES}>)(?:[\s/]++|({_HREF})|{_ATTRIBUTE})*+>"
    rf"|[a-z][^\s/>]*+{_ATTRIBUTES}(?:>|\z))"
)
# The first thing that looks like a snapshot, if it is a month.
_MONTH = r"(?s)^(?>.*?(\d{4}-\d{2}))(?<=-(?:0[1-9]|1[0-2]))(?<!0000-\d\d)"
# The value of an attribute as it was captured: after its name, equals signs and opening quote.
_VALUE_OF = r"(?s)^.{4}\s*+=*+\s*+(['\"]?+)(.*)\1$"

# Named character references are those of the standard library, with and without semicolon; the
# commonest come first, as a map is searched from its start.
_COMMON = ("amp;", "amp", "lt;", "gt;", "quot;", "nbsp;", "apos;")
_NAMED = json.dumps({name: html5[name] for name in dict.fromkeys([*_COMMON, *html5])})
# Names that count without semicolon, even with more letters behind; the longest that fits.
_OPEN = sorted((name for name in html5 if not name.endswith(";")), key=lambda n: (-len(n), n))
_REFERENCE = r"^(#[0-9]++;?|#[xX][0-9a-fA-F]++;?|[^\t\n\f <&#;]{1,32};?)"
# Numbers that stand for another character, by the rule that old pages mean Windows-1252.
_WINDOWS = {
    point: bytes([point]).decode("cp1252", errors="ignore") or chr(point) for point in range(0x80, 0xA0)
}
_MAPPED = json.dumps({str(point): text for point, text in {0: "\ufffd", 13: "\r", **_WINDOWS}.items()})


def _value(attribute: Column) -> Column:
    return F.regexp_extract(attribute, _VALUE_OF, 2)


def _map(json_text: str) -> Column:
    return F.from_json(F.lit(json_text), "map<string, string>")


def _is_no_character(point: Column) -> Column:
    """Control characters and code points that are never assigned; they are left out."""
    return (
        point.between(0x1, 0x8)
        | point.between(0xE, 0x1F)
        | (point == 0xB)
        | (point == 0x7F)
        | point.between(0xFDD0, 0xFDEF)
        | (point.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    )


def _numbered(reference: Column) -> Column:
    """The character of ``#`` and decimal digits, or ``#x`` and hexadecimal ones, however many."""
    hexadecimal = F.lower(F.substring(reference, 2, 1)) == "x"
    digits = F.regexp_extract(reference, "^#[xX]?0*([0-9a-fA-F]*)", 1)
    number = F.when(
        hexadecimal, F.conv(F.when(F.length(digits) <= 6, digits), 16, 10).cast("int")
    ).otherwise(F.when(F.length(digits) <= 7, digits).cast("int"))
    point = F.when(digits == "", F.lit(0)).otherwise(F.coalesce(number, F.lit(0x110000)))
    unknown = point.between(0xD800, 0xDFFF) | (point > 0x10FFFF)
    encoded = F.unhex(F.lpad(F.hex(F.when(unknown, 0xFFFD).otherwise(point)), 8, "0"))
    return F.coalesce(
        F.try_element_at(_map(_MAPPED), point.cast("string")),
        F.when(_is_no_character(point) & ~unknown, F.lit("")),
        F.decode(encoded, "UTF-32"),
    )


def _decode_references(value: Column) -> Column:
    """Decode character references from left to right, so that nothing is decoded twice."""

    def decode(part: Column, i: Column) -> Column:
        reference = F.regexp_extract(part, _REFERENCE, 1)
        rest = F.substring(part, F.length(reference) + 1, F.length(part))
        opening = F.regexp_extract(part, f"^({'|'.join(_OPEN)})", 1)
        named = F.coalesce(
            F.concat(F.try_element_at(_map(_NAMED), reference), rest),
            F.concat(
                F.try_element_at(_map(_NAMED), opening),
                F.substring(part, F.length(opening) + 1, F.length(part)),
            ),
            F.concat(F.lit("&"), part),
        )
        plain = F.when(i == 0, part).when(reference == "", F.concat(F.lit("&"), part))
        return plain.when(reference.startswith("#"), F.concat(_numbered(reference), rest)).otherwise(named)

    parts = F.transform(F.split(value, "&"), decode)
    return F.when(value.contains("&"), F.array_join(parts, "")).otherwise(value)


def hrefs(html: Column) -> Column:
    """The href of every anchor that has one, in page order, as an array.

    A scan with one regular expression, not an HTML parser, but it walks tags and attributes as one
    does: quoted, unquoted and empty values, and no anchors in comments, scripts, styles or
    attributes. Character references are decoded, named and numbered ones, also without their
    semicolon. A comment that stays open hides the rest.
    """
    values = F.array_remove(F.regexp_extract_all(html, F.lit(_ANCHOR), F.lit(1)), "")
    # One step each, because an expression used twice inside a step is computed twice.
    for step in (_value, _decode_references):
        values = F.transform(values, step)
    return values


def last_month(path: Column) -> Column:
    """The last ``YYYY-MM`` in a path; empty if there is none."""
    return F.regexp_extract(path, rf"(?s)^.*({SNAPSHOT_PATTERN})", 1)


def month_text(link: Column) -> Column:
    """The first ``YYYY-MM`` in a link; empty if there is none or it is no month."""
    return F.regexp_extract(link, _MONTH, 1)


def snapshot_month(link: Column) -> Column:
    """First day of the first ``YYYY-MM`` in a link; NULL if there is none or it is no month."""
    return F.concat(month_text(link), F.lit("-01")).try_cast("date")


def file_name(link: Column) -> Column:
    """What follows the last slash."""
    return F.substring_index(link, "/", -1)


def entity_name(archive: Column) -> Column:
    """An archive's name without its trailing digits and suffix; case is kept."""
    return F.regexp_replace(archive, ARCHIVE_TAIL_PATTERN, "")
