"""Expressions over bibliographic records held as nested rows.

A record is ``record_id`` and ``fields``, an array of tag, occurrence and an
array of coded subfields.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

RECORD_SCHEMA = (
    "record_id string, fields array<struct<tag: string, occurrence: string, "
    "subfields: array<struct<code: string, value: string>>>>"
)

# The kind of an authority by the first two letters of its code.
AUTHORITY_KINDS = {
    "Tb": "corporate-body",
    "Tf": "conference",
    "Tg": "place-or-geo-name",
    "Tp": "person",
    "Ts": "subject-heading",
    "Tu": "work",
}
AUTHORITY_TAG = "002@"
AUTHORITY_PATTERN = "^T[bfgpsu][1z]$"
LINK_TAG = "041A"
LINK_CODES = ("9", "a")
SIMILARITY_THRESHOLD = 0.8


def _is_field(field: Column, tag: str, occurrence: str | None) -> Column:
    same = field["tag"] == tag
    if occurrence == "*":
        return same
    if occurrence is None:
        return same & F.coalesce(field["occurrence"], F.lit("")).isin("", "00")
    return same & (field["occurrence"] == occurrence)


def any_subfield(
    fields: Column,
    tag: str,
    code: str,
    test: Callable[[Column], Column],
    occurrence: str | None = None,
) -> Column:
    """True if a field of that tag has a subfield of that code that passes the test."""
    return F.exists(
        fields,
        lambda f: _is_field(f, tag, occurrence)
        & F.exists(f["subfields"], lambda s: (s["code"] == code) & test(s["value"])),
    )


def is_authority(fields: Column) -> Column:
    """The default record filter: one code that starts with T and has the known form."""
    return any_subfield(
        fields, AUTHORITY_TAG, "0", lambda v: v.startswith("T") & v.rlike(AUTHORITY_PATTERN)
    )


def subfield_values(
    fields: Column,
    tag: str,
    codes: Sequence[str],
    occurrence: str | None = None,
    having: str | None = None,
) -> Column:
    """Values of the subfields with these codes, in record order.

    With ``having``, only fields that hold a subfield of that code count.
    """

    def wanted(f: Column) -> Column:
        ok = _is_field(f, tag, occurrence)
        if having is not None:
            ok = ok & F.exists(f["subfields"], lambda s: s["code"] == having)
        return ok

    return F.flatten(
        F.transform(
            F.filter(fields, wanted),
            lambda f: F.transform(
                F.filter(f["subfields"], lambda s: s["code"].isin(list(codes))),
                lambda s: s["value"],
            ),
        )
    )


def authority_kind(code: Column) -> Column:
    """Kind of an authority for its code; the job fails on an invalid one."""
    kind = F.element_at(
        F.create_map(*[F.lit(x) for pair in AUTHORITY_KINDS.items() for x in pair]),
        F.substring(code, 1, 2),
    )
    return (
        F.when(code.isNull(), F.raise_error(F.lit("authority without a code")))
        .when(F.octet_length(code) < 3, F.raise_error(F.concat(F.lit("invalid code: "), code)))
        .when(kind.isNull(), F.raise_error(F.concat(F.lit("invalid kind: "), code)))
        .otherwise(kind)
    )


def similarity(left: Column, right: Column, ignore_case: bool = False) -> Column:
    """Edit similarity between 0 and 1; 1 for two empty strings."""
    if ignore_case:
        left, right = F.lower(left), F.lower(right)
    longest = F.greatest(F.char_length(left), F.char_length(right))
    return F.when(longest == 0, 1.0).otherwise(1 - F.levenshtein(left, right) / longest)


def similar(
    left: Column,
    right: Column,
    threshold: float = SIMILARITY_THRESHOLD,
    ignore_case: bool = False,
) -> Column:
    return similarity(left, right, ignore_case) >= threshold
