"""Bibliographic identifiers in running text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.arrays import let

# One pattern per kind of identifier, group 1 is the value.
# "(?iU)" ignores case and reads \d and \s as Unicode classes; the letter i is
# spelt out because Java would also fold the dotless and the dotted capital i.
PATTERNS: Mapping[str, str] = {
    "isbn": (
        r"(?iU)(?-i:[Ii])SBN(?:-1[03])?(?::?\s*)?\s"
        r"((?:97[89][- ]?)?\d{1,5}[- ]?(?:\d+[- ]?){2}(?:\d|X))"
    ),
    "issn": r"(?iU)(?-i:[Ii])SSN(?::?\s*)?\s(\d{4}-\d{4})",
    "ddc": r"(?iU)DDC\s+(\d{3}(?:\.\d+))(?:—dc23)",
    "orcid": r"(?iU)(?:https?://orc(?-i:[Ii])d\.org/)(\d{4}-\d{4}-\d{4}-\d{3}(?:\d|X))",
    "isni": r"(?U)(?:https?://isni\.org/isni/)(\d{15}(?:\d|X))",
}


MATCH = "struct<type:string,value:string,start:bigint,end:bigint>"


def any_reference(text: Column, patterns: Mapping[str, str] = PATTERNS) -> Column:
    """True if at least one pattern occurs."""
    return text.rlike("|".join(f"(?:{p})" for p in patterns.values()))


def reference_matches(text: Column, kind: str, pattern: str) -> Column:
    """Array of matches: kind, value, first byte and the byte after the last.

    The text is read for the matches, for their values and for the pieces
    between them, so a pattern may look around itself. Positions are summed up
    within the row. A pattern that matches the empty string fails the job.
    """
    found = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(1)).alias("value"),
    )
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.octet_length(g))
    empty = F.raise_error(F.lit(f"the pattern of {kind} matches the empty string")).cast("int")

    def located(hits: Column, widths: Column) -> Column:
        pieces = F.arrays_zip(hits.alias("m"), F.slice(widths, F.lit(1), F.size(hits)).alias("gap"))
        start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{MATCH}>").alias("out"))

        def step(state: Column, piece: Column) -> Column:
            first = state["at"] + piece["gap"]
            width = F.when(piece["m"]["hit"] == "", empty).otherwise(F.octet_length(piece["m"]["hit"]))
            match = F.struct(
                F.lit(kind).alias("type"),
                piece["m"]["value"].alias("value"),
                first.alias("start"),
                (first + width).alias("end"),
            )
            return F.struct((first + width).alias("at"), F.array_append(state["out"], match.cast(MATCH)).alias("out"))

        return F.aggregate(pieces, start, step, lambda state: state["out"])

    return let(found, lambda hits: let(gaps, lambda widths: located(hits, widths)))
