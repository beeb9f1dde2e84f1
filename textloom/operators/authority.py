"""Authority vocabulary: authorities that enough records link to."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.records import (
    AUTHORITY_TAG,
    LINK_CODES,
    LINK_TAG,
    authority_kind,
    is_authority,
    subfield_values,
)


@dataclass(frozen=True)
class LinkRule:
    """Where a record names the authorities it links to.

    By default: codes 9 and a of every 041A field that has a 9. ``where`` is a
    predicate on the fields; records that fail it are left out of this rule.
    """

    tag: str = LINK_TAG
    codes: Sequence[str] = LINK_CODES
    occurrence: str | None = "*"
    having: str | None = "9"
    where: Callable[[Column], Column] | None = None


def authorities(
    records: DataFrame,
    uri_base: str,
    record_filter: Callable[[Column], Column] = is_authority,
    order_by: str | None = None,
) -> DataFrame:
    """Authority records: ppn, uri, label, notation, kind; one row per identifier.

    With ``order_by`` the last record of an identifier wins. Without it, and
    among records of equal order, the greatest kind does. It is a running
    maximum, so copies of one identifier never meet in one task unreduced.
    """
    fields = F.col("fields")
    code = F.get(subfield_values(fields, AUTHORITY_TAG, ["0"]), F.lit(0))
    order = F.col(order_by) if order_by else F.lit(0)
    found = records.where(record_filter(fields)).select(
        F.col("record_id").alias("ppn"), authority_kind(code).alias("kind"), order.alias("seq")
    )
    found = found.groupBy("ppn").agg(F.max(F.struct("seq", "kind"))["kind"].alias("kind"))
    return found.select("ppn", *authority_columns(F.col("ppn"), uri_base), "kind")


def authority_columns(ppn: Column, uri_base: str) -> list[Column]:
    """URI, fallback label and empty notation of an authority."""
    return [
        F.concat(F.lit(uri_base), ppn).alias("uri"),
        F.concat(F.lit("PPN: "), ppn).alias("label"),
        F.lit("").alias("notation"),
    ]


def record_links(
    records: DataFrame,
    rules: Sequence[LinkRule] = (LinkRule(),),
    record_filter: Callable[[Column], Column] = is_authority,
) -> DataFrame:
    """Distinct link targets of each record that is no authority, within its row."""
    fields = F.col("fields")

    def targets(rule: LinkRule) -> Column:
        values = subfield_values(fields, rule.tag, rule.codes, rule.occurrence, rule.having)
        if rule.where is None:
            return values
        return F.when(rule.where(fields), values).otherwise(F.array().cast("array<string>"))

    none = F.array().cast("array<string>")
    every = F.array_distinct(F.concat(*[targets(r) for r in rules]))
    # The record filter is part of the array, not of a filter before it, so
    # that nested fields are built once where they are computed.
    linked = F.when(record_filter(fields), none).otherwise(every)
    return records.select("record_id", F.explode_outer(linked).alias("target")).where(
        F.col("target").isNotNull() & (F.col("target") != "")
    )


def link_counts(links: DataFrame, distinct: bool = True) -> DataFrame:
    """Records per target.

    ``distinct`` says that each pair of record and target occurs once, as
    ``record_links`` gives them. Else repeated pairs are removed first; that
    shuffle is on the pair, so a popular target is spread.
    """
    if not distinct:
        links = links.select("record_id", "target").distinct()
    return links.groupBy("target").agg(F.count("*").alias("links"))


def threshold(
    found: DataFrame, counts: DataFrame, thresholds: Mapping[str, int]
) -> DataFrame:
    """Authorities with at least as many links as their kind asks for, by identifier.

    A kind without a threshold is kept whole.
    """
    joined = found.join(counts, F.col("ppn") == F.col("target"), "left").drop("target")
    linked = joined.withColumn("links", F.coalesce("links", F.lit(0)))
    needed = F.lit(0)
    for kind, least in thresholds.items():
        needed = F.when(F.col("kind") == kind, F.lit(least)).otherwise(needed)
    return linked.where(F.col("links") >= needed).orderBy("ppn")


def authority_vocabulary(
    records: DataFrame,
    uri_base: str,
    rules: Sequence[LinkRule] = (LinkRule(),),
    thresholds: Mapping[str, int] | None = None,
    order_by: str | None = None,
) -> DataFrame:
    """The whole derivation, from records to the vocabulary."""
    return threshold(
        authorities(records, uri_base, order_by=order_by),
        link_counts(record_links(records, rules)),
        thresholds or {},
    )
