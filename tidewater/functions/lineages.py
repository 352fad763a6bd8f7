"""Lineages as arrays of seven names (kingdom first, 'NA' where missing), as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions.scalars import _col, bound, trim_text

RANKS = ("kingdom", "phylum", "class", "order", "family", "genus", "species")
#: The prefix letter of each rank, and how it is written in a lineage's text. Fixed values.
PREFIXES, WRITTEN = "kpcofgs", "Kpcofgs"
NA = "NA"


def known(name) -> Column:
    """Null for a blank, NA or unassigned name."""
    return bound(trim_text(name), lambda trimmed: F.when(~F.lower(trimmed).isin("", "na", "unassigned"), trimmed))


def canonical_lineage(text) -> Column:
    """The seven names of a lineage's text: prefixed parts in rising order of rank, or just seven bare parts; null for any other."""
    letter = lambda p: F.position(F.lower(F.substring(p, 1, 1)), F.lit(PREFIXES)).cast("int") - 1
    place = lambda p: F.when(p.rlike("(?i)^[kpcofgs]__"), letter(p)).otherwise(-1)

    def by_prefix(parts: Column, places: Column) -> Column:
        name = lambda i: F.get(parts, F.array_position(places, i).cast("int") - 1)
        names = F.transform(F.sequence(F.lit(0), F.lit(6)), lambda i: F.coalesce(known(F.substring(name(i), 4, 1 << 20)), F.lit(NA)))
        return F.when((F.array_min(places) >= 0) & (F.array_sort(F.array_distinct(places)) == places), names)

    def named(whole: Column, parts: Column) -> Column:
        bare = F.when(F.size(parts) == 7, F.transform(parts, lambda p: F.coalesce(known(p), F.lit(NA))))
        prefixed = bound(F.transform(parts, place), lambda places: by_prefix(parts, places))
        names = F.when(whole.rlike(r"(^|;)\s*[A-Za-z]__"), prefixed).otherwise(bare)
        return bound(names, lambda x: F.when(known(whole).isNotNull() & ~F.exists(x, lambda y: y.rlike(r"[\t\r\n\x00]")), x))

    return bound(trim_text(text), lambda whole: bound(F.transform(F.split(whole, ";", -1), trim_text), lambda parts: named(whole, parts)))


def lineage_text(ranks) -> Column:
    return F.concat_ws(";", F.zip_with(F.array(*[F.lit(f"{x}__") for x in WRITTEN]), _col(ranks), lambda a, b: F.concat(a, b)))


def lineage_depth(ranks) -> Column:
    """The place of the deepest known name; -1 for none."""
    return F.coalesce(F.array_max(F.transform(_col(ranks), lambda x, i: F.when(x != NA, i).otherwise(-1))), F.lit(-1))


def cut_to(ranks, depth) -> Column:
    """The names down to a depth, NA below."""
    return F.transform(_col(ranks), lambda x, i: F.when(i <= depth, x).otherwise(NA))


def conflicts(a, b) -> Column:
    """Places where both lineages have a name and these differ, '_' being a space."""
    plain = lambda x: F.translate(x, "_", " ")
    differ = lambda x, y: (x != NA) & (y != NA) & (plain(x) != plain(y))
    return bound(a, lambda a: bound(b, lambda b: F.filter(F.sequence(F.lit(0), F.lit(6)), lambda i: differ(a[i], b[i]))))


def one_sided(a, b) -> Column:
    """Places where one lineage alone has a name."""
    return bound(a, lambda a: bound(b, lambda b: F.filter(F.sequence(F.lit(0), F.lit(6)), lambda i: (a[i] == NA) != (b[i] == NA))))


def is_assigned_lineage(text) -> Column:
    """Whether any part of a lineage is neither blank nor unassigned, with or without a prefix."""
    empty = lambda p: F.lower(trim_text(p)).rlike(r"^(([a-z]__)?unassigned)?$")
    return bound(trim_text(text), lambda whole: (whole != "") & (F.upper(whole) != NA) & F.exists(F.split(whole, ";"), lambda p: ~empty(p)))


def lineage_rank(text, prefix: str) -> Column:
    """The name after the first part with the prefix ('f__'); '' without one."""
    held = F.filter(F.split(_col(text), ";"), lambda p: F.startswith(trim_text(p), F.lit(prefix)))
    return F.coalesce(F.substring(trim_text(F.get(held, F.lit(0))), len(prefix) + 1, 1 << 20), F.lit(""))


def lineage_columns(text) -> list[Column]:
    """Seven columns, kingdom to species: the parts of a lineage without their prefixes; null where there is no part."""
    parts = F.split(F.regexp_replace(_col(text), r"(^|[;\t])[kpcofgsKPCOFGS]__", "$1"), ";")
    return [F.get(parts, F.lit(i)).alias(name) for i, name in enumerate(RANKS)]
