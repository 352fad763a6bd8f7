"""Scalar functions over read headers, sample labels and sequences, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def bound(x, use) -> Column:
    """use(x) with x evaluated once: an expression that a lambda refers to is otherwise evaluated anew for each element and mention."""
    return F.get(F.transform(F.array(_col(x)), use), F.lit(0))


def trim_text(x) -> Column:
    """'' for null; white space of any kind stripped from both ends."""
    return F.regexp_replace(F.coalesce(_col(x), F.lit("")), r"^\s+|\s+$", "")


def base_read_id(header) -> Column:
    """The read's own id: without a leading '>', up to white space, up to the first '|'."""
    return F.split_part(F.regexp_extract(_col(header), r"^>?(\S*)", 1), F.lit("|"), F.lit(1))


def header_model(header) -> Column:
    """The third piped token in lower case; hac_fixed and hac2sup are hac."""
    model = F.lower(F.split_part(_col(header), F.lit("|"), F.lit(3)))
    return F.when(model.isin("hac_fixed", "hac2sup"), "hac").otherwise(model)


def model_rank(model) -> Column:
    """For pools: sup 3, hac 2, fast 1, others 0."""
    m = _col(model)
    return F.when(m == "sup", 3).when(m == "hac", 2).when(m == "fast", 1).otherwise(0)


def member_model_rank(model) -> Column:
    """For members: sup 4, hac2sup 3, any other hac 2, fast 1, others 0."""
    m = _col(model)
    return F.when(m == "sup", 4).when(m == "hac2sup", 3).when(m.startswith("hac"), 2).when(m == "fast", 1).otherwise(0)


def keyed_token(header, key: str) -> Column:
    """The value of the first ``key=value`` among the piped tokens; null without one."""
    held = F.filter(F.split(_col(header), r"\|"), lambda x: x.startswith(f"{key}="))
    return F.substring(F.get(held, F.lit(0)), len(key) + 2, 1 << 20)


def canonical_marker(x) -> Column:
    """Upper case; ITS and ITS1 are ITS2; null for a blank."""
    token = F.upper(trim_text(x))
    return F.when(token == "", None).when(token.isin("ITS", "ITS1", "ITS2"), "ITS2").otherwise(token)


def slug(x) -> Column:
    """Lower case, anything but letters, digits, '.', '_' and '-' as '_', runs of '_' as one, none at the ends."""
    held = F.regexp_replace(F.lower(_col(x)), "[^a-z0-9._-]", "_")
    return F.regexp_replace(F.regexp_replace(held, "_+", "_"), "^_|_$", "")


def sample_label(x) -> Column:
    """'unknown' for a blank; 'no_adapter' with any suffix is 'no_adapter'."""
    label = trim_text(x)
    return F.when(label == "", "unknown").when(label.rlike(r"^no_adapter([_|].+)?$"), "no_adapter").otherwise(label)


def is_no_adapter(x) -> Column:
    """Narrower than sample_label: only a numeric suffix, or a piped one, counts."""
    return _col(x).rlike(r"^no_adapter(_\d+)?(\|.*)?$")


def replicate_label(adapter) -> Column:
    digits = F.regexp_extract(_col(adapter), r"_(\d+)$", 1)
    return F.when(digits != "", F.concat(F.lit("rep_"), digits)).otherwise(_col(adapter))


def hit_taxid(x) -> Column:
    """A taxid, plain or after '|kraken:taxid|'; null where there is none."""
    return F.nullif(F.regexp_extract(_col(x), r"^(?:.*\|kraken:taxid\|)?(-?\d+)$", 1), F.lit("")).cast("long")


def accession(x) -> Column:
    return F.regexp_replace(_col(x), r"\|kraken:taxid\|-?\d+$", "")


def otu_marker(otu) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(_col(otu), r"^OTUB_\d+-(.+)$", 1), F.lit("")), F.lit("NA"))


def stable_key(marker, hash_) -> Column:
    return F.concat_ws("|", F.upper(_col(marker)), F.lower(_col(hash_)))


def seq_hash(seq) -> Column:
    return F.md5(F.upper(_col(seq)).cast("binary"))


def query_coverage(qstart, qend, qlen) -> Column:
    """Percent of the query that the alignment covers, halves rounded up."""
    return F.floor((F.abs(_col(qend) - _col(qstart)) + 1) * 100 / _col(qlen) + 0.5)


def reverse_complement(seq) -> Column:
    return F.translate(F.reverse(_col(seq)), "ACGTacgt", "TGCAtgca")


def decimal_key(text) -> Column:
    """A sortable (sign, order, digits) of a decimal of any exponent, exact where a double is not."""
    t = F.lower(trim_text(text))
    mantissa, exponent = F.regexp_extract(t, r"^[+-]?([0-9.]+)", 1), F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(t, r"e([+-]?\d+)$", 1), F.lit("")), F.lit("S999999")).cast("long"), F.lit(0))
    whole = F.regexp_replace(F.split_part(mantissa, F.lit("."), F.lit(1)), "^0+", "")
    part = F.split_part(mantissa, F.lit("."), F.lit(2))
    lead = F.length(part) - F.length(F.regexp_replace(part, "^0+", ""))
    digits = F.regexp_replace(F.regexp_replace(F.concat(whole, part), "^0+", ""), "0+$", "")
    order = F.when(F.length(whole) > 0, F.length(whole)).otherwise(-lead) + exponent
    return F.struct((digits != "").cast("int").alias("some"), F.when(digits != "", order).otherwise(0).alias("order"), digits.alias("digits"))


def clean_sequence(seq) -> Column:
    """Upper case, anything but A, C, G, T and N as N."""
    return F.regexp_replace(F.upper(_col(seq)), "[^ACGTN]", "N")


def round_number(label) -> Column:
    """The last run of digits in a label."""
    return F.nullif(F.regexp_extract(_col(label), r"(\d+)\D*$", 1), F.lit("")).cast("long")


def adapter_class(header: Column) -> Column:
    """no_adapter where the header's first field adapter=... says so (with or without a number), else with_adapter."""
    first = F.get(F.filter(F.split(header, r"\|"), lambda x: x.startswith("adapter=")), F.lit(0))
    named = F.lower(F.regexp_replace(F.substring(first, 9, 1 << 20), r"(?s)\s.*$", ""))
    return F.when(F.coalesce(named.rlike("^no_adapter(_[0-9]+)?$"), F.lit(False)), "no_adapter").otherwise("with_adapter")
