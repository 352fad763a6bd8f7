"""Functions over markers, sample labels, ids and numbers of reports, as Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions.scalars import _col, is_no_adapter, sample_label, slug, trim_text

#: Words that count as numbers in a round's name. Fixed values.
ROUND_WORDS = {
    "zero": 0, "zeroth": 0, "first": 1, "second": 2, "third": 3, "fourth": 4, "fifth": 5,
    "sixth": 6, "seventh": 7, "eighth": 8, "ninth": 9, "tenth": 10,
}


def marker_of_token(x, configured: tuple[str, ...] = ()) -> Column:
    """The configured marker that stands between delimiters; else COI, ITS2 or OTHER; null for a blank."""
    token, out = trim_text(x), F.when(trim_text(x) == "", None)
    for marker in configured:
        out = out.when(token.rlike(rf"(?i)(^|[-_|]){re.escape(marker)}($|[-_|])"), marker)
    return out.when(token.rlike(r"(?i)\bCOI\b"), "COI").when(token.rlike(r"(?i)\b(ITS|ITS1|ITS2)\b"), "ITS2").otherwise("OTHER")


def is_numeric_taxid(x) -> Column:
    """Digits alone."""
    return trim_text(x).rlike(r"^[0-9]+$")


def is_signed_taxid(x) -> Column:
    """A number other than zero, without leading zeros, negative ones included."""
    return F.coalesce(_col(x), F.lit("")).rlike(r"^-?[1-9][0-9]*$")


def _suffix(configured: tuple[str, ...]) -> str:
    return "|".join(map(re.escape, configured))


def sample_base(x, configured: tuple[str, ...] = ()) -> Column:
    """A label without its replicate, its marker and its first embedded number; no_adapter for any form of that."""
    label = F.regexp_replace(trim_text(x), r"_[0-9]+$", "")
    if configured:
        label = F.regexp_replace(label, rf"(?i)_({_suffix(configured)})([0-9]+)?$", "")
    label = F.regexp_replace(label, r"(?i)_(COI|ITS)\d*$", "")
    first = F.regexp_replace(label, r"^(.*?)_[0-9]+_(.*)$", "$1_$2")  # the first one alone
    return F.when(is_no_adapter(trim_text(x)), "no_adapter").otherwise(trim_text(first))


def marker_of_label(x, configured: tuple[str, ...] = ()) -> Column:
    """The marker at a label's end, in lower case; '' without one."""
    base = F.regexp_replace(trim_text(x), r"_[0-9]+$", "")
    out = F.when((trim_text(x) == "") | is_no_adapter(trim_text(x)), "")
    for marker in configured:
        out = out.when(base.rlike(rf"(?i)(^|_){re.escape(marker)}(_[0-9]+)?$"), marker.lower())
    return out.when(base.rlike(r"(?i)_ITS\d*$"), "its2").when(base.rlike(r"(?i)_COI\d*$"), "coi").otherwise("")


def stable_sample_id(x) -> Column:
    """A readable id that differs where labels differ."""
    label = sample_label(x)
    base = slug(label)
    return F.concat(F.when(base == "", "sample").otherwise(base), F.lit("_"), F.substring(F.sha1(label.cast("binary")), 1, 8))


def sample_dimensions(x, full_track: bool = False) -> list[Column]:
    """platform, sampling_method, subsample and replicate of a label; 'unknown' where blank, absent or not of that form."""
    label, parts = _col(x), F.split(_col(x), "_", -1)
    names = ("platform", "sampling_method", "subsample", "replicate")
    plain = F.lit(full_track) | F.coalesce(label, F.lit("")).isin("", "no_adapter")
    part = lambda i: F.coalesce(F.nullif(F.get(parts, F.lit(i)), F.lit("")), F.lit("unknown"))
    return [F.when(plain, "unknown").otherwise(part(i)).alias(name) for i, name in enumerate(names)]


def track_unit(x) -> list[Column]:
    """sample, number, unit and marker of a track unit's label; null where it has another form."""
    pattern = r"^(.*)_([0-9]+)_([^_]+)_([A-Za-z0-9]+)$"
    fits = _col(x).rlike(pattern)
    return [F.when(fits, F.regexp_extract(_col(x), pattern, k + 1)).alias(name) for k, name in enumerate(("sample", "number", "unit", "marker"))]


def consensus_sequence_id(x) -> list[Column]:
    """sample, token and consensus_id of a consensus' long id; null where a part is blank or absent."""
    raw = F.regexp_replace(trim_text(x), "^>", "")
    parts = F.split(raw, r"\|")
    sample, token = trim_text(F.get(parts, F.lit(0))), trim_text(F.get(parts, F.lit(1)))
    sample = F.when(is_no_adapter(sample), "no_adapter").otherwise(sample)
    sound = (F.size(parts) >= 2) & (sample != "") & (token != "")
    values = {"sample": sample, "token": token, "consensus_id": F.concat(token, F.lit("_"), sample)}
    return [F.when(sound, v).alias(k) for k, v in values.items()]


def reads_of(header, only_one: bool = False) -> Column:
    """The number after the first 'reads-'; null without one and, with only_one, where there are several."""
    found = F.regexp_extract_all(_col(header), F.lit(r"reads-([0-9]+)"), F.lit(1))
    sound = F.size(found) == 1 if only_one else F.size(found) >= 1
    return F.when(sound, F.get(found, F.lit(0)).cast("long"))


def shorter_coverage(alignment, query, subject) -> Column:
    """Percent of the shorter sequence that the alignment covers, at most 100."""
    return F.least(F.lit(100.0), F.lit(100.0) * _col(alignment) / F.least(_col(query), _col(subject)))


def epoch_of(x) -> Column:
    """Seconds since 1970 of an ISO time, UTC without a zone; null where malformed."""
    return F.unix_seconds(F.try_to_timestamp(F.regexp_replace(trim_text(x), "Z$", "+00:00")))


def natural_round_key(x) -> Column:
    """A text that sorts rounds as people count: numbers and number words by value, before other words."""
    parts = F.regexp_extract_all(F.lower(trim_text(x)), F.lit(r"([0-9]+|[a-z]+|[^a-z0-9]+)"), F.lit(1))
    words = F.create_map(*[v for k, n in ROUND_WORDS.items() for v in (F.lit(k), F.lit(str(n)))])
    number = lambda p: F.when(p.rlike("^[0-9]+$"), F.regexp_replace(p, "^0+(?=[0-9])", "")).otherwise(words[p])
    key = lambda p: F.when(number(p).isNotNull(), F.concat(F.lit("0"), F.lpad(number(p), 20, "0"))).otherwise(F.concat(F.lit("1"), p))
    return F.concat_ws("\x01", F.transform(parts, key))


def subject_label(x) -> Column:
    """The first two piped parts."""
    return F.substring_index(_col(x), "|", 2)


def label_is_target(label, targets: list[tuple[str, str]]) -> Column:
    """Whether the label is, or goes on from, one of the 'marker|taxon' targets."""
    out = F.lit(False)
    for marker, taxon in targets:
        out = out | _col(label).startswith(f"{marker}|{taxon}")
    return F.coalesce(out, F.lit(False))


def threshold_of(marker, thresholds: dict[str, float], configured: tuple[str, ...] = ()) -> Column:
    """The threshold of a marker as written, else of its canonical form, else in upper case, else the default."""
    if not thresholds:
        return F.lit(None).cast("double")
    held, token = F.create_map(*[v for k, x in thresholds.items() for v in (F.lit(k), F.lit(float(x)))]), trim_text(marker)
    return F.coalesce(F.try_element_at(held, token), F.try_element_at(held, marker_of_token(token, configured)), F.try_element_at(held, F.upper(token)), F.try_element_at(held, F.lit("_default")))


def canonical_json(**values) -> Column:
    """JSON with its keys in order, nulls kept; the same text for the same values."""
    return F.to_json(F.struct(*[_col(values[k]).alias(k) for k in sorted(values)]), {"ignoreNullFields": "false"})


def fixed_number(x, kind: str) -> Column:
    """Numbers as reports write them: 'percent' to three places, 'fraction' to six."""
    return F.format_string({"percent": "%.3f", "fraction": "%.6f"}[kind], _col(x).cast("double"))
