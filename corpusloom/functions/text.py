"""Text functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize(text: Column) -> Column:
    """Line breaks to spaces, runs of spaces to one, Unicode white space trimmed from both ends."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"[\r\n]", " "), " {2,}", " "), r"(?U)^\s+|\s+$", "")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def clip(text: Column, n: int) -> Column:
    """At most ``n`` code points, then how many were cut."""
    cut = F.concat(F.substring(text, 1, n), F.lit("... [truncated "), (F.length(text) - n).cast("string"), F.lit(" chars]"))
    return F.when(F.length(text) > n, cut).otherwise(text)


def keyword_tags(text: Column, keywords: list[str], limit: int) -> Column:
    """The first ``limit`` of ``keywords``, in their order, that the text holds in any case."""
    words = F.array(*(F.lit(k.lower()) for k in keywords))
    return F.slice(F.filter(words, lambda k: F.contains(F.lower(text), k)), 1, limit)


def safe_name(text: Column) -> Column:
    """A file name: letters, digits, ``_`` and ``-`` stay."""
    return F.regexp_replace(text, r"[^\p{L}\p{N}_-]", "_")


def index_from_id(text: Column, prefix: str) -> Column:
    """The positive number after ``prefix``; null if there is none."""
    number = F.regexp_extract(text, f"^{prefix}0*([0-9]+)$", 1).try_cast("bigint")
    return F.when(number > 0, number)


def split_args(text: Column) -> Column:
    """The trimmed, non-empty parts of a comma-separated list."""
    return F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")


def first_full(*columns: Column) -> Column:
    """The first column that is neither null nor empty: records name the same field differently."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in columns))


def iso_utc(moment: Column) -> Column:
    """A time as ISO-8601 text in UTC, whole seconds; the moment is given, so that reruns may agree."""
    seconds = F.timestamp_seconds(F.unix_timestamp(moment.cast("timestamp")))
    return F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"), seconds.cast("timestamp_ntz")), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
