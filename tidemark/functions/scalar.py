"""Column helpers; all of them stay inside JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trimmed(col: Column) -> Column:
    """Trim and turn an empty field into null."""
    return F.nullif(F.trim(col), F.lit(""))


def year_month(epoch_seconds: Column) -> Column:
    """Epoch seconds to a yyyyMM integer."""
    return F.date_format(F.timestamp_seconds(epoch_seconds), "yyyyMM").cast("int")


def day_of_millis(epoch_millis: Column) -> Column:
    return F.date_format(F.timestamp_millis(epoch_millis), "yyyy-MM-dd")


def hour_of_millis(epoch_millis: Column) -> Column:
    return F.date_format(F.timestamp_millis(epoch_millis), "HH")


def two_digit_hour(col: Column) -> Column:
    """Hour number as a two-character string."""
    return F.lpad(col.cast("string"), 2, "0")


def hour_of_text(datetime_text: Column) -> Column:
    return two_digit_hour(F.hour(F.to_timestamp(datetime_text)))


def previous_day(day: Column) -> Column:
    return F.date_format(F.date_sub(F.to_date(day), 1), "yyyy-MM-dd")


def today() -> Column:
    """The current day as text, for use as a default argument."""
    return F.date_format(F.current_date(), "yyyy-MM-dd")


def age_in_years(birthday: Column, as_of: Column) -> Column:
    """Whole 365-day years between two dates."""
    return F.floor(F.datediff(as_of, F.to_date(birthday)) / F.lit(365)).cast("int")


def round_half_up_2(col: Column) -> Column:
    """Two decimals, ties always towards plus infinity."""
    return F.floor(col * 100 + 0.5) / 100


def to_cents(amount: Column) -> Column:
    return F.round(amount * 100).cast("bigint")


def contains_ci(text: Column, needle: Column | str) -> Column:
    needle = F.lit(needle) if isinstance(needle, str) else needle
    return F.lower(text).contains(F.lower(needle))


def word_tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def highlight(text: Column, terms: list[str]) -> Column:
    """Wrap whole-word matches of the terms in <em> tags, keeping the original case."""
    alternatives = "|".join("".join("\\" + c if not c.isalnum() else c for c in t) for t in terms)
    pattern = rf"(?iu)(?<![\p{{L}}\p{{N}}])(?:{alternatives})(?![\p{{L}}\p{{N}}])"
    return F.regexp_replace(text, pattern, "<em>$0</em>")


def lg(count: Column) -> Column:
    """Base-10 logarithm of a count, zero for counts below two."""
    return F.log10(F.greatest(count, F.lit(1)))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two numeric arrays; null when either has zero length."""

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)

    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))
