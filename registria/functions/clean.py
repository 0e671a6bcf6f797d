"""Cleaning rules for dates, codes, money and blanks.

Every function takes a column (or its name) and returns a Column. Dirty values
become NULL instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(20,2)"

# Company-size codes of the registry.
SIZE_CODES = {
    "micro": ["01", "1", "ME", "M"],
    "small": ["02", "2", "EPP", "P"],
    "medium": ["03", "3"],
    "large": ["05", "5", "04", "4"],
}
ACTIVE_STATUS = "02"
MISSING_LABEL = "Unknown"


def _c(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def digits(value: Column | str) -> Column:
    return F.regexp_replace(_c(value).cast("string"), r"\D", "")


def _eight_digits(rest: str) -> str:
    """Pattern of a text that starts with eight digits and goes on with ``rest``.

    First the usual shapes, plain or with dashes; then digits with anything
    between; then whatever is left, which sets no group.
    """
    plain, apart = r"(\d{4})-?(\d{2})-?(\d{2})", r"\D*(\d)" * 8
    return f"(?s)^(?:{plain}{rest}|{apart}{rest}|.*)$"


def _parse_date(value: Column | str, pattern: str) -> Column:
    # The input is named once on purpose. A filter on the date is pushed below the
    # projection that makes it, and there every mention is computed again.
    # Without a match the text becomes "--". A cast needs no pattern formatter and
    # gives NULL for that as for an impossible date.
    iso = F.regexp_replace(_c(value).cast("string"), pattern, "$1$4$5$6$7-$2$8$9-$3$10$11")
    return iso.try_cast("date")


def parse_date_prefix8(value: Column | str) -> Column:
    """Date from the first eight digits; NULL if there are fewer or they are no date."""
    return _parse_date(value, _eight_digits(".*"))


def parse_date_exact8(value: Column | str) -> Column:
    """Date if there are exactly eight digits; otherwise NULL."""
    return _parse_date(value, _eight_digits(r"\D*"))


def date_class(value: Column | str) -> Column:
    """``valid``, ``empty`` (nothing but a zero or no digit) or ``garbage``."""
    text = digits(value)
    return (
        F.when(parse_date_exact8(value).isNotNull(), "valid")
        .when(F.coalesce(text, F.lit("")).isin("", "0"), "empty")
        .otherwise("garbage")
    )


def trim_code(value: Column | str) -> Column:
    return F.trim(_c(value).cast("string"))


def norm_uf(value: Column | str) -> Column:
    return F.upper(trim_code(value))


def norm_code4(value: Column | str) -> Column:
    """First four digits, left-padded with zeros; NULL without a digit."""
    text = digits(value)
    return F.when(F.length(text) > 0, F.lpad(text, 4, "0"))


def norm_status(value: Column | str) -> Column:
    return F.coalesce(F.lpad(trim_code(value), 2, "0"), F.lit(""))


def is_active(status2: Column | str) -> Column:
    return F.coalesce(_c(status2) == ACTIVE_STATUS, F.lit(False))


def status_label(status2: Column | str) -> Column:
    return F.when(is_active(status2), "Active").otherwise("Inactive")


def parse_capital(value: Column | str) -> Column:
    """Decimal-comma money; blanks and garbage are NULL."""
    return F.replace(_c(value), F.lit(","), F.lit(".")).try_cast(MONEY)


def size_bucket(value: Column | str) -> Column:
    """``micro``, ``small``, ``medium``, ``large`` or NULL."""
    code, bucket = F.rtrim(_c(value)), None
    for label, codes in SIZE_CODES.items():
        hit = code.isin(codes)
        bucket = F.when(hit, label) if bucket is None else bucket.when(hit, label)
    return bucket


def cnae_division(value: Column | str) -> Column:
    """Two-digit activity division; NULL if the code has fewer digits."""
    text = digits(value)
    return F.when(F.length(text) >= 2, F.substring(text, 1, 2))


def month_floor(value: Column | str) -> Column:
    return F.trunc(_c(value), "MM")


def month_label(value: Column | str) -> Column:
    return F.date_format(_c(value), "yyyy-MM")


def strip_nul(value: Column | str) -> Column:
    return F.translate(_c(value), "\u0000", "")


def or_missing(value: Column | str) -> Column:
    return F.coalesce(_c(value), F.lit(MISSING_LABEL))


def is_blank(value: Column | str) -> Column:
    return F.coalesce(trim_code(value), F.lit("")) == ""


def to_number(value: Column | str) -> Column:
    """Number from text; anything else is zero, ``nan`` included."""
    number = _c(value).try_cast("double")
    return F.when(F.isnan(number), 0.0).otherwise(F.coalesce(number, F.lit(0.0)))
