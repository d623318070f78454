"""Text to typed values. Text that does not parse becomes null, never an error or a default."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date and timestamp layouts found in the source extracts.
DATE_LAYOUTS = ("yyyy-MM-dd", "yyyy/MM/dd", "yyyyMMdd", "dd-MM-yyyy", "dd-MMM-yy")
TIMESTAMP_LAYOUTS = (
    "yyyy-MM-dd HH:mm:ss.SSS",
    "yyyy-MM-dd HH:mm:ss",
    "yyyyMMddHHmmss.SSS",
    "yyyyMMddHHmmss.SSSSSS",
    "yyyy-MM-dd-HH.mm.ss.SSS",
)


def timestamp_literal(value: datetime | str) -> Column:
    """A wall-clock time, the same in every session time zone."""
    return F.lit(str(value)).cast("timestamp_ntz")


def to_date_any(text: Column, *layouts: str) -> Column:
    """Date from the first layout that fits."""
    return F.coalesce(*(F.try_to_date(text, layout) for layout in layouts or DATE_LAYOUTS))


def to_timestamp_any(text: Column, *layouts: str) -> Column:
    """Timestamp from the first layout that fits; fractions of a second are kept."""
    return F.coalesce(*(F.try_to_timestamp(text, F.lit(layout)) for layout in layouts or TIMESTAMP_LAYOUTS))


def to_amount(text: Column) -> Column:
    """Amount without thousands separators; a missing amount is zero, an unreadable one null."""
    stripped = F.regexp_replace(F.trim(text), ",", "")
    return F.when(text.isNull(), F.lit(0.0)).otherwise(stripped.try_cast("double"))


def strip_phone(text: Column) -> Column:
    """Phone number without brackets, dashes and blanks."""
    return F.regexp_replace(text, r"[()\-\s]", "")


def recoded(value: Column, codes: Mapping[str, str], default: str | None = None) -> Column:
    """Replacement for each listed code; other values become ``default``, or stay when there is none."""
    fallback = value if default is None else F.lit(default)
    if not codes:
        return fallback
    expr = None
    for code, replacement in codes.items():
        branch = (value == code, F.lit(replacement))
        expr = F.when(*branch) if expr is None else expr.when(*branch)
    return expr.otherwise(fallback)


def contact_address(contact: Column, sep: str = "-") -> Column:
    """The part before ``sep`` unless it is only digits."""
    head = F.get(F.split(contact, sep), F.lit(0))
    return F.when(head.rlike("[^0-9]"), head)


def contact_phone(contact: Column, sep: str = "-") -> Column:
    """The whole value when it is only digits, else the part after ``sep``."""
    return F.when(contact.rlike("^[0-9]+$"), contact).otherwise(F.get(F.split(contact, sep), F.lit(1)))
