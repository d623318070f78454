"""Cleansing of text columns and the small row operators around it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.functions import parsing
from rowloom.functions.predicates import all_of, all_present
from rowloom.operators.joins import keep_matching


def cleanse(
    rows: DataFrame,
    drop: Sequence[str] = (),
    required: Sequence[str] = (),
    casts: Mapping[str, str] | None = None,
    amounts: Sequence[str] = (),
    dates: Mapping[str, Sequence[str]] | None = None,
    phones: Sequence[str] = (),
    all_true: Sequence[str] = (),
    report: str | None = "unparsed",
) -> DataFrame:
    """Drop columns, keep rows with all ``required`` values, and give text columns their type.

    ``casts`` names a type per column, ``amounts`` default to zero when missing, ``dates``
    lists the layouts per column, ``phones`` lose punctuation, and ``all_true`` columns
    become booleans that must all be true. Text that does not parse becomes null, and its
    column is listed in the ``report`` column.
    """
    kept = rows.drop(*drop).where(all_present(required))
    typed = {c: F.col(c).try_cast(t) for c, t in (casts or {}).items()}
    typed |= {c: parsing.to_amount(F.col(c)) for c in amounts}
    typed |= {c: parsing.to_date_any(F.col(c), *layouts) for c, layouts in (dates or {}).items()}
    typed |= {c: F.col(c).try_cast("boolean") for c in all_true}
    if report is not None:
        failed = [F.when(F.col(c).isNotNull() & value.isNull(), F.lit(c)) for c, value in typed.items()]
        typed[report] = F.concat_ws(",", *failed) if failed else F.lit("")
    typed |= {c: parsing.strip_phone(F.col(c)) for c in phones}
    return kept.withColumns(typed).where(all_of(F.col(c) for c in all_true))


def parse_dates(rows: DataFrame, layouts: Mapping[str, Sequence[str]]) -> DataFrame:
    """Replace text columns by the date they spell in one of the layouts given for them."""
    return rows.withColumns({c: parsing.to_date_any(F.col(c), *formats) for c, formats in layouts.items()})


def parse_timestamps(rows: DataFrame, layouts: Mapping[str, Sequence[str]]) -> DataFrame:
    """Replace text columns by the timestamp they spell in one of the layouts given for them."""
    return rows.withColumns({c: parsing.to_timestamp_any(F.col(c), *formats) for c, formats in layouts.items()})


def recode(rows: DataFrame, column: str, codes: Mapping[str, str], default: str | None = None) -> DataFrame:
    """Replace the codes of a column."""
    return rows.withColumn(column, parsing.recoded(F.col(column), codes, default))


def shift_customer(rows: DataFrame, id_col: str = "id", date_col: str = "dob", id_step: int = 1, days: int = 2) -> DataFrame:
    """Move an identifier by ``id_step`` and a date by ``days``."""
    return rows.withColumns({id_col: F.col(id_col) + id_step, date_col: F.date_add(F.col(date_col), days)})


def split_contact(rows: DataFrame, contact: str, sep: str = "-") -> DataFrame:
    """Add ``Address`` and ``Phone`` taken from a column that holds either or both."""
    return rows.withColumns(
        {
            "Address": parsing.contact_address(F.col(contact), sep),
            "Phone": parsing.contact_phone(F.col(contact), sep),
        }
    )


def semi_join_distinct(rows: DataFrame, reference: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in the reference; duplicates of ``rows`` stay, those of the reference do not count."""
    return keep_matching(rows, reference, keys)


def ranked_by_score(
    rows: DataFrame,
    score: str,
    above: float | None = None,
    equals: Mapping[str, str] | None = None,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Rows above a score and equal to the given values, best first.

    ``ties`` order rows of one score. Last comes the partition a row was read in, so that
    the sort can spread a score, or copies of one row, that many rows share over several tasks.
    """
    wanted = all_of(F.col(c) == v for c, v in (equals or {}).items())
    if above is not None:
        wanted = wanted & (F.col(score) > above)
    located = rows.where(wanted).withColumn("read_in", F.spark_partition_id())
    return located.orderBy(F.col(score).desc(), *(F.col(c).asc() for c in ties), "read_in").drop("read_in")


def word_count(lines: DataFrame, text: str, separator: str = " ", lower: bool = False) -> DataFrame:
    """Occurrences of each word; empty words are left out."""
    source = F.lower(F.col(text)) if lower else F.col(text)
    return (
        lines.select(F.explode(F.split(source, separator)).alias("word"))
        .where(F.col("word") != "")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
