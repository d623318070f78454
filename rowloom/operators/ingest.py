"""Daily landing data: valid and held rows, repair, enrichment, control file."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.functions.predicates import all_present
from rowloom.operators.joins import join_unique


class ValidHold(NamedTuple):
    valid: DataFrame
    hold: DataFrame


def tag_valid(rows: DataFrame, required: Sequence[str]) -> DataFrame:
    """Add ``is_valid``: all required columns hold a value. Works on streams."""
    return rows.withColumn("is_valid", all_present(required))


def split_valid_hold(rows: DataFrame, required: Sequence[str]) -> ValidHold:
    """Rows with all required columns, and the others. Works on streams."""
    complete = all_present(required)
    return ValidHold(rows.where(complete), rows.where(~complete))


def repair_tagged(today: DataFrame, held: DataFrame, keys: Sequence[str], required: Sequence[str]) -> DataFrame:
    """Today's rows, repaired, and the held rows whose key did not arrive today, with ``is_valid``.

    Missing required values of today are taken from held rows of the same key; several held rows of one
    key count as one that has the greatest value of each column, so the result does not depend on row order
    and no row of today is multiplied. Held rows without news stay held. All rows of both days meet what
    is known of their key in one join. A null key is no key: such rows pass as they are.
    """
    tagged = today.withColumn("of_today", F.lit(True)).unionByName(
        held.select(*today.columns).withColumn("of_today", F.lit(False))
    )
    known = (
        tagged.where(all_present(keys))
        .groupBy(*keys)
        .agg(
            F.bool_or("of_today").alias("arrived"),
            *(F.max(F.when(~F.col("of_today"), F.col(c))).alias(f"held__{c}") for c in required if c not in keys),
        )
    )
    joined = join_unique(tagged, known, keys, "left")
    carried = ~F.col("of_today") & ~F.coalesce("arrived", F.lit(False))
    filled = [c for c in required if c not in keys]
    value = lambda c: (
        F.when(F.col("of_today"), F.coalesce(F.col(c), F.col(f"held__{c}"))).otherwise(F.col(c)).alias(c)
        if c in filled
        else F.col(c)
    )
    repaired = joined.where(F.col("of_today") | carried).select(*(value(c) for c in today.columns), "of_today")
    return repaired.withColumn("is_valid", F.col("of_today") & all_present(required)).drop("of_today")


def repair_hold(today: DataFrame, held: DataFrame, keys: Sequence[str], required: Sequence[str]) -> ValidHold:
    """Repair today's rows from the held ones and split again; held rows without news stay held."""
    tagged = repair_tagged(today, held, keys, required)
    return ValidHold(
        tagged.where(F.col("is_valid")).drop("is_valid"), tagged.where(~F.col("is_valid")).drop("is_valid")
    )


class Enriched(NamedTuple):
    enriched: DataFrame
    unmatched: DataFrame


def enrich_tagged(
    sales: DataFrame,
    products: DataFrame,
    key: str = "Product_ID",
    price: str = "Product_Price",
    quantity: str = "Quantity_Sold",
    amount: str = "Sale_Amount",
) -> DataFrame:
    """Every sale with the product columns, its amount as price times quantity, and a ``reason``.

    The reason is null where the product is listed once, else ``unknown_product`` or
    ``ambiguous_product``; such sales keep their own amount. Whole numbers are widened, so the amount
    does not overflow.
    """
    details = [c for c in products.columns if c != key]
    one_each = (
        products.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n_products"), F.max(F.struct(*details)).alias("product"))
    )
    joined = join_unique(sales, one_each, [key], "left")
    known = [c for c in sales.columns if c != amount]
    found = F.coalesce(F.col("n_products") == 1, F.lit(False))
    priced = _wide(products, price, F.col(f"product.{price}")) * _wide(sales, quantity, F.col(quantity))
    own = F.col(amount) if amount in sales.columns else F.lit(None)
    return joined.select(
        *known,
        *(F.when(found, F.col(f"product.{c}")).alias(c) for c in details if c not in known),
        F.when(found, priced).otherwise(own.cast(joined.select(priced).schema[0].dataType)).alias(amount),
        F.when(found, None)
        .when(F.col("n_products") > 1, "ambiguous_product")
        .otherwise("unknown_product")
        .alias("reason"),
    )


def enrich_sales(sales: DataFrame, products: DataFrame, **names: str) -> Enriched:
    """``enrich_tagged`` split in two: priced sales, and those without one product, with the ``reason``."""
    tagged = enrich_tagged(sales, products, **names)
    unmatched = tagged.where(F.col("reason").isNotNull()).select(*sales.columns, "reason")
    return Enriched(tagged.where(F.col("reason").isNull()).drop("reason"), unmatched)


def _wide(df: DataFrame, name: str, value):
    return value.cast("long") if df.schema[name].dataType.typeName() in ("byte", "short", "integer") else value


def rows_per_file(rows: DataFrame, name_pattern: str = r"([^/]+)$") -> DataFrame:
    """``file_name``, ``n_rows`` and ``n_files`` for the files a table is read from.

    The pattern's first group is the name. A table that is itself a folder of parts is named by a pattern
    that ends at the folder, and its parts count as one file. Files of one name in different folders are
    different files: one row tells their rows and that ``n_files`` is over 1.
    """
    path = F.col("file_path")
    per_path = rows.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count(F.lit(1)).alias("n_rows"))
    located = per_path.select(  # names are taken apart once per file, not per row
        F.regexp_extract(path, f"^(.*?){name_pattern}", 1).alias("folder"),
        F.regexp_extract(path, name_pattern, 1).alias("file_name"),
        "n_rows",
    )
    per_file = located.groupBy("folder", "file_name").agg(F.sum("n_rows").alias("n_rows"))
    return per_file.groupBy("file_name").agg(F.sum("n_rows").alias("n_rows"), F.count(F.lit(1)).alias("n_files"))


def expected_count_check(counted: DataFrame, control: DataFrame, file_col: str, expected_col: str) -> DataFrame:
    """Compare counted rows (``n_rows``, and ``n_files`` if known) with a control table.

    ``status``: match, mismatch, missing (no rows for the file), unexpected (not in the
    control table) or ambiguous (the control table lists the file more than once, or several
    files have its name).
    """
    long = lambda column: column.cast("long")
    n_files = F.col("n_files") if "n_files" in counted.columns else F.lit(1)
    both = counted.select(
        file_col,
        long(F.col("n_rows")).alias("n_rows"),
        long(n_files).alias("n_files"),
        long(F.lit(None)).alias("expected"),
        F.lit(0).alias("listed"),
    ).unionByName(
        control.select(
            file_col,
            long(F.lit(None)).alias("n_rows"),
            long(F.lit(0)).alias("n_files"),
            long(F.col(expected_col)).alias("expected"),
            F.lit(1).alias("listed"),
        )
    )
    per_file = both.groupBy(file_col).agg(
        F.sum("n_rows").alias("actual_rows"),
        F.max("n_files").alias("n_files"),
        F.max("expected").alias("expected"),
        F.sum("listed").alias("listed"),
    )
    status = (
        F.when(F.col("listed") == 0, "unexpected")
        .when((F.col("listed") > 1) | (F.col("n_files") > 1), "ambiguous")
        .when(F.col("actual_rows").isNull(), "missing")
        .when(F.col("actual_rows").eqNullSafe(F.col("expected")), "match")
        .otherwise("mismatch")
    )
    expected = F.when(F.col("listed") == 1, F.col("expected")).alias("expected_rows")
    return per_file.select(file_col, expected, "actual_rows", status.alias("status"))
