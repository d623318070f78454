"""Delimited text with a declared schema."""

from __future__ import annotations

import csv
import json
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
OPEN_FILES = 16  # Fixed value: files of delimited text that a task writes at once.
OPEN_FILES_SETTING = "spark.sql.maxConcurrentOutputFileWriters"

# Type names used in field metadata.
FIELD_TYPES = {
    "string": T.StringType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def schema_from_metadata(fields: Sequence[Mapping]) -> T.StructType:
    """Schema from field metadata, ordered by ``fieldPosition``; an unknown type is an error.

    A declared date format is kept in the field's metadata under ``format``.
    """
    schema = T.StructType()
    for field in sorted(fields, key=lambda f: f["fieldPosition"]):
        name, type_name = field["fieldName"], field["fieldDataType"].lower()
        if type_name == "decimal":
            precision, scale = field.get("fieldPrecision"), field.get("fieldScale")
            data_type = T.DecimalType(10 if precision is None else precision, scale or 0)
        elif type_name in FIELD_TYPES:
            data_type = FIELD_TYPES[type_name]
        else:
            raise ValueError(f"field {name}: unknown type {field['fieldDataType']!r}")
        layout = field.get("fieldDateFormat")
        schema.add(name, data_type, field.get("fieldNullability", True), {"format": layout} if layout else None)
    return schema


def load_schema(spark: SparkSession, path: str) -> T.StructType:
    """Schema from a JSON file in any store that Spark reads: a list of field metadata, or Spark's own form."""
    content = json.loads(spark.read.text(path, wholetext=True).first()[0])
    return schema_from_metadata(content) if isinstance(content, list) else T.StructType.fromJson(content)


def _as_text(schema: T.StructType) -> T.StructType:
    """The schema with formatted dates and timestamps read as text."""
    return T.StructType(
        [T.StructField(f.name, T.StringType() if f.metadata.get("format") else f.dataType, True) for f in schema]
    )


def _parse_formatted(df: DataFrame, schema: T.StructType, check: bool) -> DataFrame:
    parsed, failed = {}, []
    for field in schema:
        layout = field.metadata.get("format")
        if not layout:
            continue
        text = F.col(field.name)
        as_date = isinstance(field.dataType, T.DateType)
        parsed[field.name] = F.try_to_date(text, layout) if as_date else F.try_to_timestamp(text, F.lit(layout))
        failed.append(F.when(text.isNotNull() & parsed[field.name].isNull(), F.concat(F.lit(field.name + "="), text)))
    if check:
        # Spark checks the fields a query uses; the hash uses them all and adds no value
        problem = F.coalesce(F.col(CORRUPT), F.when(F.xxhash64(*schema.names) == 0, F.col(CORRUPT)))
        notes = F.concat_ws(", ", *failed) if failed else F.lit("")
        parsed[CORRUPT] = F.coalesce(problem, F.when(notes != "", notes))
    return df.withColumns(parsed) if parsed else df


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None = None,
    sep: str = ",",
    header: bool = False,
    null_value: str = "",
    check: bool = True,
    **options: str,
) -> DataFrame:
    """Read delimited files.

    With a schema, ``check`` adds ``_corrupt_record``: the whole line where the number or
    the type of its fields is wrong, or the text of a date that does not fit its declared
    format. Without a schema all columns are strings, named by the header or ``_c0, _c1``.
    """
    reader = spark.read.options(sep=sep, header=header, nullValue=null_value, **options)
    if schema is None:
        return reader.option("inferSchema", False).csv(path)
    columns = _as_text(schema)
    if check:
        columns = columns.add(CORRUPT, T.StringType())
        reader = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
    return _parse_formatted(reader.schema(columns).csv(path), schema, check)


def headers(
    spark: SparkSession, path: str | Sequence[str], sep: str = ",", encoding: str = "UTF-8"
) -> dict[tuple[str, ...], list[str]]:
    """The files below ``path`` by their header: the fields of the first line. Files without a line are left out.

    Only the first line of a file is read, by the driver, which lists the files for any read.
    """
    files = sorted(spark.read.text(path).inputFiles())
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first_line(file: str) -> str | None:
        where = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        codec = codecs.getCodec(where)
        stream = where.getFileSystem(conf).open(where)
        reader = jvm.java.io.BufferedReader(
            jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, encoding)
        )
        try:
            return reader.readLine()
        finally:
            reader.close()

    found: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(16) as pool:
        for file, line in zip(files, pool.map(first_line, files)):
            if line is not None:
                fields = next(csv.reader([line.removeprefix("\ufeff")], delimiter=sep))
                found.setdefault(tuple(f.strip() for f in fields), []).append(file)
    return found


def read_by_header(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None = None,
    sep: str = ",",
    null_value: str = "",
    check: bool = True,
    encoding: str = "UTF-8",
    **options: str,
) -> DataFrame:
    """Read files with a header each by the names in it, whatever their order or number.

    Files of one header are read together, and the groups are united by name. With a schema the result has its
    columns: one that a file lacks is null there, one that the schema lacks is not returned, and ``check`` works as in
    ``read_delimited``, against the fields of the file's own header. Without a schema the result has the columns of all files,
    as strings. A header that names a column twice is an error.
    """
    parts = []
    for names, files in headers(spark, path, sep, encoding).items():
        if len(set(names)) < len(names):
            raise ValueError(f"a header names a column twice: {', '.join(names)} in {files[0]}")
        known = {f.name: f for f in schema} if schema is not None else {}
        own = T.StructType([known.get(n, T.StructField(n, T.StringType())) for n in names])
        rows = read_delimited(spark, files, own, sep, True, null_value, check and schema is not None, encoding=encoding, **options)
        wanted = [n for n in rows.columns if schema is None or n in known or n == CORRUPT]
        parts.append(rows.select(*(F.col(f"`{n}`") for n in wanted)))
    extra = [T.StructField(CORRUPT, T.StringType())] if check and schema is not None else []
    plain = [T.StructField(f.name, f.dataType) for f in schema or []]
    if schema is not None or not parts:
        parts.insert(0, spark.createDataFrame([], T.StructType([*plain, *extra])))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def text_lines(spark: SparkSession, text: str) -> DataFrame:
    """The lines of a text held in memory, in a column ``value``."""
    return spark.createDataFrame([(line,) for line in text.splitlines()], "value string")


def parse_delimited_text(
    lines: DataFrame,
    schema: T.StructType,
    sep: str = ",",
    header: str | None = None,
    line: str = "value",
) -> DataFrame:
    """Parse a column of delimited lines; a line that does not fit is kept in ``_corrupt_record``.

    Lines equal to ``header`` are left out.
    """
    columns = _as_text(schema).add(CORRUPT, T.StringType())
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    rows = lines if header is None else lines.where(F.col(line) != header)
    parsed = rows.select(F.from_csv(F.col(line), columns.toDDL(), options).alias("r")).select("r.*")
    return _parse_formatted(parsed, schema, check=True)


def write_delimited(
    df: DataFrame,
    path: str,
    sep: str = ",",
    header: bool = False,
    null_value: str = "",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    timestamp_format: str | None = None,
    **options: str,
) -> None:
    """Write delimited files, as many as the data has partitions.

    An empty string and a null look alike to a reader unless ``null_value`` tells them apart. With ``partition_by`` a task
    keeps a file open for each value it meets, and sorts its rows only if they are more than ``OPEN_FILES``.
    """
    writer = df.write.mode(mode).options(sep=sep, header=header, nullValue=null_value, **options)
    if timestamp_format:
        writer = writer.options(timestampFormat=timestamp_format, timestampNTZFormat=timestamp_format)
    if not partition_by:
        return writer.csv(path)
    settings = df.sparkSession.conf
    before = settings.get(OPEN_FILES_SETTING)
    settings.set(OPEN_FILES_SETTING, max(OPEN_FILES, int(before)))
    try:
        writer.partitionBy(*partition_by).csv(path)
    finally:
        settings.set(OPEN_FILES_SETTING, before)
