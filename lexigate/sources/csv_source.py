"""User-supplied CSV with a required-column check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lexigate.sources.csv_records import csv_records

# Quotes are doubled inside quoted fields, and fields may hold line breaks.
_FIELDS = {"quote": '"', "escape": '"', "multiLine": True}
_OPTIONS = _FIELDS | {"header": True}

# fixed values: cells read as null, besides empty ones
NULL_WORDS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_csv(
    spark: SparkSession,
    path: str,
    text_column: str = "review_text",
    label_column: str = "sentiment",
    schema: StructType | str | None = None,
    null_words: bool = True,
) -> DataFrame:
    """Read a CSV; missing declared columns are an error that names them.

    Large files are read in parallel, line breaks within fields included (``csv_records``). A schema
    saves the extra pass that inference takes. Every file's header must name the columns in the
    schema's order; a file that has others or another order fails the read. Folders named by column
    and value give no columns.
    """
    # by header, so that a schema cannot hide a file without the column
    header = spark.read.options(**_OPTIONS).csv(path).columns
    missing = [c for c in (text_column, label_column) if c not in header]
    if missing:
        raise ValueError(f"{path} is missing required columns: {missing}")
    records = csv_records(spark, path)
    rows, options = records.filter(~F.col("first")), _FIELDS | {"mode": "PERMISSIVE"}
    if schema is None:
        inferred = spark.read.options(**_FIELDS, inferSchema=True).csv(
            rows.select("record").rdd.map(lambda row: row["record"])
        )
        kinds = [field.dataType for field in inferred.schema]
        kinds += [StringType()] * (len(header) - len(kinds))
        schema = StructType([StructField(*pair) for pair in zip(header, kinds, strict=False)])
    elif isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    _check_headers(records, header, schema, path)
    parsed = F.from_csv("record", _ddl(schema), options)
    frame = rows.select(parsed.alias("row")).select("row.*")
    if not null_words:
        return frame
    strings = {name for name, kind in frame.dtypes if kind == "string"}
    return frame.select(
        *[
            F.when(~_column(name).isin(*NULL_WORDS), _column(name)).alias(name)
            if name in strings
            else _column(name)
            for name in frame.columns
        ]
    )


def _column(name: str) -> Column:
    return F.col(_quoted(name))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _ddl(schema: StructType) -> str:
    return ", ".join(f"{_quoted(field.name)} {field.dataType.simpleString()}" for field in schema)


def _check_headers(records: DataFrame, header: list[str], schema: StructType, path: str) -> None:
    if [name.lower() for name in schema.names] != [name.lower() for name in header]:
        raise ValueError(f"The header of {path} names {header}, and the schema {schema.names}")
    fields = StructType([StructField(f"_{i}", StringType()) for i in range(len(header) + 1)])
    parsed = F.from_csv("record", _ddl(fields), _FIELDS)
    found = records.filter("first").select(F.lower(F.to_json(parsed)).alias("names")).distinct().limit(2)
    if found.count() > 1:
        raise ValueError(f"Not all files under {path} have the same header")


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write so that ``read_csv`` gives the same rows back, whitespace included."""
    df.write.mode(mode).options(
        header=True,
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)
