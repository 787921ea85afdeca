"""CSV and JSON readers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .records import csv_records, json_records

# The text form of a timestamp on every CSV and JSON edge; Spark's own default drops microseconds.
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


#: Column with the text of a record that does not fit its schema, where that is asked for.
MALFORMED = "_malformed"


def read_csv_raw(
    spark: SparkSession, path: str, sep: str = ",", schema: StructType | None = None, multi_line: bool = False, malformed: bool = False
) -> DataFrame:
    """CSV with a header; every column is text unless a schema is given.

    A quote inside a value is doubled, as most tools write it. One record is one line, so a big file
    is split among tasks; ``multi_line`` reads records whose quoted values have line breaks, and splits
    files as well (``records``). ``malformed`` adds the column ``MALFORMED``: the text of records with too
    few or too many values, or with one that cannot be read as its type; else null.
    """
    reader = spark.read.options(header=True, sep=sep, escape='"', timestampNTZFormat=TIMESTAMP_FORMAT, multiLine=multi_line)
    if malformed:
        schema = schema or reader.csv(path).schema
        schema = StructType([*schema.fields, StructField(MALFORMED, StringType())])
        reader = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=MALFORMED)
    if multi_line:
        options = {"sep": sep, "escape": '"', "timestampNTZFormat": TIMESTAMP_FORMAT, "mode": "PERMISSIVE"}
        options |= {"columnNameOfCorruptRecord": MALFORMED} if malformed else {}
        parsed = F.from_csv("record", (schema or reader.csv(path).schema).toDDL(), options)
        return csv_records(spark, path).select(parsed.alias("row")).select("row.*")
    return (reader.schema(schema) if schema else reader).csv(path)


def read_csv_inferred(
    spark: SparkSession, path: str, sep: str = ",", sampling_ratio: float = 1.0
) -> DataFrame:
    """CSV with a header and types taken from the data.

    Inference reads the file once more. A lower ratio makes that cheaper, at the price of
    types that a row outside the sample may not fit.
    """
    return spark.read.options(
        header=True, sep=sep, escape='"', inferSchema=True, samplingRatio=sampling_ratio
    ).csv(path)


def read_json_records(
    spark: SparkSession, path: str, schema: StructType, whole_file: bool = False, malformed: bool = False
) -> DataFrame:
    """Records of landed payloads, one row per object.

    A payload is an object or an array of objects, one per line. ``whole_file`` reads each
    file as one payload that spans lines, an array of objects or an object, and splits files as well (``records``);
    what follows a payload that breaks off is part of its last record then. ``malformed`` adds the column ``MALFORMED``: the text of a payload that cannot be read; else null.
    """
    if malformed:
        schema = StructType([*schema.fields, StructField(MALFORMED, StringType())])
    if whole_file:
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED, "timestampNTZFormat": TIMESTAMP_FORMAT}
        return json_records(spark, path).select(F.from_json("record", schema, options).alias("row")).select("row.*")
    reader = spark.read.schema(schema).options(mode="PERMISSIVE", columnNameOfCorruptRecord=MALFORMED).option("timestampNTZFormat", TIMESTAMP_FORMAT)
    return reader.json(path)


def read_or_none(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What ``read`` returns, or ``None`` when its path does not exist; other errors pass."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def is_empty(df: DataFrame) -> bool:
    """Whether there is no row; looks for the first one only."""
    return df.isEmpty()


def all_empty(*dfs: DataFrame) -> bool:
    return all(is_empty(df) for df in dfs)
