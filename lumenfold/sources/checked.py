"""Line files read with every line accounted for: good rows, and bad lines with the reason.

A line is bad if it does not fit the schema (too few or many fields, a number that is none, broken JSON) or lacks a required
value. Nothing is silently turned into nulls. The same columns serve batch and stream: lines are text, and are
parsed by native expressions into a struct that also holds the unreadable line.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenfold.plans.stage import stage
from lumenfold.sources.files import REVIEWS, TRANSACTIONS

UNREADABLE = "_unreadable"
REASON, LINE, FILE = "bad_reason", "bad_line", "bad_file"


@dataclass(frozen=True)
class Checked:
    """Good rows, bad lines (line, file, reason), both read from one written copy of the parsed lines."""

    good: DataFrame
    bad: DataFrame

    def counts(self) -> DataFrame:
        """(reason, lines): the good rows under the reason null."""
        good = self.good.agg(F.lit(None).cast("string").alias("reason"), F.count("*").alias("lines"))
        return good.unionAll(self.bad.groupBy("reason").agg(F.count("*").alias("lines")))


def _schema(schema: T.StructType) -> str:
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema]
    return ", ".join([*fields, f"{UNREADABLE} string"])


def csv_fields(line: Column, schema: T.StructType) -> Column:
    """A CSV line as a struct of the schema, with the line itself in ``UNREADABLE`` if it does not fit."""
    return F.from_csv(line, _schema(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": UNREADABLE})


def json_fields(line: Column, schema: T.StructType) -> Column:
    """The same for a JSON line. A line that is no object is unreadable, too."""
    parsed = F.from_json(line, _schema(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": UNREADABLE})
    return F.when(line.rlike(r"^\s*\{"), parsed).otherwise(F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema], line.alias(UNREADABLE)))


def with_reason(lines: DataFrame, fields: Column, schema: T.StructType, required: Sequence[str]) -> DataFrame:
    """The columns of the schema, and why a line is bad (null: it is good), with the line and its file. Blank lines are no lines."""
    file = F.col("_metadata.file_path").alias(FILE)
    parsed = lines.where(F.trim(F.col("value")) != "").select("value", file, fields.alias("f"))
    reason = F.when(F.col(f"f.{UNREADABLE}").isNotNull() | F.col("f").isNull(), F.lit("unreadable"))
    for name in required:
        reason = reason.when(F.col(f"f.`{name}`").isNull(), F.lit(f"no {name}"))
    return parsed.select(
        *[F.col(f"f.`{f.name}`").alias(f.name) for f in schema],
        reason.alias(REASON),
        F.when(reason.isNotNull(), F.col("value")).alias(LINE),
        FILE,
    )


def split(parsed: DataFrame, names: Sequence[str]) -> Checked:
    """Good and bad of lines with a reason."""
    good = parsed.where(F.col(REASON).isNull()).select(*names)
    bad = parsed.where(F.col(REASON).isNotNull())
    return Checked(good, bad.select(F.col(LINE).alias("line"), F.col(FILE).alias("file"), F.col(REASON).alias("reason")))


def check_transactions(
    spark: SparkSession, path: str, schema: T.StructType = TRANSACTIONS, required: Sequence[str] = ("user_id", "amount")
) -> Checked:
    """Headerless transaction CSV, in good rows and bad lines. The parsed lines are written once for both."""
    lines = spark.read.text(path)
    parsed = with_reason(lines, csv_fields(F.col("value"), schema), schema, required)
    return split(stage(parsed, "checked-lines"), schema.names)


def check_reviews(
    spark: SparkSession, path: str, schema: T.StructType = REVIEWS, required: Sequence[str] = ()
) -> Checked:
    """JSON-lines reviews, in good rows and bad lines."""
    lines = spark.read.text(path)
    parsed = with_reason(lines, json_fields(F.col("value"), schema), schema, required)
    return split(stage(parsed, "checked-lines"), schema.names)


def check_numeric_csv(spark: SparkSession, path: str, columns: Sequence[str], required: Sequence[str] = ()) -> Checked:
    """CSV with a header and only numbers, in good rows and bad lines; the header is checked against the names."""
    schema = T.StructType([T.StructField(c, T.DoubleType()) for c in columns])
    header = T.StructType([*schema, T.StructField(UNREADABLE, T.StringType())])
    read = spark.read.option("header", True).option("enforceSchema", False).option("columnNameOfCorruptRecord", UNREADABLE)
    rows = read.schema(header).csv(path).select("*", F.col("_metadata.file_path").alias(FILE))
    reason = F.when(F.col(UNREADABLE).isNotNull(), F.lit("unreadable"))
    for name in required:
        reason = reason.when(F.col(f"`{name}`").isNull(), F.lit(f"no {name}"))
    line = F.coalesce(F.col(UNREADABLE), F.to_csv(F.struct(*[F.col(f"`{c}`") for c in columns])))
    parsed = rows.select(*[F.col(f"`{c}`") for c in columns], reason.alias(REASON), F.when(reason.isNotNull(), line).alias(LINE), FILE)
    return split(stage(parsed, "checked-lines"), list(columns))


def checked_transaction_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = TRANSACTIONS,
    required: Sequence[str] = ("user_id", "amount"),
    files_per_batch: int | None = None,
) -> DataFrame:
    """The parsed lines of a folder as they arrive; ``streaming.write_checked`` sends them to two outputs."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return with_reason(reader.text(path), csv_fields(F.col("value"), schema), schema, required)
