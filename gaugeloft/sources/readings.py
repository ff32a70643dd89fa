"""Headerless CSV readings, read by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gaugeloft.functions.convert import convert_text
from gaugeloft.functions.naming import in_key_sample, tenant_of
from gaugeloft.schemas import READINGS

FIELDS = "_fields"


# Fixed value: CSV files, plain or compressed.
CSV_FILES = "{*.csv,*.csv.gz,*.csv.bz2,*.csv.zst,*.csv.lz4,*.csv.snappy,*.csv.deflate}"


def _field_count(line: Column) -> Column:
    """Fields of a line, without parsing it: separators outside quoted fields, plus one; a blank line has none."""
    bare = F.when(line.contains('"'), F.regexp_replace(line, '(^|,)"(?:[^"]|"")*"', "$1")).otherwise(line)
    separators = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit("")))
    return F.when(F.length(line) == 0, 0).otherwise(separators + 1)


def scan_lines(
    spark: SparkSession,
    dirs: list[str],
    schema: StructType = READINGS,
    glob: str = CSV_FILES,
    key: str | None = "vm_id",
    modulus: int | None = None,
) -> DataFrame:
    """All lines with tenant, path, text fields and the marks ``is_valid`` and ``is_sampled``.

    ``modulus`` keeps one key in so many; without it every line is sampled in.
    """
    files = spark.read.option("pathGlobFilter", glob).text(dirs)
    return mark_lines(files.select("value", F.col("_metadata.file_path").alias("path")), schema, key, modulus)


def mark_lines(lines: DataFrame, schema: StructType = READINGS, key: str | None = "vm_id", modulus: int | None = None) -> DataFrame:
    """Marks for any table of lines with ``value`` and ``path``; also for streams of text files."""
    texts = ", ".join(f"`{name}` STRING" for name in schema.fieldNames())
    options = {"mode": "PERMISSIVE", "escape": '"'}
    parsed = lines.select(
        tenant_of(F.col("path")).alias("tenant_id"), "path", "value", F.from_csv("value", texts, options).alias(FIELDS)
    )
    sampled = F.lit(True)
    if modulus and key in schema.fieldNames():
        sampled = F.coalesce(in_key_sample(F.coalesce(F.col(f"{FIELDS}.{key}"), F.lit("")), modulus), F.lit(False))
    return parsed.withColumns({"is_valid": _field_count(F.col("value")) >= len(schema), "is_sampled": sampled})


def _converted(schema: StructType, on_error: str) -> list[Column]:
    return [convert_text(F.col(f"{FIELDS}.{f.name}"), f.dataType, on_error).alias(f.name) for f in schema]


def typed_readings(lines: DataFrame, schema: StructType = READINGS, on_error: str = "default") -> DataFrame:
    """Typed rows of the valid, sampled lines.

    ``on_error="default"`` fills what cannot be converted; ``"quarantine"`` leaves such rows out,
    and :func:`rejected_lines` gives them.
    """
    good = lines.filter("is_valid AND is_sampled")
    if on_error == "default":
        return good.select("tenant_id", *_converted(schema, "default"))
    return good.select("tenant_id", *_converted(schema, "null")).dropna(subset=schema.fieldNames())


def rejected_lines(lines: DataFrame, schema: StructType = READINGS) -> DataFrame:
    """Lines that are too short or have a field that cannot be converted, with the reason."""
    values = _converted(schema, "null")
    failed = F.array_compact(F.array(*[F.when(v.isNull(), f.name) for v, f in zip(values, schema)]))
    reason = F.when(~F.col("is_valid"), "too few fields").when(F.size(failed) > 0, F.concat(F.lit("bad "), F.array_join(failed, ",")))
    return lines.filter("is_sampled").select("tenant_id", "path", "value", reason.alias("reason")).filter("reason IS NOT NULL")


def read_readings_csv(
    spark: SparkSession,
    dirs: list[str],
    schema: StructType = READINGS,
    glob: str = CSV_FILES,
    modulus: int | None = None,
    on_error: str = "default",
) -> DataFrame:
    """Typed readings of several tenant directories, plain or compressed."""
    return typed_readings(scan_lines(spark, dirs, schema, glob, "vm_id", modulus), schema, on_error)
