"""JSON lines in and out, with a dead-letter log, and small JSON documents written whole."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from foliospark.sources.tables import cut

JavaObject = Any


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of JSON lines. A missing path is an empty table; blank and malformed lines are left out whatever columns are read."""
    kept = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    try:
        lines = spark.read.text(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)
    # lines are parsed whole, so that a narrow read judges them alike
    parsed = lines.where(F.trim("value") != "").select(F.from_json("value", kept, {"columnNameOfCorruptRecord": "_corrupt_record"}).alias("r"))
    return parsed.where("r is not null and r._corrupt_record is null").select(*(F.col("r")[f.name].alias(f.name) for f in schema.fields))


def append_jsonl(df: DataFrame, path: str) -> None:
    """Appends rows as JSON lines (null fields kept); the commit protocol shows all of them or none."""
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def replace_jsonl(df: DataFrame, path: str) -> None:
    """Writes rows as JSON lines in place of what is in the folder, so that a repeated step repeats no row."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def replace_text(df: DataFrame, path: str) -> None:
    """As ``replace_jsonl``, for rows that are lines already."""
    df.write.mode("overwrite").text(path)


def written_or_set_aside(df: DataFrame, path: str, dead_letters: str, write: Callable[[DataFrame, str], None] = append_jsonl) -> bool:
    """Writes; where that fails, the batch goes to the dead-letter folder with the error. Whether it succeeded.

    Rows are computed once, before they are written, so that no call behind them is repeated.
    """
    rows = cut(df)
    try:
        write(rows, path)
        return True
    except Exception as error:  # any storage failure
        failed = rows.select(F.lit(int(time.time())).cast("long").alias("timestamp_epoch"), F.lit(path).alias("target_path"), F.lit(str(error)[:2000]).alias("error"), F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("record"))
        append_jsonl(failed, dead_letters)
        return False


def _at(spark: SparkSession, path: str | Path) -> tuple[JavaObject, JavaObject]:
    place = spark._jvm.org.apache.hadoop.fs.Path(str(path))
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def write_json(spark: SparkSession, document: dict, path: str | Path) -> None:
    """Replaces a small JSON document as a whole, on any file system that Spark reaches: written aside, then renamed over the old one."""
    jvm = spark._jvm
    (place, files), (aside, _) = _at(spark, path), _at(spark, f"{path}.new")
    out = files.create(aside, True)
    out.write(bytearray(json.dumps(document, ensure_ascii=False, indent=2).encode("utf-8")))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark._sc._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.makeQualified(place).toUri(), spark._jsc.hadoopConfiguration()).rename(files.makeQualified(aside), files.makeQualified(place), how)


def read_json(spark: SparkSession, path: str | Path) -> dict | None:
    """A small JSON document; None where there is none."""
    place, files = _at(spark, path)
    return json.loads("\n".join(r[0] for r in spark.read.text(str(path)).collect())) if files.exists(place) else None


def remove(spark: SparkSession, path: str | Path) -> None:
    """Deletes a file or folder; a missing one is no error."""
    place, files = _at(spark, path)
    files.delete(place, True)
