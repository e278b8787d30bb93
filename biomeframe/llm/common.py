"""What several training-data operators share."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of anything but these six ASCII white-space characters.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trimmed(text: Column) -> Column:
    """``text`` without white space at its ends; null counts as empty."""
    return F.trim(F.coalesce(text, F.lit("")), F.lit(SPACES))


def words(text: Column) -> Column:
    """The words of a text as an array; none for null, empty and blank texts."""
    inner = trimmed(text)
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE_RUN))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added while the frame has such a column."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name

_SHIPPED: set[str] = set()


def shipped(spark: SparkSession) -> SparkSession:
    """Hand this package to the Python workers of the session's executors, once.

    Needed by operators that run Python functions of this package; the zip goes
    through Spark's own file server, so executors need no copy of the library.
    """
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = Path(__file__).resolve().parents[1]
        at = Path(tempfile.mkdtemp(prefix="package-")) / f"{root.name}.zip"
        with zipfile.ZipFile(at, "w") as out:
            for file in sorted(root.rglob("*.py")):
                out.write(file, file.relative_to(root.parent))
        context.addPyFile(str(at))
        _SHIPPED.add(context.applicationId)
    return spark
