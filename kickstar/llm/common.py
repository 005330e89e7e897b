"""Helpers shared by the training-data operators: words, shared folders, raw files."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kickstar.session import checkpoint_dir

# The characters that separate words, and the letters that are lower-cased.
WORD_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"     # on text whose A-Z are lower-cased
SPACE_BREAKS = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Lower-cased words of a text (digits, letters, anything beyond ASCII); null has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), WORD_BREAKS), "")


def space_words(text: Column) -> Column:
    """Runs of characters between ASCII white space; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_BREAKS), "")


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, wherever the optimizer moves the expression."""
    return F.element_at(F.transform(F.array(value), use), 1)


def without(df: DataFrame, new: Iterable[str], keep: Iterable[str] = ()) -> DataFrame:
    """``df`` without the columns that have the name of a result column in any case; columns
    in ``keep`` stay."""
    clash, keep = {c.lower() for c in new}, set(keep)
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in clash or c in keep])


def masked(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns renamed by position, and the new name of each: whatever the
    columns are called, a helper column of an operator never meets its own name among them."""
    names = {c: f"in_{i}_" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def unmasked(names: dict[str, str]) -> list[Column]:
    """The columns of a masked frame under their own names."""
    return [F.col(new).alias(own) for own, new in names.items()]


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder of ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write the rows once to the shared folder and read them back: cuts the lineage, so
    a recomputed task reads the same rows, ids and partitions."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, n: int, label: str) -> DataFrame:
    """Write the rows once to the shared folder, dealt into ``n`` buckets of ``key``, and read
    them back: joins on ``key`` that deal the other side into ``n`` parts leave them in place."""
    spark = df.sparkSession
    path = scratch(spark, label)
    name = "kickstar_" + path.rpartition("/")[2].replace("-", "_")
    df.write.bucketBy(n, key).option("path", path).option("compression", "zstd").saveAsTable(name, format="parquet")
    return spark.table(name)


def fraction(x: float) -> tuple[int, int]:
    """A threshold as written (0.8 is 4/5), so that comparisons stay in integers."""
    f = Fraction(str(x))
    return f.numerator, f.denominator


def write_files(df: DataFrame, column: str, path: str, ending: bytes) -> None:
    """Write every row's bytes as a file of its own, closed by ``ending``, on any file
    system that Spark writes to.

    The text writer copies a string's bytes as they are and ends each row with the line
    separator; the separator here is the last bytes of the file format, so the files hold
    exactly the format. Spark's commit protocol keeps files of failed or repeated tasks out."""
    (df.select(F.col(column).cast("string").alias("value")).write
     .option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1")
     .option("lineSep", ending.decode("latin-1")).text(path))


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of the files below ``path``; their size is bounded by the writer."""
    return spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")
