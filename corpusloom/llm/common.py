"""What the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.storage import spread

#: ASCII white space, as a character class and as characters.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data directory; the path may be of any file system that Spark reads."""
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def ascii_lower(c: Column) -> Column:
    """A-Z in lower case, all else as it is; pure ASCII takes the faster way."""
    return F.when(F.char_length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def boxed(rows: DataFrame) -> DataFrame:
    """(__row): each row as one struct, so that no column of the user's meets one of ours, whatever its name."""
    return rows.select(F.struct("*").alias("__row"))


def field(name: str) -> Column:
    return F.col("__row").getField(name)


def unboxed(rows: DataFrame, names: list[str], new: dict[str, Column] | None = None) -> DataFrame:
    """The user's columns out of ``__row``, those in ``new`` by their new values."""
    return rows.select(*[(new or {}).get(c, field(c)).alias(c) for c in names])


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def seeded_sample(rows: DataFrame, key: Column, size: int, seed: str, total: int | None = None) -> DataFrame:
    """``size`` rows at most, those of the smallest seeded hashes of ``key``.

    ``total`` (counted if not given) sets the share of hashes that takes part
    at all, twice what ``size`` needs, so tasks don't each send ``size`` rows.
    """
    total = rows.count() if total is None else total
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))
    unit = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / 2**32
    share = min(1.0, max(2 * size, 200) / max(total, 1))
    others = [c for c, kind in rows.dtypes if kind != "map"]
    return rows.where(unit < share).orderBy(digest, *others).limit(size)
