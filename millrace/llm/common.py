"""Word splitting, fold columns and table access that several operators share."""

from __future__ import annotations

import os
import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Everything that is neither an ASCII letter or digit nor beyond ASCII.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows of an Arrow batch that Python workers get.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: Column) -> Column:
    """The text, empty for null."""
    return F.coalesce(text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def plain_words(text: Column) -> Column:
    """Words of letters, digits and non-ASCII characters, lower-cased; none for null."""
    return F.array_remove(F.split(ascii_lower(whole(text)), BETWEEN_WORDS), "")


def held_out(doc_id: Column) -> Column:
    """True for the fold that no model may learn from; null ids are not in it."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def joined_ids(ids: Column) -> Column:
    """Hash of ids sorted as strings and joined by commas."""
    return F.sha2(F.concat_ws(",", F.array_sort(ids.cast("array<string>"))), 256)


def map_batches(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``mapInArrow`` whose Python workers look for this package where the driver found it.

    Clusters whose machines do not have it at that path need it installed or passed with
    ``--py-files``, like any library.

    Texts take many times their size in Python, so the session's Arrow batches are held to
    BATCH_ROWS rows where they are larger.
    """
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(BATCH_SETTING)) <= BATCH_ROWS:
        conf.set(BATCH_SETTING, str(BATCH_ROWS))
    home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = df.sparkSession.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if home not in known:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*known, home]))
    return df.mapInArrow(run, schema)


def once(**columns: Column) -> Column:
    """A generator of one struct row: what it holds is computed once per row, however often it is used."""
    return F.explode(F.array(F.struct(*[column.alias(name) for name, column in columns.items()])))
