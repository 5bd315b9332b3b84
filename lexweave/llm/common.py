"""Shared parts of the training-data operators: short batches, bounded samples; lineage and components are the library's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.operators.graph import components
from lexweave.plans.lineage import cut, drop, shared_dir

__all__ = ["bounded_sample", "components", "cut", "drop", "shared_dir", "text_batches", "unit_hash"]

#: Rows of one Arrow batch: texts can be very long, so batches are short.
ARROW_ROWS = 256


def text_batches(spark: SparkSession) -> None:
    """Keep Arrow batches short for operators that send whole texts to Python workers."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def unit_hash(*cols: str | Column, seed: str = "lexweave") -> Column:
    """A uniform number in [0, 1) that depends on the columns' values only."""
    return F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1 << 40)) / F.lit(float(1 << 40))


def bounded_sample(df: DataFrame, stratum: str, key: str, bound: int) -> DataFrame:
    """About ``bound`` rows of each value of ``stratum`` (all, if it has fewer), chosen by a hash of ``key``.

    One pass over two columns counts the strata; a row stays if its hash is under bound / count. The number
    that stays is binomial, so within a few times sqrt(bound) of the bound; no sort, no window, no shuffle of
    the rows. ``stratum`` is a small domain, such as a label.
    """
    sizes = {r[0]: r[1] for r in df.groupBy(stratum).count().collect()}
    share = F.lit(0.0)
    for value, n in sizes.items():
        share = F.when(F.col(stratum).eqNullSafe(F.lit(value)), F.lit(min(1.0, bound / n))).otherwise(share)
    return df.where(unit_hash(key) < share)
