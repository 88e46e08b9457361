"""Tables that are small by their nature: contigs, samples, pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows up to which a table counts as small.
SMALL_ROWS = 100_000


def local(table: DataFrame, most: int = SMALL_ROWS) -> DataFrame:
    """The rows of ``table`` as a table of known size, so that a join with it never moves the other side.

    One row more than ``most`` is asked for: a table with that many comes back as it
    is and is joined as Spark sees fit. It runs here, so that a table of figures over
    all alignments is made once, however often it is used.
    """
    found = table.limit(most + 1).toArrow()
    return table if found.num_rows > most else F.broadcast(table.sparkSession.createDataFrame(found, table.schema))


def on_all_cores(table: DataFrame) -> DataFrame:
    """``table`` dealt to as many tasks as the session has cores, where it would be read by fewer: one file of few rows is then no bottleneck.

    Tables of at least as many tasks stay as they are, so that nothing moves at scale.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores) if table.rdd.getNumPartitions() < cores else table
