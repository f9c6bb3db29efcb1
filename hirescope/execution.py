"""Small execution helpers shared by operators.

* ``broadcast_if_small``: broadcast a side only after its row count has been
  checked against a bound; above it, leave the join to the planner (sort-merge /
  shuffle-hash, with AQE free to convert at run time).
* ``cut_lineage``: a table written into the shared folder named by
  ``spark.checkpoint.dir`` (never a local checkpoint), so iterative loops keep
  short plans and survive executor loss.
* ``drop_table``: removes such a table once no later step reads it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirescope.session import ensure_checkpoint_dir

# Rows we are willing to ship to every executor for a hinted broadcast join
# (the tables broadcast here are narrow: a key and a number or a short string).
DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 256 << 20


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, known_rows: int | None = None,
                       known_bytes: int = 0, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Return ``broadcast(df)`` when it provably has at most ``max_rows`` rows (and, where
    the caller knows the size of its strings, at most ``max_bytes``)."""
    n = known_rows if known_rows is not None else df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows and known_bytes <= max_bytes else df


def cut_lineage(df: DataFrame, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` once, as Parquet (with the writer's ``options``), below the shared
    folder that ``spark.checkpoint.dir`` names, and read it back.

    Like a reliable checkpoint it survives lost executors; it runs the plan once
    (an eager checkpoint needs a cache for that), is columnar and compressed, and
    leaves nothing cached.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_table(table: DataFrame) -> None:
    """Remove a table that ``cut_lineage`` returned and that no later step reads."""
    spark = table.sparkSession
    root = spark.sparkContext.getCheckpointDir()
    for path in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        if root and at.getName().startswith("table-") and at.getParent().getName() == root.rstrip("/").rsplit("/", 1)[-1]:
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
