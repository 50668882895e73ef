"""Table scans, full refresh and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    select: Sequence[str] = (),
) -> DataFrame:
    """Scan a Parquet table; only the selected columns are read.

    With a schema no file has to be opened before the query runs.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    return df.select(*select) if select else df


def read_jdbc(
    spark: SparkSession, url: str, table: str, key: str, bounds: tuple[int, int], partitions: int
) -> DataFrame:
    """Scan a database table in ``partitions`` parallel ranges of a numeric key."""
    lower, upper = bounds
    return spark.read.jdbc(
        url, table, column=key, lowerBound=lower, upperBound=upper, numPartitions=partitions
    )


def range_predicates(column: str, bounds: Sequence) -> list[str]:
    """Conditions that split a table by the values of a text, date or number column.

    ``bounds`` ascend; they give one range more than there are bounds, and rows without a value go
    to the first. Every row meets exactly one condition.
    """

    def literal(value) -> str:
        return str(value) if isinstance(value, int | float) else "'" + str(value).replace("'", "''") + "'"

    name = '"' + column.replace('"', '""') + '"'
    marks = [literal(b) for b in bounds]
    if not marks:
        return ["1 = 1"]
    inner = [f"{name} >= {a} AND {name} < {b}" for a, b in zip(marks, marks[1:])]
    return [f"{name} < {marks[0]} OR {name} IS NULL", *inner, f"{name} >= {marks[-1]}"]


def read_jdbc_ranges(
    spark: SparkSession, url: str, table: str, column: str, bounds: Sequence, properties: dict[str, str] | None = None
) -> DataFrame:
    """Scan a database table in parallel ranges of a column of any type, such as a text key."""
    return spark.read.jdbc(url, table, predicates=range_predicates(column, bounds), properties=properties)


def refresh_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Replace the table. With ``partition_by`` a reader that filters on it opens only its folders.

    The new rows are written beside the table and then moved to its place. So they may be read from the
    table itself, and a job that fails leaves it as it was; only between the two steps at the end is there
    no table. ``martwright.sources.versions`` has no such moment, and replaces several tables at once.

    Rows go to the folders from the tasks that hold them: no shuffle by the folder column, which
    would put a whole region into one task. An empty string in that column comes back as null.
    """
    path = path.rstrip("/")
    beside, writer = f"{path}-{uuid.uuid4().hex}", df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(beside)
    spark = df.sparkSession
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, beside))
    files = old.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(old, True)
    if not files.rename(new, old):
        raise OSError(f"the new rows lie in {beside}, as they could not be moved to {path}")


def append_rows(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder.

    On a local master without a setting a temporary one, which goes when the program ends.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="martwright-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, one row each."""
    parts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.orderBy("table_name")
