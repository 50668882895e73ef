"""Seed files: CSV with a header, typed on reading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.functions.dates import or_now
from martwright.sources.schemas import RAW_CUSTOMERS, RAW_ORDERS, columns

# Quotes inside a value are doubled, as spreadsheet programs and Python's csv module do. Null and
# the empty string are both written as nothing and read as null.
_FORMAT = {"header": True, "encoding": "UTF-8", "quote": '"', "escape": '"'}
_PLAIN = {
    "emptyValue": "",
    "nullValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}

SEED_SCHEMAS = {"raw_customers": RAW_CUSTOMERS, "raw_orders": RAW_ORDERS}


def write_seed(df: DataFrame, name: str, path: str) -> None:
    """Write the columns of the seed ``name`` in their fixed order."""
    rows = df.select(*columns(SEED_SCHEMAS[name]))
    rows.write.mode("overwrite").options(**_FORMAT, **_PLAIN).csv(path)


def read_seed(spark: SparkSession, name: str, path: str, multiline: bool = False) -> DataFrame:
    """Read a seed with its declared types; a value that does not parse fails the job.

    ``multiline`` allows line breaks inside quoted values, but then one task reads a whole file;
    leave it off for files that should be split.
    """
    reader = spark.read.schema(SEED_SCHEMAS[name]).options(
        **_FORMAT, mode="FAILFAST", enforceSchema=False, multiLine=multiline
    )
    return reader.csv(path)


CORRUPT = "_corrupt_record"
QUARANTINE = "seed string, file string, line string, reason string"


def read_seed_sorted(spark: SparkSession, name: str, path: str, multiline: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine): the rows of a seed that parse, and (seed, file, line, reason) of those that do not.

    A bad cell costs its row only. The reason names the columns whose value is not of their type, or
    says how many values the line has. Files whose header is another fail, as no row could be right.
    Both are lazy and read the files once each; a reason is worked out for bad lines alone.
    """
    schema = SEED_SCHEMAS[name]
    with_line = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(with_line).options(
        **_FORMAT, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, enforceSchema=False, multiLine=multiline,
        columnPruning=False,  # every value of a line is looked at, also where few columns are asked for
    )
    parsed = reader.csv(path)
    whole = parsed.select(*columns(schema), F.col(CORRUPT), F.col("_metadata.file_path").alias("_file"))
    # A value that nobody asks for is not parsed, and its line would pass; the hash asks for all.
    read = F.xxhash64(*columns(schema)) >= F.lit(-(1 << 63))
    rows = whole.filter(F.col(CORRUPT).isNull() & read).select(*columns(schema))
    bad = whole.filter(F.col(CORRUPT).isNotNull() & read)
    found = bad.select(F.lit(name).alias("seed"), F.col("_file").alias("file"), F.col(CORRUPT).alias("line"), *columns(schema))
    return rows, found.select("seed", "file", "line", _reason(schema).alias("reason"))


def _reason(schema: T.StructType) -> Column:
    """Why a line did not parse, from the line itself."""
    texts = ", ".join(f"`{f.name}` STRING" for f in schema) + ", `_more` STRING"
    values = F.from_csv(F.col("line"), F.lit(texts), {"sep": ",", "quote": '"', "escape": '"'})
    given = F.size(F.array_compact(F.array(*(values[f.name] for f in schema))))
    wrong = F.array_compact(
        F.array(
            *(
                F.when(F.col(f.name).isNull() & values[f.name].isNotNull() & (values[f.name] != ""), F.lit(f.name))
                for f in schema
                if not isinstance(f.dataType, T.StringType)
            )
        )
    )
    separators = F.length(F.regexp_replace("line", '"(?:[^"]|"")*"', "")) - F.length(F.replace(F.regexp_replace("line", '"(?:[^"]|"")*"', ""), F.lit(",")))
    count = separators + 1
    counted = F.concat(count.cast("string"), F.lit(f" values instead of {len(schema)}"))
    named = F.concat(F.lit("not of its type: "), F.array_join(wrong, ", "))
    return F.when(count != len(schema), counted).when(F.size(wrong) > 0, named).otherwise(F.concat(F.lit("not a line of "), given.cast("string"), F.lit(" values")))


def with_load_times(df: DataFrame) -> DataFrame:
    """Fill missing timestamp columns with the time of the run."""
    stamps = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: or_now(F.col(c)) for c in stamps})
