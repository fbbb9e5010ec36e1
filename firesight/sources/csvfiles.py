"""Tolerant CSV acquisition files, one per node (S4), and sequencing."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firesight.operators.chunks import PART, PLACE, place_in_key, sorted_parts
from firesight.spec import SENSOR_COLUMNS

# Literals as the acquisition files write them; a suffix as in "1.0d" is junk.
NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
INT_PATTERN = r"^[+-]?[0-9]+$"


def _bare(c: Column) -> Column:
    """Text without leading and trailing white space of any kind."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def tolerant_double(c: Column) -> Column:
    """Trimmed text to double; blank, missing, NaN or anything but a number -> null."""
    t = _bare(c)
    return F.when(t.rlike(NUMBER), t.try_cast("double"))


def strict_int(c: Column) -> Column:
    """Trimmed text to int only when it is an integer literal ('1.0' -> null)."""
    t = _bare(c)
    return F.when(t.rlike(INT_PATTERN), t.try_cast("int"))


def _headers(spark: SparkSession, paths) -> dict[str, list[str]]:
    """Header line -> the files that start with it.

    The first line of a file is the one of least position in the partition that
    holds the file's start; one row per file reaches the driver, as a file listing does.
    """
    lines = (spark.read.text(paths)
             .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
             .withColumn("n", F.monotonically_increasing_id()))
    first = lines.filter("at = 0").groupBy("file").agg(F.min_by("value", "n").alias("header"))
    out: dict[str, list[str]] = {}
    for r in first.sort("file").toLocalIterator():
        out.setdefault(r["header"], []).append(r["file"])
    return out


def read_csv_readings(spark: SparkSession, paths, node_pattern: str = r"(nodo_[0-9]+)") -> DataFrame:
    """Read acquisition CSVs with every column as text, then parse tolerantly.

    Every file is read by its own header: files with the same header are one
    scan, and the scans are united by column name. A file without a ``Fire``
    column gives null labels, and columns may stand in any order. The node id
    comes from the file name. No schema inference pass over the data.
    """
    parts = []
    for header, files in _headers(spark, paths).items():
        names = next(csv.reader([header]))
        names = [n.strip().lstrip("\ufeff") for n in names]
        schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
        raw = spark.read.schema(schema).option("header", "true").option("enforceSchema", "true").csv(files)
        at = {n: F.col(f"c{i}") for i, n in reversed(list(enumerate(names)))}
        null = F.lit(None).cast("string")
        parts.append(raw.select(*[tolerant_double(at.get(c, null)).alias(c) for c in SENSOR_COLUMNS],
                                strict_int(at.get("Fire", null)).alias("Fire"),
                                F.regexp_extract(F.input_file_name(), node_pattern, 1).alias("node_id")))
    if not parts:
        schema = T.StructType([*[T.StructField(c, T.DoubleType()) for c in SENSOR_COLUMNS],
                               T.StructField("Fire", T.IntegerType()), T.StructField("node_id", T.StringType())])
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts)


def assign_index(df: DataFrame, order_col: str, chunk_width: int | None = None, base_ts: Column | None = None,
                 step_ms: int = 500, key: str = "node_id", tie: str | None = None) -> DataFrame:
    """Per-key running index (0, 1, 2, ... in ``order_col`` order, then by
    ``tie``) and a stamped time ``base_ts + index * step_ms``.

    The index is a row's place in a sorted copy (``operators/chunks.py``): one range exchange whose
    partitions are cut by a sample of the rows, so neither a key nor an hour that holds most rows is one task.

    With ``chunk_width`` a two-level prefix count without a copy, for orders that are spread evenly:
    rows are cut into chunks of ``chunk_width`` order values, chunk sizes are
    counted (a partial aggregate), an exclusive running sum over the small
    chunk table gives each chunk's offset, and ``row_number`` runs only inside
    (key, chunk).
    """
    dtype = df.schema[order_col].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        num = F.unix_micros(F.col(order_col).cast("timestamp"))
    else:
        num = F.col(order_col).cast("long")
    base = df.withColumn("_o", num)
    if chunk_width is None:
        placed = place_in_key(sorted_parts(base, key, ["_o", *([tie] if tie else [])]), key)
        seq = placed.withColumn("reading_index", F.col("_n").cast("long")).drop(PART, PLACE, "_n")
    else:
        base = base.withColumn("_c", F.floor(F.col("_o") / F.lit(int(chunk_width))))
        sizes = base.groupBy(key, "_c").agg(F.count(F.lit(1)).alias("_size"))
        before = Window.partitionBy(key).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
        offsets = sizes.select(key, "_c", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
        local = F.row_number().over(Window.partitionBy(key, "_c").orderBy("_o", *([tie] if tie else [])))
        seq = (base.withColumn("_local", local)
               .join(offsets, [key, "_c"], "left")
               .withColumn("reading_index", (F.col("_offset") + F.col("_local") - 1).cast("long")))
    stamped = seq.withColumn(
        "stamped_ts", F.timestamp_add("MILLISECOND", F.col("reading_index") * F.lit(step_ms), base_ts))
    return stamped.drop("_o", "_c", "_local", "_offset")
