"""Helpers shared by the operators of this subpackage.

Several operators work in three steps over *batches* of rows:

1. ``scan``: each task cuts its rows into batches of a few MB of text, gives each
   batch a number ``g`` and emits what other tasks need, pre-aggregated per batch;
2. ``answer``: rows meet by key ``k`` and answers go back to the batches that asked;
3. ``finish``: the answers of a batch meet what the batch kept for itself.

A key that a third of all rows share costs one row per batch in step 2, so no
task grows with a hot key. Batch numbers come from the partition and the place
in it, so a repeated task gives the same rows as long as the input is a scan
(a Parquet table), which is what the queries and the pipeline stages pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firesight.session import unique_shared_path

#: White space that separates words: space and U+0009 to U+000D.
SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"

#: Text bytes per batch of the scan / answer / finish pattern.
BATCH_BYTES = 2 << 20

#: Columns of a row that travels between the steps: routing key, batch, kind
#: (requests and answers sort before what a batch keeps), and packed values.
EXCHANGE = "k long, g long, kind int, a binary, b binary"
_EXCHANGE_PA = pa.schema([("k", pa.int64()), ("g", pa.int64()), ("kind", pa.int32()),
                          ("a", pa.binary()), ("b", pa.binary())])


def tune(spark: SparkSession) -> None:
    """Small Arrow batches, so that a run of very long texts fits a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tune(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` as a Parquet table in the shared folder: lineage ends here."""
    spark = df.sparkSession
    path = unique_shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_rows(df: DataFrame):
    """All columns as one struct, so that a step's own columns can't clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def key_count(spark: SparkSession, per_partition: int = 4) -> int:
    """Number of routing keys: follows the shuffle partitions the cluster sets for its input."""
    return max(64, per_partition * partitions(spark))


def by_key(df: DataFrame) -> DataFrame:
    """Rows of a routing key together; every partition gets as many keys (give or take one)."""
    n = partitions(df.sparkSession)
    return df.repartitionById(n, F.pmod(F.col("k"), F.lit(n)).cast("int"))


def by_batch(df: DataFrame) -> DataFrame:
    """Rows of a batch together, the batches of a scan's tasks dealt in turn."""
    n = partitions(df.sparkSession)
    turn = F.shiftright("g", 32) + F.col("g").bitwiseAND(F.lit((1 << 32) - 1)) * 31
    return df.repartitionById(n, F.pmod(turn, F.lit(n)).cast("int"))


def exchange_rows(rows: list[tuple]) -> pa.RecordBatch:
    """(k, g, kind, a, b) tuples as one Arrow batch."""
    cols = list(zip(*rows)) if rows else [()] * 5
    return pa.record_batch([pa.array(c, type=f.type) for c, f in zip(cols, _EXCHANGE_PA)], schema=_EXCHANGE_PA)


def in_batches(batches: Iterator[pa.RecordBatch], text: str, limit: int = BATCH_BYTES):
    """Cut a task's rows into (g, record batch) pieces of about ``limit`` bytes of text.

    A single longer text is a piece of its own. ``g`` is unique over all tasks; the partition
    comes from column ``_part``, as a task's own number changes under a union.
    """
    n = 0
    for batch in batches:
        part = batch.column("_part")[0].as_py() if batch.num_rows and "_part" in batch.schema.names else 0
        lengths = np.asarray(pc.binary_length(batch.column(text)).fill_null(0))
        start = 0
        while start < batch.num_rows:
            size = np.cumsum(lengths[start:])
            stop = start + max(1, int(np.searchsorted(size, limit, side="right")))
            yield (part << 32) | n, batch.slice(start, stop - start)
            n += 1
            start = stop


class Packer:
    """Byte strings as one compressed value, with a shared sample of such strings if there is one."""

    def __init__(self, sample: bytes = b"", level: int = 3):
        shared = zstandard.ZstdCompressionDict(sample, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if sample else None
        if shared:
            shared.precompute_compress(level=level)
        self.compressor = zstandard.ZstdCompressor(level=level, dict_data=shared)
        self.decompressor = zstandard.ZstdDecompressor(dict_data=shared)

    def pack(self, parts: list[bytes]) -> bytes:
        return self.compressor.compress(np.array([len(parts), *map(len, parts)], "<u4").tobytes() + b"".join(parts))

    def unpack(self, packed: bytes):
        data = self.decompressor.decompress(packed)
        n = int.from_bytes(data[:4], "little")
        at = 4 + 4 * n
        for size in np.frombuffer(data, "<u4", n, 4).tolist():
            yield data[at:at + size]
            at += size


_plain = Packer()


def pack(parts: list[bytes]) -> bytes:
    return _plain.pack(parts)


def unpack(packed: bytes):
    return _plain.unpack(packed)


def pack_rows(batch: pa.RecordBatch, names: list[str]) -> bytes:
    """Some columns of a batch as bytes."""
    part = pa.RecordBatch.from_arrays([batch.column(c) for c in names], names=names)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, part.schema) as out:
        out.write_batch(part)
    return sink.getvalue().to_pybytes()


def unpack_rows(data: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(data).read_next_batch()


def texts_of(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The column's texts as UTF-8 bytes; null is empty."""
    return [x if x is not None else b"" for x in batch.column(name).cast(pa.binary()).to_pylist()]


def rows_sorted(batches: Iterator[pa.RecordBatch]):
    """(k, g, kind, a, b) tuples of a sorted partition, one by one."""
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def keep_texts(names: list[str], limit: int = BATCH_BYTES):
    """A scan that sends each batch's rows and texts to where its answers meet."""
    def run(batches):
        for g, batch in in_batches(batches, "_text", limit):
            yield exchange_rows([(0, g, 1, pack_rows(batch, names), pack(texts_of(batch, "_text")))])
    return run


def run_exchange(docs: DataFrame, scan: Callable, answer: Callable, finish: Callable, schema,
                 extra: DataFrame | None = None, keep: Callable | None = None) -> DataFrame:
    """scan -> meet by key -> answer -> meet by batch -> finish (see the module's text).

    ``extra``: further rows of the EXCHANGE schema that take part in step 2. ``keep``: a second
    scan of the same rows in the same batches, whose rows go straight to the last step.
    """
    docs = docs.withColumn("_part", F.spark_partition_id())
    asked = docs.mapInArrow(scan, EXCHANGE)
    if extra is not None:
        asked = asked.unionByName(extra)
    answered = by_key(asked).sortWithinPartitions("k", "kind", "g").mapInArrow(answer, EXCHANGE)
    if keep is not None:
        answered = answered.unionByName(docs.mapInArrow(keep, EXCHANGE))
    return by_batch(answered).sortWithinPartitions("g", "kind", "k").mapInArrow(finish, schema)
