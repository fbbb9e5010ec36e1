"""SimHash near-dedup with an inverted index over positional fingerprint bytes.

A 64-bit fingerprint is eight bytes at fixed positions. Two fingerprints that
differ in at most ``d`` bits differ in at most ``d`` bytes, so they share at
least ``8 - d`` positional bytes: the guaranteed minimum of the count filter.
A list for a single positional byte would hold 1/256 of the corpus, so the index
is keyed by the bytes of two byte groups at once: the bytes are cut into ``d + 2``
groups of which at least two are free of differing bits, so every linked pair
meets in a list. Pairs from a list are tallied (shared positional bytes), kept
from the minimum on, and verified on the fingerprints' bits.

A list of more than ``LIST_PAIRS`` fingerprints isn't expanded into pairs. Its
members go under the fingerprints at most one bit away from them (65 centres
each). Two members within two bits always share a centre, and all members of a
centre are within two bits of each other, so linking a centre's members to the
smallest one gives the same components. A centre has 65 members at most.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firesight.llm.common import table, texts_of, tune, whole_rows, written
from firesight.llm.components import components

#: Lists up to this many distinct fingerprints are compared pair by pair, longer ones by centres.
LIST_PAIRS = 32

_hash = partial(xxhash.xxh64_intdigest, seed=42)


def simhash(text: bytes, shingle: int = 3) -> int:
    """Fingerprint of a UTF-8 text; 0 without words. Bit is 1 if set in over half the hashes."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    h = np.fromiter(map(_hash, parts), dtype="<u8", count=max(1, len(words) - shingle + 1))
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), 1 << 16):
        bits = np.unpackbits(h[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3) -> DataFrame:
    """``docs`` with a column ``_fp``: the fingerprint as a signed 64-bit number."""
    def run(batches):
        for batch in batches:
            values = np.array([simhash(t, shingle) for t in texts_of(batch, "_text")], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(batch.num_columns - 1)), pa.array(values)],
                names=[*batch.schema.names[:-1], "_fp"])

    cols = [c for c in docs.columns if c not in ("_fp", "_text", text)]
    sent = docs.select(*cols, F.col(text).alias("_text"))
    schema = sent.drop("_text").schema.add("_fp", "long")
    return sent.mapInArrow(run, schema)


def _byte_groups(max_bits: int) -> list[list[int]]:
    return [list(map(int, g)) for g in np.array_split(np.arange(8), max_bits + 2)]


def fingerprint_links(classes: DataFrame, max_bits: int = 2, list_pairs: int = LIST_PAIRS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column ``_fp``) that give the components
    of "at most ``max_bits`` differing bits" (``max_bits`` 0, 1 or 2)."""
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits must be 0, 1 or 2: a list's centres are the fingerprints one bit away")
    if max_bits == 0:
        return classes.select(F.col("_fp").alias("a"), F.col("_fp").alias("b")).limit(0)
    groups = _byte_groups(max_bits)
    keys = []
    for n, pair in enumerate(combinations(range(len(groups)), 2)):
        mask = sum(0xFF << (8 * i) for g in pair for i in groups[g])
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        keys.append(F.struct(F.lit(n).alias("n"), F.col("_fp").bitwiseAND(F.lit(signed)).alias("bytes")))
    lists = classes.select("_fp", F.explode(F.array(*keys)).alias("key")).select("key.n", "key.bytes", "_fp")
    sizes = lists.groupBy("n", "bytes").agg(F.count("*").alias("size")).filter("size > 1")

    def shared(x):
        return sum((F.shiftright(x, 8 * i).bitwiseAND(F.lit(255)) == 0).cast("int") for i in range(8))

    def linked(x, y):
        differ = x.bitwiseXOR(y)
        return (shared(differ) >= 8 - max_bits) & (F.bit_count(differ) <= max_bits)

    few = (lists.join(sizes.filter(F.col("size") <= list_pairs), ["n", "bytes"])
           .groupBy("n", "bytes").agg(F.collect_list("_fp").alias("fps")))
    pairs = F.flatten(F.transform("fps", lambda x: F.transform(
        F.filter("fps", lambda y: (y > x) & linked(x, y)), lambda y: F.struct(x.alias("a"), y.alias("b")))))
    close = few.select(F.explode(pairs).alias("p")).select("p.a", "p.b")

    many = (lists.join(sizes.filter(F.col("size") > list_pairs), ["n", "bytes"], "left_semi")
            .select("_fp").distinct())
    flips = F.concat(F.array(F.col("_fp")), F.transform(
        F.array(*[F.lit(1 << i if i < 63 else -(1 << 63)) for i in range(64)]), lambda m: F.col("_fp").bitwiseXOR(m)))
    balls = (many.select("_fp", F.explode(flips).alias("centre")).groupBy("centre")
             .agg(F.collect_list("_fp").alias("fps")).filter(F.size("fps") > 1))
    if max_bits == 1:  # members one bit away from a centre are linked to it, not to each other
        balls = balls.filter(F.array_contains("fps", F.col("centre")))
        star = F.transform("fps", lambda y: F.struct(F.col("centre").alias("a"), y.alias("b")))
    else:
        star = F.transform("fps", lambda y: F.struct(F.array_min("fps").alias("a"), y.alias("b")))
    hot = balls.select(F.explode(star).alias("p")).select("p.a", "p.b").filter("a <> b")
    return close.unionAll(hot)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3,
                    max_bits: int = 2, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: the id, the columns in ``keep``, ``fingerprint`` (16 hex digits),
    ``component_id``, the smallest id reachable by links, and ``component``, a number of its own for each.

    Null text is empty; texts without words have fingerprint zero and link like any other.
    A null id takes part and gets its component's smallest id (null if all are null); repeated
    rows and repeated ids give a row each. Empty input gives no rows. Other columns are not read,
    so their names don't matter. Exact copies collapse to one fingerprint class before any pair.
    """
    tune(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("_id"), *[F.col(c).alias(f"_keep_{c}") for c in keep],
                       F.col(text).alias("_in"))
    # Written once: the texts are hashed one time only.
    fps = written(fingerprints(rows, "_in", shingle), "simhash-fps")
    classes = written(fps.groupBy("_fp").agg(F.min("_id").alias("_least")), "simhash-classes")
    links = fingerprint_links(classes, max_bits)
    roots = components(links, "a", "b", "simhash-links").withColumnRenamed("node", "_fp")
    rooted = classes.join(roots, "_fp", "left").select("_fp", "_least", F.coalesce("root", "_fp").alias("_root"))
    named = rooted.groupBy("_root").agg(F.min("_least").alias("component_id"))
    by_fp = rooted.join(named, "_root").select("_fp", "component_id", F.col("_root").alias("component"))
    hexed = F.lpad(F.lower(F.hex("_fp")), 16, "0")
    return fps.join(by_fp, "_fp").select(
        F.col("_id").alias(id_col), *[F.col(f"_keep_{c}").alias(c) for c in keep],
        hexed.alias("fingerprint"), "component_id", "component")


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the one with the smallest id (null last)."""
    # rows go by one number for id and text: the join and the drop of repeated rows share its exchange
    keyed = docs.select(whole_rows(docs).alias("_row"), F.col(id_col).alias("_id"), F.col(text).alias("_text"),
                        F.xxhash64(F.col(id_col), F.col(text)).alias("_at"))
    near = near_duplicates(keyed, "_id", "_text", shingle, max_bits, keep=("_at",))
    first = near.groupBy("component").agg(F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"),
                                                         F.col("_at").alias("at"))).alias("x")).select("x.at")
    return keyed.join(first, F.col("_at") == F.col("at"), "left_semi").dropDuplicates(["_at"]).select("_row.*")


def op3_simhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents")).drop("component")
