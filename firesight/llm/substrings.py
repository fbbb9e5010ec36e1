"""Substring dedup with prefix-partitioned suffix trees over words.

Suffixes are split by the first words they start with. A prefix that too many
suffixes share is lengthened (1, 2, then 8 words), and the resulting prefixes are
packed into groups of about equal size that fit a task's memory; what is still too
many is lengthened to the whole window and dealt to all groups by it. In a group, the
suffixes' subtrees are needed from depth ``window`` on only: a node there is the
set of suffixes that agree on their first ``window`` words, and it is internal if
it has two leaves or more. So a suffix travels as a 64-bit fingerprint of these
words, and the sorted fingerprints of a group are the leaves of its subtrees in
order. Windows of deep internal nodes repeat; consecutive ones join to the maximal
repeats, whose words are removed.

A batch sends each distinct window once, so a passage that a third of all texts
share costs a group one leaf per batch.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firesight.llm.common import (exchange_rows, in_batches, keep_texts, key_count, rows_sorted, run_exchange, table,
                                  texts_of, tune, unpack, unpack_rows)

WINDOW = 35
#: Lengths that a prefix may have, in words, and the number of classes its hash is counted in.
PREFIXES = (1, 2, 8)
SLOTS = 1 << 15
BATCH = 4 << 20
#: A slot of the longest prefix that is dealt over all of ``keys`` groups holds SPREAD - (keys - 1).
SPREAD = -2

_B = np.uint64(0x9E3779B97F4A7C15)
_B_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out)


class Suffixes:
    """The suffixes of a batch's texts that are at least a window long."""

    def __init__(self, texts: list[bytes], window: int):
        self.words = [t.split() for t in texts]
        self.sizes = np.array([len(w) for w in self.words], dtype=np.int64)
        n = int(self.sizes.sum())
        x = np.fromiter((xxhash.xxh3_64_intdigest(w) for ws in self.words for w in ws), dtype=np.uint64, count=n)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * _powers(_B, n))])
        self.inverse_powers = _powers(_B_INVERSE, n)
        ends = np.repeat(np.cumsum(self.sizes), self.sizes)
        self.starts = np.flatnonzero(np.arange(n) + window <= ends)
        self.window, self.n = window, n

    def hashes(self, length: int) -> np.ndarray:
        """Fingerprints of the first ``length`` words of every suffix (a polynomial in word hashes)."""
        s = self.starts
        return (self.sums[s + length] - self.sums[s]) * self.inverse_powers[s]

    def slots(self, length: int) -> np.ndarray:
        h = self.hashes(length)
        return (((h ^ (h >> np.uint64(31))) * _MIX) >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)

    def groups(self, plan: list[np.ndarray], whole: np.ndarray) -> np.ndarray:
        """The group of every suffix: by its shortest prefix that isn't lengthened; ``whole``: its window's fingerprint."""
        found = np.full(len(self.starts), -1, dtype=np.int64)
        for length, of_slot in zip(PREFIXES, plan):
            todo = found < 0
            if not todo.any():
                break
            found[todo] = of_slot[self.slots(length)[todo]]
        hot = found <= SPREAD
        spread = ((whole[hot] ^ (whole[hot] >> np.uint64(29))) * _MIX) >> np.uint64(20)
        found[hot] = (spread % (SPREAD - found[hot] + 1).astype(np.uint64)).astype(np.int64)
        return found

    def distinct(self, plan: list[np.ndarray]):
        """Distinct windows in the order of (group, fingerprint): fingerprint, group, twice, and each suffix's place."""
        h = self.hashes(self.window)
        group = self.groups(plan, h)
        order = np.lexsort((h, group))
        hs, gs = h[order], group[order]
        new = np.concatenate([[True], (hs[1:] != hs[:-1]) | (gs[1:] != gs[:-1])]) if len(hs) else np.zeros(0, bool)
        place = np.empty(len(h), dtype=np.int64)
        place[order] = np.cumsum(new) - 1
        counts = np.bincount(place, minlength=int(new.sum())) if len(h) else np.zeros(0, np.int64)
        return hs[new], gs[new], counts > 1, place


def _runs(values: np.ndarray):
    """(value, start, end) of equal values in order."""
    if not len(values):
        return
    cut = np.flatnonzero(np.diff(values)) + 1
    for s, e in zip(np.concatenate([[0], cut]).tolist(), np.concatenate([cut, [len(values)]]).tolist()):
        yield int(values[s]), s, e


def prefix_plan(rows: DataFrame, window: int, keys: int) -> list[np.ndarray]:
    """For each prefix length the group of each slot, or -1 where the prefix is lengthened; at the longest one, slots
    with more suffixes than a group should have are dealt over all groups (see SPREAD).

    Counts cover all suffixes. What reaches the driver has the fixed size of the slot table.
    """
    def count(batches):
        total = [np.zeros(SLOTS, dtype=np.int64) for _ in PREFIXES]
        for _, batch in in_batches(batches, "_text", BATCH):
            s = Suffixes(texts_of(batch, "_text"), window)
            for t, length in zip(total, PREFIXES):
                t += np.bincount(s.slots(length), minlength=SLOTS)
        level = np.repeat(np.arange(len(PREFIXES)), SLOTS)
        slot = np.tile(np.arange(SLOTS), len(PREFIXES))
        n = np.concatenate(total)
        some = n > 0
        yield pa.RecordBatch.from_arrays([pa.array(level[some], pa.int32()), pa.array(slot[some], pa.int32()),
                                          pa.array(n[some], pa.int64())], names=["level", "slot", "n"])

    counted = rows.mapInArrow(count, "level int, slot int, n long").groupBy("level", "slot").agg(F.sum("n").alias("n"))
    counts = np.zeros((len(PREFIXES), SLOTS), dtype=np.int64)
    for r in counted.toLocalIterator():
        counts[r.level, r.slot] = r.n
    limit = max(1, int(counts[0].sum()) // (4 * keys))
    plan = [np.full(SLOTS, -1, dtype=np.int64) for _ in PREFIXES]
    # longer prefixes of light ones are never asked for, so their counts only pad the packing
    loads = [(0, k) for k in range(keys)]
    for level in range(len(PREFIXES)):
        last = level == len(PREFIXES) - 1
        heavy = 1.0 if level == 0 else float(counts[level - 1][plan[level - 1] < 0].sum()) / max(1, counts[level - 1].sum())
        for slot in np.argsort(-counts[level], kind="stable").tolist():
            n = counts[level, slot]
            if n > limit:
                if last:
                    plan[level][slot] = SPREAD - (keys - 1)
                continue
            load, k = heapq.heappop(loads)
            plan[level][slot] = k
            heapq.heappush(loads, (load + int(n * heavy) + 1, k))
    return plan


def _scan(window: int, plan):
    def run(batches):
        for g, batch in in_batches(batches, "_text", BATCH):
            h, group, twice, _ = Suffixes(texts_of(batch, "_text"), window).distinct(plan)
            yield exchange_rows([(k, g, 0, h[s:e].tobytes(), np.packbits(twice[s:e]).tobytes()) for k, s, e in _runs(group)])
    return run


def _answer(batches):
    """Per group: which leaves stand under a deep internal node."""
    def answers(k, rows):
        leaves = [np.frombuffer(a, dtype=np.uint64) for _, a, _ in rows]
        twice = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=len(x)) for (_, _, b), x in zip(rows, leaves)])
        sizes = [len(x) for x in leaves]
        flat = np.concatenate(leaves)
        order = np.argsort(flat, kind="stable")
        tree = flat[order]
        node = np.cumsum(np.concatenate([[0], tree[1:] != tree[:-1]]))
        below = np.bincount(node, weights=1.0 + twice[order])
        internal = np.empty(len(flat), dtype=bool)
        internal[order] = (below > 1)[node]
        at = 0
        for (g, _, _), n in zip(rows, sizes):
            yield (k, g, 0, np.packbits(internal[at:at + n]).tobytes(), b"")
            at += n

    key, rows = None, []
    for k, g, _, a, b in rows_sorted(batches):
        if k != key and rows:
            yield exchange_rows(list(answers(key, rows)))
            rows = []
        key = k
        rows.append((g, a, b))
    if rows:
        yield exchange_rows(list(answers(key, rows)))


def _finish(window: int, plan, names: list[str]):
    def run(batches):
        group, found = None, {}
        for k, g, kind, a, b in rows_sorted(batches):
            if g != group:
                group, found = g, {}
            if kind == 0:
                found[k] = a
                continue
            s = Suffixes(list(unpack(b)), window)
            h, keys, _, place = s.distinct(plan)
            internal = np.zeros(len(h), dtype=bool)
            for key, i, j in _runs(keys):
                internal[i:j] = np.unpackbits(np.frombuffer(found[key], np.uint8), count=j - i).astype(bool)
            deep = s.starts[internal[place]] if len(place) else s.starts
            edges = np.zeros(s.n + 1, dtype=np.int64)
            np.add.at(edges, deep, 1)
            np.add.at(edges, deep + window, -1)
            covered = np.cumsum(edges[:-1]) > 0
            ids, at, out = unpack_rows(a), 0, []
            for words in s.words:
                gone = covered[at:at + len(words)]
                at += len(words)
                turn = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                spans = [{"start": x, "end": y} for x, y in zip(turn[::2].tolist(), turn[1::2].tolist())]
                kept = [words[i] for i in np.flatnonzero(~gone).tolist()] if spans else words
                out.append((len(words), int(gone.sum()), spans, b" ".join(kept).decode("utf-8", "replace")))
            for i in range(0, len(out), 256):
                part = list(zip(*out[i:i + 256]))
                yield pa.RecordBatch.from_arrays(
                    [*ids.slice(i, len(part[0])).columns, pa.array(part[0], pa.int64()), pa.array(part[1], pa.int64()),
                     pa.array(part[2], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                     pa.array(part[3], pa.string())], names=[*names, "n_words", "n_removed", "spans", "kept"])
    return run


def remove_repeats(docs: DataFrame, text: str = "text", window: int = WINDOW, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per row of ``docs``: the columns in ``keep``, ``n_words``, ``n_removed``, ``spans``, ``kept``.

    ``spans`` are the removed runs (word offsets, end exclusive): the maximal repeats, joined where
    they overlap. ``kept`` holds the other words joined by one space. Windows are judged on the
    input. Null and short texts have no windows; a repeated row repeats all its windows; nulls in
    ``keep`` are passed on; empty input gives no rows; other columns aren't read. Two different
    windows share a 64-bit fingerprint with a chance of 2**-64 per pair of one group.
    """
    if window < max(PREFIXES):
        raise ValueError(f"window must be at least {max(PREFIXES)} words, the longest prefix")
    spark = docs.sparkSession
    tune(spark)
    names = [f"_keep{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.col(text).alias("_text"))
    plan = prefix_plan(rows.select("_text"), window, key_count(spark))
    schema = rows.drop("_text").schema.add("n_words", "long").add("n_removed", "long").add("spans", T.ArrayType(
        T.StructType().add("start", "integer").add("end", "integer"))).add("kept", "string")
    # both scans read the same columns, so that they see the same batches
    found = run_exchange(rows, _scan(window, plan), _answer, _finish(window, plan, names), schema,
                         keep=keep_texts(names, BATCH))
    return found.toDF(*keep, "n_words", "n_removed", "spans", "kept")


def op10_substring_dedup(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"), F.size("spans").alias("n_spans"))


_W = r"[^\x20\x09-\x0D]+"
ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '{_W}') AS ws FROM documents),
w AS (SELECT rid, i, md5(array_to_string(ws[i:i + {WINDOW - 1}], ' ')) AS x
      FROM (SELECT rid, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM d)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY x) AS c FROM w) WHERE c > 1),
g AS (SELECT rid, i, coalesce(i - lag(i) OVER (PARTITION BY rid ORDER BY i), {WINDOW + 1}) AS gap FROM r),
-- a run goes on while the next window starts inside or right after the last one
q AS (SELECT rid, i, sum(CASE WHEN gap > {WINDOW} THEN 1 ELSE 0 END) OVER (PARTITION BY rid ORDER BY i) AS run FROM g),
s AS (SELECT rid, min(i) AS a, max(i) + {WINDOW - 1} AS b FROM q GROUP BY rid, run),
t AS (SELECT rid, count(*) AS n_spans, CAST(sum(b - a + 1) AS BIGINT) AS n_removed, list(a) AS fs, list(b) AS ls FROM s GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(CASE WHEN n_spans IS NULL THEN array_to_string(ws, ' ') ELSE array_to_string(
         [ws[j] FOR j IN range(1, len(ws) + 1) IF len([1 FOR k IN range(1, len(fs) + 1) IF j >= fs[k] AND j <= ls[k]]) = 0], ' ') END) AS kept_sha256,
       CAST(coalesce(n_spans, 0) AS INTEGER) AS n_spans
FROM d LEFT JOIN t USING (rid)
"""
