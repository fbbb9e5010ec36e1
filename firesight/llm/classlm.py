"""Language-model scoring with a Brown class-based bigram model.

p(word | previous word) = p(class | previous class) * p(word | class). Clustering
starts from a seed: exchange on the driver over the ``WORDS`` most frequent words
and ``ENDINGS`` groups of the others, tied by their last two bytes. From there every
training word moves on its own, in rounds over all training texts: the counts of a
word's left and right neighbour classes meet at the word's key, and it goes to the
class that raises the likelihood most, given the classes of all other words. Rounds
end when nothing moves or a round adds less than ``LEAST_GAIN`` of the information
that neighbouring classes give. Unseen words have the class of their ending.

Texts are cut into words once: rounds read each batch's distinct words and its tokens' places
among them. What a round shuffled and stored goes when the next has replaced it.

Words travel as 64-bit hashes whose lowest bits name the ending. Counts and classes
of words stay distributed: a batch asks for those of its own words that aren't in
the small dictionary of very frequent ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firesight.llm.common import (EXCHANGE, by_batch, by_key, exchange_rows, in_batches, key_count, pack, pack_rows, rows_sorted, run_exchange,
                                  table, tune, unpack, unpack_rows)
from firesight.session import unique_shared_path
from firesight.sinks.keyed import delete

CLASSES, WORDS, ENDINGS, ROUNDS = 64, 1024, 64, 6
#: Words in the dictionary of counts that goes to every task, at most.
DICTIONARY = 1 << 16
#: Added to word counts (as the base score does) and to class bigrams.
DELTA, ALPHA = 0.1, 0.1
#: Rounds end when one adds less than this share of the class information.
LEAST_GAIN = 0.01
BATCH = 4 << 20
#: The end of a text is a token of its own.
END = np.uint64(0)
#: Counts are put in bins of an eighth of a power of two to find the dictionary's least count.
_BINS = 64 * 8


class Endings(dict):
    """The last two bytes of a word -> its ending; at most 65,793 entries."""

    def __missing__(self, last: bytes) -> int:
        self[last] = ending = xxhash.xxh32_intdigest(last) % ENDINGS
        return ending


_endings = Endings()


def hashes_of(words: list[bytes]) -> np.ndarray:
    """Hashes of words; the lowest bits name the word's ending."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    ending = np.fromiter([_endings[w[-2:]] for w in words], dtype=np.uint64, count=len(words))
    return ((h | np.uint64(ENDINGS)) & ~np.uint64(ENDINGS - 1)) | ending  # never END


def distinct_tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all texts' distinct tokens, in order; each token's place among them, each text closed by END;
    and the number of tokens of each text. Only distinct words are hashed."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    cut = np.asarray(lists.offsets).astype(np.int64)
    words = lists.values.slice(cut[0], cut[-1] - cut[0])
    some = np.asarray(pc.binary_length(words)) > 0  # white space at a text's start or end leaves an empty word
    sizes = np.diff(np.concatenate([[0], np.cumsum(some)])[cut - cut[0]]) + 1
    coded = (words if some.all() else words.filter(pa.array(some))).dictionary_encode()
    h = hashes_of(coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist())
    u, place = np.unique(np.append(h, END) if len(texts) else h, return_inverse=True)
    ends = np.cumsum(sizes) - 1
    word = np.ones(int(sizes.sum()), dtype=bool)
    word[ends] = False
    at = np.empty(len(word), dtype=np.int64)
    at[word] = place[np.asarray(coded.indices)]
    at[ends] = place[-1:]
    return u, at, sizes


def tokens_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' tokens, each text closed by END; and the number of tokens of each."""
    u, at, sizes = distinct_tokens(pa.array(texts, pa.binary()).view(pa.string()))
    return u[at], sizes


def _planes(x: np.ndarray) -> bytes:
    """Values of 32 bits as all their lowest bytes, then all their next ones, ...: smaller when packed."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _key(h: np.ndarray, keys: int) -> np.ndarray:
    return ((h >> np.uint64(20)) % np.uint64(keys)).astype(np.int64)


def _by_key(h: np.ndarray, keys: int):
    """(key, places) of the hashes, in order."""
    k = _key(h, keys)
    order = np.argsort(k, kind="stable")
    cut = np.flatnonzero(np.diff(k[order])) + 1
    for part in np.split(order, cut) if len(h) else []:
        yield int(k[part[0]]), part


def _sum_by(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key = np.concatenate(keys)
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    n = np.concatenate(counts).astype(np.int64)[order]
    return key[first], np.add.reduceat(n, first) if len(n) else n


def _by_group(batches):
    """(k, rows) of a partition sorted by k."""
    key, rows = None, []
    for row in rows_sorted(batches):
        if row[0] != key and rows:
            yield key, rows
            rows = []
        key = row[0]
        rows.append(row)
    if rows:
        yield key, rows


def _bin(counts: np.ndarray) -> np.ndarray:
    return np.minimum(_BINS - 1, (np.log2(counts) * 8).astype(np.int64))


class Scratch:
    """Tables of one run in the shared folder, deleted as soon as nothing reads them any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def written(self, df: DataFrame, name: str) -> DataFrame:
        path = unique_shared_path(self.spark, name)
        # rows hold up to some MB each: few of them in a row group
        df.write.option("parquet.block.size", 16 << 20).option("parquet.block.size.row.check.min", 4).parquet(path)
        rows = self.spark.read.schema(df.schema).parquet(path)
        self.paths.append((rows, path))
        return rows

    def drop(self, *tables: DataFrame) -> None:
        for _, path in [x for x in self.paths if any(x[0] is t for t in tables)]:
            delete(self.spark, path)
        self.paths = [x for x in self.paths if not any(x[0] is t for t in tables)]


@contextmanager
def shuffles_cleared(spark: SparkSession) -> Iterator[None]:
    """Every job's shuffle files go when it has ended, instead of when the driver collects its garbage: for jobs
    whose results are written or collected and whose frames aren't used again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def tokenized(train: DataFrame, keys: int) -> DataFrame:
    """Per batch of texts: its distinct words in the order of (key, hash), and each token's place among them."""
    def scan(batches):
        for g, batch in in_batches(batches, "_text", BATCH):
            u, at, _ = distinct_tokens(batch.column("_text"))
            order = np.argsort(_key(u, keys), kind="stable")
            rank = np.empty(len(u), dtype="<u4")
            rank[order] = np.arange(len(u))
            yield exchange_rows([(g % keys, g, 2, pack([u[order].tobytes()]), pack([_planes(rank[at])]))])

    return train.withColumn("_part", F.spark_partition_id()).mapInArrow(scan, EXCHANGE)


def _tokens(train: DataFrame, keys: int) -> DataFrame:
    """``train`` as ``tokenized`` gives it, whether it holds texts or has been through it."""
    return tokenized(train, keys) if "_text" in train.columns else train


def _words_at(a: bytes, b: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words and the tokens' places of a row of ``tokenized``."""
    return np.frombuffer(next(unpack(a)), np.uint64), _from_planes(next(unpack(b)))


def count_words(train: DataFrame, keys: int) -> DataFrame:
    """The vocabulary: per key, kind 0 has hashes and counts, kind 1 has totals per ending and a histogram."""
    def scan(batches):
        for _, g, _, a, b in rows_sorted(batches):
            u, at = _words_at(a, b)
            n = np.bincount(at, minlength=len(u))
            yield exchange_rows([(k, g, 0, u[p].tobytes(), n[p].astype("<u4").tobytes()) for k, p in _by_key(u, keys)])

    def total(batches):
        for k, rows in _by_group(batches):
            u, n = _sum_by([np.frombuffer(a, np.uint64) for *_, a, _ in rows], [np.frombuffer(b, "<u4") for *_, b in rows])
            ending = (u % np.uint64(ENDINGS)).astype(np.int64)
            word = u != END
            sums = np.concatenate([np.bincount(ending[word], minlength=ENDINGS),
                                   np.bincount(ending[word], weights=n[word], minlength=ENDINGS).astype(np.int64),
                                   [n[~word].sum()]])
            yield exchange_rows([(k, 0, 0, u.tobytes(), n.astype("<i8").tobytes()),
                                 (k, 0, 1, sums.astype("<i8").tobytes(),
                                  np.bincount(_bin(n), minlength=_BINS).astype("<i8").tobytes())])

    counted = by_key(_tokens(train, keys).mapInArrow(scan, EXCHANGE))
    return counted.sortWithinPartitions("k").mapInArrow(total, EXCHANGE)


class Vocabulary:
    """Totals and the dictionary of the most frequent words; all of a bounded size."""

    def __init__(self, vocab: DataFrame, dictionary: int = DICTIONARY):
        sums, bins = np.zeros(2 * ENDINGS + 1, np.int64), np.zeros(_BINS, np.int64)
        for r in vocab.filter("kind = 1").select("a", "b").toLocalIterator():
            sums += np.frombuffer(r.a, "<i8")
            bins += np.frombuffer(r.b, "<i8")
        self.v_ending, self.n_ending, self.ends = sums[:ENDINGS], sums[ENDINGS:-1], int(sums[-1])
        self.n = int(self.n_ending.sum()) + self.ends
        self.v = int(self.v_ending.sum()) + (self.ends > 0)
        above = np.cumsum(bins[::-1])[::-1]
        few = np.flatnonzero(above <= dictionary)
        least = int(few[0]) if len(few) else _BINS

        def frequent(batches):
            for batch in batches:
                for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                    u, n = np.frombuffer(a, np.uint64), np.frombuffer(b, "<i8")
                    some = _bin(n) >= least
                    yield pa.RecordBatch.from_arrays([pa.array(u[some].view(np.int64)), pa.array(n[some])], names=["h", "n"])

        got = vocab.filter("kind = 0").select("a", "b").mapInArrow(frequent, "h long, n long").toArrow()
        h = got.column("h").to_numpy().view(np.uint64)
        order = np.argsort(h)
        self.hashes, self.counts = h[order], got.column("n").to_numpy()[order]

    def movable(self, words: int = WORDS) -> np.ndarray:
        """Hashes of the words that get a class of their own, most frequent first."""
        own = self.hashes != END
        h, n = self.hashes[own], self.counts[own]
        return h[np.lexsort((h, -n))][:words]

    def look_up(self, h: np.ndarray) -> np.ndarray:
        """Counts of hashes in the dictionary, -1 elsewhere."""
        if not len(self.hashes):
            return np.full(len(h), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.counts[at], -1)


class Units:
    """What moves in the clustering: END (0), the endings, then single words."""

    def __init__(self, words: np.ndarray):
        self.first = 1 + ENDINGS
        order = np.argsort(words)
        self.sorted, self.place = words[order], order
        self.n = self.first + len(words)

    def of(self, h: np.ndarray) -> np.ndarray:
        unit = 1 + (h % np.uint64(ENDINGS)).astype(np.int64)
        if len(self.sorted):
            at = np.minimum(np.searchsorted(self.sorted, h), len(self.sorted) - 1)
            unit = np.where(self.sorted[at] == h, self.first + self.place[at], unit)
        return np.where(h == END, 0, unit)


def _pairs(unit: np.ndarray) -> np.ndarray:
    """The unit before each token; the first token of a text follows END, as any text's last token is END."""
    return np.concatenate([np.zeros(1, unit.dtype), unit[:-1]]) if len(unit) else unit


def count_bigrams(train: DataFrame, units: Units, keys: int) -> np.ndarray:
    """units x units counts over all training texts; a table of fixed size."""
    def scan(batches):
        for _, g, _, a, b in rows_sorted(batches):
            u, at = _words_at(a, b)
            unit = units.of(u).astype(np.uint32)[at]  # their pairs are at most as many as the table's cells
            code, n = np.unique(_pairs(unit) * units.n + unit, return_counts=True)
            k = code % keys
            order = np.argsort(k, kind="stable")
            cut = np.flatnonzero(np.diff(k[order])) + 1
            yield exchange_rows([(int(k[p[0]]), g, 0, pack([np.diff(code[p], prepend=0).astype("<u4").tobytes()]),
                                  pack([n[p].astype("<u4").tobytes()])) for p in (np.split(order, cut) if len(code) else [])])

    def total(batches):
        for _, rows in _by_group(batches):
            codes = [np.cumsum(np.frombuffer(next(unpack(a)), "<u4").astype(np.int64)) for *_, a, _ in rows]
            u, n = _sum_by(codes, [np.frombuffer(next(unpack(b)), "<u4") for *_, b in rows])
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(n)], names=["code", "n"])

    counted = by_key(_tokens(train, keys).mapInArrow(scan, EXCHANGE))
    got = counted.sortWithinPartitions("k").mapInArrow(total, "code long, n long").toArrow()
    flat = np.zeros(units.n * units.n, dtype=np.int64)
    flat[got.column("code").to_numpy()] = got.column("n").to_numpy()
    return flat.reshape(units.n, units.n)


def _xlogx(x):
    return x * np.log(np.maximum(x, 1e-300))


def exchange(bigrams: np.ndarray, classes: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """The class of every unit. Unit 0 (END) is class 0 by itself; the others move among classes 1 and up.

    A unit is taken out of its class and put where the likelihood of the class bigrams is
    highest; rounds end when nothing moves.
    """
    n = len(bigrams)
    b = bigrams.astype(float)
    weight = b.sum(axis=0)
    order = 1 + np.argsort(-weight[1:], kind="stable")
    of = np.zeros(n, dtype=np.int64)
    of[order] = 1 + np.arange(n - 1) % max(1, classes - 1)
    member = np.eye(classes)[of]
    m = member.T @ b @ member
    for _ in range(rounds):
        moved = 0
        for w in order.tolist():
            old = of[w]
            right = np.bincount(of, weights=b[w], minlength=classes)
            left = np.bincount(of, weights=b[:, w], minlength=classes)
            itself = b[w, w]
            right[old] -= itself
            left[old] -= itself
            m[old] -= right
            m[:, old] -= left
            m[old, old] -= itself
            before = _xlogx(m)
            rows, cols = _xlogx(m + right) - before, _xlogx(m + left[:, None]) - before
            own = np.diag(m)
            gain = rows.sum(axis=1) - np.diag(rows) + cols.sum(axis=0) - np.diag(cols) \
                + _xlogx(own + right + left + itself) - _xlogx(own)
            out, come = m.sum(axis=1), m.sum(axis=0)
            gain -= _xlogx(out + right.sum() + left * 0 + itself) - _xlogx(out)
            gain -= _xlogx(come + left.sum() + itself) - _xlogx(come)
            gain[0] = -np.inf
            new = old if gain[old] >= gain.max() - 1e-9 else int(np.argmax(gain))
            of[w] = new
            m[new] += right
            m[:, new] += left
            m[new, new] += itself
            moved += new != old
        if not moved:
            break
    return of


def _values(a: bytes, b: bytes):
    """Hashes, counts and classes of a row of the class table."""
    u = np.frombuffer(a, np.uint64)
    return u, np.frombuffer(b, "<i8", len(u)), np.frombuffer(b, np.uint8, offset=8 * len(u))


def _class_rows(k: int, u: np.ndarray, n: np.ndarray, cls: np.ndarray, moved: np.ndarray) -> list[tuple]:
    """A key's classes (kind 0), and its tokens, distinct and moved words per class (kind 1)."""
    sums = [np.bincount(cls, weights=n, minlength=CLASSES), np.bincount(cls, minlength=CLASSES),
            np.bincount(cls[moved], minlength=CLASSES)]
    return [(k, 0, 0, u.tobytes(), n.astype("<i8").tobytes() + cls.astype(np.uint8).tobytes()),
            (k, 0, 1, np.concatenate(sums).astype("<i8").tobytes(), b"")]


def first_classes(vocab: DataFrame, units: Units, of: np.ndarray) -> DataFrame:
    """Every word in the class of its unit."""
    def run(batches):
        for k, _, _, a, b in rows_sorted(batches):
            u = np.frombuffer(a, np.uint64)
            yield exchange_rows(_class_rows(k, u, np.frombuffer(b, "<i8"), of[units.of(u)], np.zeros(len(u), bool)))

    return vocab.filter("kind = 0").mapInArrow(run, EXCHANGE)


class Classes:
    """What a task needs to know of the classes: sums per class, and the classes of the dictionary's words."""

    def __init__(self, rows: DataFrame, vocab: Vocabulary, unseen: np.ndarray):
        self.rows, self.unseen = rows, unseen
        sums = np.zeros(3 * CLASSES, np.int64)
        for r in rows.filter("kind = 1").select("a").toLocalIterator():
            sums += np.frombuffer(r.a, "<i8")
        self.n, self.v, moved = sums.reshape(3, CLASSES)
        self.moved = int(moved.sum())
        hashes = vocab.hashes

        def known(batches):
            for _, _, _, a, b in rows_sorted(batches):
                u, _, cls = _values(a, b)
                some = np.isin(u, hashes)
                yield pa.RecordBatch.from_arrays([pa.array(u[some].view(np.int64)), pa.array(cls[some].astype(np.int32))],
                                                 names=["h", "c"])

        got = rows.filter("kind = 0").mapInArrow(known, "h long, c int").toArrow()
        order = np.argsort(got.column("h").to_numpy().view(np.uint64))
        self.known = got.column("c").to_numpy()[order].astype(np.uint8)


def _place(hashes: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Places of ``h`` in sorted ``hashes``, -1 elsewhere."""
    if not len(hashes):
        return np.full(len(h), -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
    return np.where(hashes[at] == h, at, -1)


def neighbour_counts(train: DataFrame, classes: Classes, vocab: Vocabulary, keys: int) -> DataFrame:
    """Per key, kind 1: words and counts of their neighbours' classes, as steps from code to code; kind 2: bigrams of
    classes. All of them pre-aggregated per batch."""
    hashes, known = vocab.hashes, classes.known
    tokens = _tokens(train, keys)

    def ask(batches):
        for _, g, _, a, _ in rows_sorted(batches):
            u = np.frombuffer(next(unpack(a)), np.uint64)
            rare = u[_place(hashes, u) < 0]
            yield exchange_rows([(k, g, 1, rare[p].tobytes(), b"") for k, p in _by_key(rare, keys)])

    def finish(batches):
        group, answers = None, []
        for _, g, kind, a, b in rows_sorted(batches):
            if g != group:
                group, answers = g, []
            if kind == 1:
                answers.append(np.frombuffer(next(unpack(a)), np.uint8))
                continue
            u, at = _words_at(a, b)
            place = _place(hashes, u)
            cls = np.zeros(len(u), np.uint8)
            cls[place >= 0] = known[place[place >= 0]]
            if (place < 0).any():
                cls[place < 0] = np.concatenate(answers)
            # narrow codes sort faster
            at = at.astype(np.uint32 if len(u) * 2 * CLASSES < 1 << 32 else np.int64)
            token = cls.astype(at.dtype)[at]
            before, after = _pairs(token), np.append(token[1:], np.zeros(1, token.dtype))
            word = u[at] != END
            code, n = np.unique(np.concatenate([at[word] * (2 * CLASSES) + before[word],
                                                at[word] * (2 * CLASSES) + CLASSES + after[word]]), return_counts=True)
            code = code.astype(np.int64)
            rows, lo = [], 0
            for k, p in _by_key(u, keys):  # p is a run of words, as words are in the order of their keys
                hi = lo + int(np.searchsorted(code[lo:], (int(p[-1]) + 1) * 2 * CLASSES))
                step = np.diff(code[lo:hi], prepend=int(p[0]) * 2 * CLASSES)
                rows.append((k, g, 1, u[p].tobytes(), pack([_planes(step), _planes(n[lo:hi])])))
                lo = hi
            m = np.bincount(before * CLASSES + token, minlength=CLASSES * CLASSES)
            yield exchange_rows([*rows, (g % keys, g, 2, m.astype("<i8").tobytes(), b"")])

    asked = tokens.select("k", "g", "kind", "a", F.lit(b"").alias("b")).mapInArrow(ask, EXCHANGE)
    asked = by_key(asked.unionByName(classes.rows.filter("kind = 0"))).sortWithinPartitions("k", "kind", "g")
    answered = asked.mapInArrow(_answer(classes.unseen, counts=False), EXCHANGE).unionByName(tokens)
    return by_batch(answered).sortWithinPartitions("g", "kind", "k").mapInArrow(finish, EXCHANGE)


def class_bigrams(counts: DataFrame) -> np.ndarray:
    """classes x classes counts over all training texts."""
    def run(batches):
        m = np.zeros(CLASSES * CLASSES, np.int64)
        for batch in batches:
            for a in batch.column("a").to_pylist():
                m += np.frombuffer(a, "<i8")
        yield pa.RecordBatch.from_arrays([pa.array([m.tobytes()], pa.binary())], names=["a"])

    m = np.zeros(CLASSES * CLASSES, np.int64)
    for r in counts.filter("kind = 2").select("a").mapInArrow(run, "a binary").toLocalIterator():
        m += np.frombuffer(r.a, "<i8")
    return m.reshape(CLASSES, CLASSES)


def information(m: np.ndarray) -> float:
    """What a token's class tells of the next token's class, in nats per token."""
    n = float(m.sum())
    f = _xlogx
    return (f(m.astype(float)).sum() - f(m.sum(axis=0).astype(float)).sum() - f(m.sum(axis=1).astype(float)).sum()
            + f(n)) / n if n else 0.0


def move(counts: DataFrame, rows: DataFrame, m: np.ndarray) -> DataFrame:
    """The class table after every word went to its best class, given all other words' classes."""
    p = m + ALPHA
    gain = np.log(p * p.sum() / (p.sum(axis=1, keepdims=True) * p.sum(axis=0)))
    by_code = np.concatenate([gain, gain.T])  # what each class gains by a left, a right neighbour of each class
    by_code[:, 0] = -np.inf  # END's own

    def run(batches):
        for k, group in _by_group(batches):
            _, _, _, a, b = next(r for r in group if r[2] == 0)
            u, n, cls = _values(a, b)
            codes, weights = [], []
            for _, _, kind, a, b in group:
                if kind == 1:
                    step, c = map(_from_planes, unpack(b))
                    code = np.cumsum(step.astype(np.int64))
                    there = np.searchsorted(u, np.frombuffer(a, np.uint64))
                    codes.append(there[code // (2 * CLASSES)] * 2 * CLASSES + code % (2 * CLASSES))
                    weights.append(c)
            new = cls.astype(np.int64)
            if codes:
                code, c = _sum_by(codes, weights)
                word = code // (2 * CLASSES)
                starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(word) else np.zeros(0, np.int64)
                for i in range(0, len(starts), 4096):
                    lo, hi = starts[i], (starts[i + 4096] if i + 4096 < len(starts) else len(code))
                    score = np.add.reduceat(c[lo:hi, None] * by_code[code[lo:hi] % (2 * CLASSES)], starts[i:i + 4096] - lo, axis=0)
                    w = word[starts[i:i + 4096]]
                    best = np.argmax(score, axis=1)
                    row = np.arange(len(w))
                    new[w] = np.where(score[row, new[w]] >= score[row, best] - 1e-9, new[w], best)
            yield exchange_rows(_class_rows(k, u, n, new, new != cls))

    asked = counts.filter("kind = 1").unionByName(rows.filter("kind = 0"))
    return by_key(asked).sortWithinPartitions("k").mapInArrow(run, EXCHANGE)


class Model:
    """Everything a task needs to score: bounded by ENDINGS, CLASSES and DICTIONARY. Other words' counts and
    classes are asked for."""

    def __init__(self, vocab: Vocabulary, classes: Classes, m: np.ndarray):
        self.vocab, self.unseen = vocab, classes.unseen
        between = m + ALPHA
        self.step = np.log10(between / between.sum(axis=1, keepdims=True))
        self.spread_class = np.log10(classes.n + DELTA * (classes.v + 1))
        # END, the endings (for unseen words), then the dictionary's words
        word = vocab.hashes != END
        self.units = Units(vocab.hashes[word])
        self.of = np.concatenate([[0], classes.unseen, classes.known[word]]).astype(np.int64)
        self.spread = self.spread_class[self.of]
        self.base = np.log10(vocab.n + DELTA * (vocab.v + 1))


def fit(train: DataFrame, vocab: DataFrame, keys: int, words: int = WORDS) -> Model:
    return train_classes(train, vocab, keys, words)[0]


def train_classes(train: DataFrame, vocab: DataFrame, keys: int, words: int = WORDS) -> tuple[Model, DataFrame]:
    """The model and the class table, which has every training word."""
    scratch = Scratch(train.sparkSession)
    with shuffles_cleared(train.sparkSession):
        tokens = train if "_text" not in train.columns else scratch.written(tokenized(train, keys), "lm-tokens")
        v = Vocabulary(vocab, DICTIONARY)
        seed = Units(v.movable(words))
        of = exchange(count_bigrams(tokens, seed, keys))
        unseen = of[1:seed.first].astype(np.uint8)

        def state(rows):
            classes = Classes(rows, v, unseen)
            counts = scratch.written(neighbour_counts(tokens, classes, v, keys), "lm-neighbours")
            return classes, counts, class_bigrams(counts)

        classes, counts, m = state(scratch.written(first_classes(vocab, seed, of), "lm-classes"))
        while m.any():
            moved = scratch.written(move(counts, classes.rows, m), "lm-classes")
            scratch.drop(counts)  # before the next ones are counted; if those are no better, no round follows
            new, counts, new_m = state(moved)
            before, after = information(m), information(new_m)
            if after <= before:
                scratch.drop(new.rows)
                break
            scratch.drop(classes.rows)
            classes, m = new, new_m
            if not new.moved or after - before < LEAST_GAIN * before:
                break
        scratch.drop(counts, tokens)
    return Model(v, classes, m), classes.rows


def _scan(model: Model, keys: int, names: list[str]):
    def run(batches):
        for g, batch in in_batches(batches, "_text", BATCH):
            words, at, sizes = distinct_tokens(batch.column("_text"))
            starts = np.cumsum(sizes) - sizes
            cls = model.of[model.units.of(words)].astype(np.uint8)[at]  # of rare words: replaced by the answer
            count = model.vocab.look_up(words)
            rare = count < 0
            local = np.where(rare, 0.0, np.log10(np.maximum(count, 0) + DELTA))[at]
            u, asks = words[rare], rare[at]
            per_doc = np.add.reduceat(asks, starts, dtype=np.int64) if len(sizes) else np.zeros(0)
            logs = np.add.reduceat(local, starts).astype("<f8").tobytes() if len(sizes) else b""
            # asked words are numbered in the order of (key, hash)
            asked, place, n = [], np.empty(len(u), dtype="<u4"), 0
            for k, p in _by_key(u, keys):
                asked.append((k, g, 1, u[p].tobytes(), b""))
                place[p] = np.arange(n, n + len(p))
                n += len(p)
            among = (np.cumsum(rare) - 1)[at[asks]]
            own = pack([sizes.astype("<i8").tobytes(), cls.tobytes(), np.packbits(asks).tobytes(), logs,
                        per_doc.astype("<i8").tobytes(), _planes(place[among])])
            yield exchange_rows([*asked, (g % keys, g, 2, pack_rows(batch, names), own)])
    return run


def _answer(unseen: np.ndarray, counts: bool = True):
    """Classes, and counts if wanted, from the rows of a key (kind 0) for the words that batches ask for (kind 1)."""
    def run(batches):
        key, u, n, cls = None, np.zeros(0, np.uint64), None, None
        for k, g, kind, a, b in rows_sorted(batches):
            if k != key:
                key, u = k, np.zeros(0, np.uint64)
            if kind == 0:
                u, n, cls = _values(a, b)
                continue
            if kind == 1:
                h = np.frombuffer(a, np.uint64)
                c, of = np.zeros(len(h), np.int64), unseen[(h % np.uint64(ENDINGS)).astype(np.int64)]
                at = _place(u, h)
                have = at >= 0
                if have.any():
                    c[have], of[have] = n[at[have]], cls[at[have]]
                a, b = pack([of.tobytes(), *([c.astype("<i8").tobytes()] if counts else [])]), b""
            yield exchange_rows([(k, g, kind, a, b)])
    return run


def _finish(model: Model, names: list[str]):
    def run(batches):
        group, counts, classes = None, [], []
        for _, g, kind, a, b in rows_sorted(batches):  # by key within a batch, as asked
            if g != group:
                group, counts, classes = g, [], []
            if kind == 1:
                of, c = unpack(a)
                counts.append(np.frombuffer(c, "<i8"))
                classes.append(np.frombuffer(of, np.uint8))
                continue
            *own, place = unpack(b)
            sizes, cls, asked, local, rare = (np.frombuffer(x, t) for x, t in zip(own, ("<i8", np.uint8, np.uint8, "<f8", "<i8")))
            place = _from_planes(place)
            cls = cls.astype(np.int64)
            found = np.concatenate(counts)[place] if len(place) else np.zeros(0, np.int64)
            if len(place):
                cls[np.unpackbits(asked, count=len(cls)).astype(bool)] = np.concatenate(classes)[place]
            steps = model.step[_pairs(cls), cls] - model.spread_class[cls]
            path = np.add.reduceat(steps, np.cumsum(sizes) - sizes) if len(sizes) else np.zeros(0)
            doc = np.repeat(np.arange(len(sizes)), rare)
            logs = local + np.bincount(doc, weights=np.log10(found + DELTA), minlength=len(sizes))
            unknown = np.bincount(doc, weights=found == 0, minlength=len(sizes)).astype(np.int64)
            score = logs + path
            yield pa.RecordBatch.from_arrays(
                [*unpack_rows(a).columns, pa.array(sizes), pa.array(sizes - unknown),
                 pa.array(np.full(len(sizes), model.vocab.n, np.int64)), pa.array(logs - sizes * model.base), pa.array(score),
                 pa.array(10.0 ** np.minimum(300.0, -score / sizes))],
                names=[*names, "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])
    return run


def lm_scores(docs: DataFrame, held_out, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per row of ``docs``: the columns in ``keep``, ``held_out``, token counts, log10 scores, ``perplexity``.

    Rows for which ``held_out`` (a boolean column; null counts as true) is false train the model;
    all rows are scored. Null text is empty and has the one token END. Without training rows all
    words are unknown. Repeated rows train and are scored as often as they stand; nulls in ``keep``
    are passed on; empty input gives no rows; other columns aren't read.
    """
    spark = docs.sparkSession
    tune(spark)
    keys = key_count(spark)
    names = [f"_keep{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)],
                       F.coalesce(held_out, F.lit(True)).alias("_held"), F.col(text).alias("_text"))
    train = rows.filter(~F.col("_held")).select("_text")
    scratch = Scratch(spark)
    with shuffles_cleared(spark):
        tokens = scratch.written(tokenized(train, keys), "lm-tokens")
        vocab = scratch.written(count_words(tokens, keys), "lm-vocabulary")
    model, classes = train_classes(tokens, vocab, keys)
    scratch.drop(tokens, vocab)
    names = [*names, "_held"]
    schema = rows.drop("_text").schema
    for c, t in (("n_tokens", "long"), ("n_known", "long"), ("train_tokens", "long"), ("base_score", "double"),
                 ("score", "double"), ("perplexity", "double")):
        schema = schema.add(c, t)
    found = run_exchange(rows, _scan(model, keys, names), _answer(model.unseen), _finish(model, names), schema,
                         extra=classes.filter("kind = 0"))
    return found.toDF(*keep, "held_out", *schema.names[len(names):])


def op7_class_lm(spark, sf_dir):
    held = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    return lm_scores(table(spark, sf_dir, "documents"), held)
