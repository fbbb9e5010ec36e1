"""Toxicity and class-based LM scoring: exact parts against plain versions, models by held-out accuracy."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from firesight.llm import classlm, toxicity
from tests.llm.conftest import SMALL, words

MEDIUM = "/root/testdata/sf0.1"


def test_block_max_search_is_exact():
    rng = np.random.default_rng(1)
    vectors = []
    for _ in range(500):
        at = np.sort(rng.choice(60, size=rng.integers(1, 12), replace=False))
        w = rng.random(len(at))
        vectors.append((at, w / np.linalg.norm(w)))
    vectors += vectors[:40]  # ties
    index = toxicity.BlockMaxIndex(vectors, 60, block=16)
    dense = np.zeros((len(vectors), 60))
    for i, (at, w) in enumerate(vectors):
        dense[i, at] = w
    for at, w in vectors[::7]:
        cos = np.round(dense[:, at] @ w, 12)
        want = [i for i in np.lexsort((np.arange(len(cos)), -cos)) if cos[i] > 0][:16]
        top, got = index.nearest(at, w, 16)
        assert top.tolist() == want and np.allclose(got, cos[want])


def test_monotone_fit():
    at, rate = toxicity.monotone(np.array([0.1, 0.2, 0.2, 0.5, 0.9]), np.array([0, 1, 0, 0, 1]), 0.2)
    assert (np.diff(at) > 0).all() and (np.diff(rate) >= 0).all()


def test_toxicity_held_out_accuracy(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    rows = toxicity.op4_toxicity(spark, MEDIUM).collect()
    assert len(rows) == spark.read.parquet(f"{MEDIUM}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(labels[r.doc_id], r.predicted, r.score) for r in rows if r.held_out and r.doc_id in labels]
    caught = [p for y, p, _ in held if y == 1]
    wrong = [p for y, p, _ in held if y == 0]
    assert sum(caught) / len(caught) > 0.9
    assert sum(wrong) / len(wrong) < 0.02
    sure = [y for y, _, s in held if s > 0.6]
    assert sum(sure) / len(sure) > 0.85  # calibrated


def test_toxicity_learns_nothing_from_held_out_rows_or_other_columns(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = docs.withColumns({"lang": F.lit("zz"), "source": F.lit("s"), "n_chars": F.lit(0)})
    a = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    b = {r.doc_id: r.score for r in toxicity.score(other, toxicity.fit(other, flipped)).collect()}
    assert a == b


def test_toxicity_on_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)] + [(None, 1), (3, None), (3, 0)], "doc_id long, toxic int")
    for y in (labels, labels.limit(0)):
        model = toxicity.fit(odd_docs, y)
        rows = toxicity.score(odd_docs, model).collect()
        assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert toxicity.score(no_docs, model).collect() == []
        assert toxicity.accepted(odd_docs, model).columns == odd_docs.columns
    assert toxicity.fit(no_docs, labels).index.n == 0


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), "\n"]


def check_lm(rows, docs, held):
    train = [tokens(d.text) for d in docs if not held(d)]
    count = Counter(t for d in train for t in d)
    n, v = sum(count.values()), len(count)
    left = {}
    for d in docs:
        left.setdefault((d.doc_id, d.text), []).append(d)
    want = []
    for d in docs:
        t = tokens(d.text)
        base = sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        want.append((str(d.doc_id), held(d), len(t), sum(count[w] > 0 for w in t), n, round(base, 6)))
    got = [(str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows]
    assert sorted(got) == sorted(want)
    assert all(r.score < 0 and math.isfinite(r.score) and r.perplexity >= 1 for r in rows)


def held_row(d):
    return d.doc_id is None or zlib.crc32(str(d.doc_id).encode()) % 10 == 0


def test_lm_scores_against_plain_counts(spark, odd_docs, no_docs, monkeypatch):
    held = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    rows = classlm.op7_class_lm(spark, SMALL).collect()
    check_lm(rows, docs, held_row)
    # few words in the dictionary, many small batches: the rest is asked for
    monkeypatch.setattr(classlm, "DICTIONARY", 5)
    monkeypatch.setattr(classlm, "BATCH", 2000)
    check_lm(classlm.lm_scores(odd_docs, held).collect(), odd_docs.collect(), held_row)
    assert classlm.lm_scores(no_docs, held).collect() == []
    none = classlm.lm_scores(odd_docs, F.lit(True)).collect()
    assert len(none) == odd_docs.count() and {r.train_tokens for r in none} == {0}


def test_class_model_beats_unigrams_on_held_out_text(spark):
    rows = [r for r in classlm.op7_class_lm(spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def likelihood(b, of, classes):
    m = np.zeros((classes, classes))
    np.add.at(m, (of[:, None], of[None, :]), b)
    f = classlm._xlogx
    return f(m).sum() - f(m.sum(axis=0)).sum() - f(m.sum(axis=1)).sum()


def test_exchange_finds_hidden_classes_and_never_loses_likelihood():
    rng = np.random.default_rng(2)
    n, classes = 61, 5
    hidden = np.concatenate([[0], 1 + np.arange(n - 1) % 4])
    follow = np.array([[0, 1, 0, 0, 0], [0, 0, 1, 0, 0], [0, 0, 0, 1, 0], [0, 0, 0, 0, 1], [1, 0, 0, 0, 0]], dtype=float)
    b = rng.poisson(30 * follow[hidden][:, hidden] + 0.05).astype(float)
    start = np.zeros(n, dtype=np.int64)
    order = 1 + np.argsort(-b.sum(axis=0)[1:], kind="stable")
    start[order] = 1 + np.arange(n - 1) % (classes - 1)
    of = classlm.exchange(b, classes, rounds=20)
    assert likelihood(b, of, classes) >= likelihood(b, start, classes)
    for c in range(1, 5):
        assert len(set(of[hidden == c].tolist())) == 1


def test_class_model_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame([(" ".join(random.Random(i).choice("abcdefgh") for _ in range(30)),) for i in range(40)], "_text string")
    keys = classlm.key_count(spark)
    from firesight.llm.common import written
    model = classlm.fit(docs, written(classlm.count_words(docs, keys), "test-vocabulary"), keys, words=3)
    assert np.allclose((10 ** model.step).sum(axis=1), 1)
    v = model.vocab
    emit = {}
    for h, c in zip(v.hashes, v.counts):
        u = int(model.units.of(np.array([h]))[0])
        k = int(model.of[u])
        emit[k] = emit.get(k, 0) + (c + classlm.DELTA) / 10 ** model.spread[u]
    # what is left of each class's mass is one unseen word's
    for k, total in emit.items():
        u = int(np.flatnonzero(model.of == k)[0])
        assert math.isclose(total + classlm.DELTA / 10 ** model.spread[u], 1, rel_tol=1e-9)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_tokens_end_each_text(n):
    h, sizes = classlm.tokens_of([words(random.Random(i), i).encode() for i in range(n)])
    assert sizes.tolist() == [i + 1 for i in range(n)] and (h == classlm.END).sum() == n


def test_every_word_has_a_class_of_its_own(spark, monkeypatch):
    """Rare words that end alike, and stand in other places, go to the classes of the frequent words in those places."""
    monkeypatch.setattr(classlm, "DICTIONARY", 20)
    rng = random.Random(4)
    rare = [f"rare{i}xx" for i in range(60)]
    texts = []
    for i in range(600):
        noun = rng.choice(["cat", "dog"]) if i % 3 else rare[rng.randrange(0, 60, 2)]
        verb = rng.choice(["ran", "sat"]) if i % 5 else rare[rng.randrange(1, 60, 2)]
        texts.append((f"the {noun} {verb} here",))
    docs = spark.createDataFrame(texts, "_text string")
    keys = classlm.key_count(spark)
    from firesight.llm.common import written
    _, rows = classlm.train_classes(docs, written(classlm.count_words(docs, keys), "test-vocabulary"), keys, words=6)
    cls = {}
    for r in rows.filter("kind = 0").collect():
        u, _, c = classlm._values(bytes(r.a), bytes(r.b))
        cls.update(zip(u.tolist(), c.tolist()))
    of = {w: cls[int(classlm.tokens_of([w.encode()])[0][0])] for t in texts for w in t[0].split()}
    assert len({of[w] for w in rare[0::2] if w in of} | {of["cat"], of["dog"]}) <= 2
    nouns, verbs = {of[w] for w in rare[0::2] if w in of}, {of[w] for w in rare[1::2] if w in of}
    assert not nouns & verbs


def test_lm_training_cuts_texts_once_and_leaves_the_classes_only(spark, monkeypatch, tmp_path):
    seen = []
    monkeypatch.setattr(classlm, "unique_shared_path", lambda s, name: (seen.append(name), f"{tmp_path}/{name}-{len(seen)}")[1])
    docs = spark.createDataFrame([(i, f"one two w{i} three one w{i % 3} two") for i in range(40)], "doc_id long, text string")
    got = classlm.lm_scores(docs, F.col("doc_id") % 10 == 0)
    assert seen.count("lm-tokens") == 1 and [p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()] == ["lm-classes"]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert got.count() == got.count() == 40


def test_lm_rounds_drop_neighbour_counts_before_the_next_ones(spark, monkeypatch, tmp_path):
    """At most one table of neighbour counts, the largest of a round's tables, is stored at a time."""
    beside, n = [], iter(range(1000))

    def path(_, name):
        if name == "lm-neighbours":
            beside.append(len(list(tmp_path.glob("lm-neighbours-*"))))
        return f"{tmp_path}/{name}-{next(n)}"

    monkeypatch.setattr(classlm, "unique_shared_path", path)
    docs = spark.createDataFrame([(i, f"one two w{i} three one w{i % 3} two") for i in range(40)], "doc_id long, text string")
    classlm.lm_scores(docs, F.col("doc_id") % 10 == 0)
    assert len(beside) > 1 and set(beside) == {0}


def test_lm_hashes_a_batch_s_distinct_words_only(monkeypatch):
    asked, hashes_of = [], classlm.hashes_of
    monkeypatch.setattr(classlm, "hashes_of", lambda words: (asked.extend(words), hashes_of(words))[1])
    h, sizes = classlm.tokens_of([b"a b a b", b"", b"B a"] * 50)
    assert sorted(asked) == [b"a", b"b"] and sizes.tolist() == [5, 1, 3] * 50 and len(set(h.tolist())) == 3


def test_word_hashes_hold_their_ending():
    found = [b"a", b"going", b"being", "été".encode(), b"x" * 5000]
    h = classlm.hashes_of(found).tolist()
    assert h == [((xxhash.xxh3_64_intdigest(w) | 64) & ~63) | xxhash.xxh32_intdigest(w[-2:]) % 64 for w in found]
    assert h[1] % 64 == h[2] % 64 and classlm.hashes_of([]).tolist() == []


def test_distinct_tokens_are_those_of_plain_splitting():
    texts = [None, "", "  \t", " A  b\x0bC\x0c", "tail \x1c\x85\xa0x 　y", "ÄÖ äö İ", "a\x00b a", "same same", "\n😀\r\nx " * 9]
    raw = [t.encode() if t is not None else None for t in texts] + [b"\xff bad\xc3 \xe3\x81 A\xff", b"a"]
    column = pa.array([b"left out", *raw], pa.binary()).view(pa.string()).slice(1)
    u, at, sizes = classlm.distinct_tokens(column)
    want = [[*classlm.hashes_of((t or b"").lower().split()).tolist(), 0] for t in raw]
    assert u[at].tolist() == [h for t in want for h in t] and sizes.tolist() == [len(t) for t in want]
    assert u.tolist() == sorted({h for t in want for h in t})


@pytest.mark.parametrize("x", [[], [0], [1, 255, 256, 65536, (1 << 32) - 1]])
def test_planes_round_trip(x):
    assert classlm._from_planes(classlm._planes(np.array(x, dtype=np.int64))).tolist() == x


def test_sum_by_is_exact():
    u, n = classlm._sum_by([np.array([3, 1, 3]), np.array([], np.int64), np.array([1])],
                           [np.array([1, 2, 1 << 60]), np.array([], np.int64), np.array([5])])
    assert u.tolist() == [1, 3] and n.tolist() == [7, (1 << 60) + 1]
    assert [x.tolist() for x in classlm._sum_by([np.zeros(0, np.uint64)], [np.zeros(0, "<u4")])] == [[], []]
