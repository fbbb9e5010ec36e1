"""Near-duplicate operators, components and substring dedup against brute force."""

import random

import numpy as np
import pytest
import xxhash

from firesight.llm import embeddings, simhash, substrings
from firesight.llm.components import components
from tests.llm.conftest import SMALL, words
from tests.llm.oracle import duck, same


def union(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        p, q = find(a), find(b)
        if p != q:
            root[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 440)] + [(7, 7)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.root for r in components(df, "a", "b").collect()}
    want = union(range(500), links)
    assert got == {i: want[i] for i in {x for p in links if p[0] != p[1] for x in p}}
    assert components(df.limit(0), "a", "b").collect() == []


def plain_fingerprint(text, n=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    parts = [b" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("max_bits", [0, 1, 2])
@pytest.mark.parametrize("list_pairs", [0, 3, 32])
def test_fingerprint_links_give_all_components(spark, max_bits, list_pairs):
    rng = random.Random(2)
    fps = {rng.getrandbits(64) for _ in range(30)} | {0, (1 << 64) - 1, 1, 3, 7, 1 << 63}
    for f in list(fps)[:8]:  # clusters of near fingerprints, some of them chains
        for _ in range(25):
            for _ in range(rng.randrange(1, 4)):
                f ^= 1 << rng.randrange(64)
            fps.add(f)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= max_bits]
    df = spark.createDataFrame([(f,) for f in signed], "_fp long").repartition(4)
    edges = simhash.fingerprint_links(df, max_bits, list_pairs)
    got = union(signed, [(r.a, r.b) for r in edges.collect()])
    assert got == union(signed, links)


def check_simhash(rows, docs):
    fps = [plain_fingerprint(r.text) for r in docs]
    links = [(i, j) for i in range(len(docs)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2]
    root = union(range(len(docs)), links)
    least = {}
    for i, r in enumerate(docs):
        ids = [x for x in (least.get(root[i]), r.doc_id) if x is not None]
        least[root[i]] = min(ids, default=None)
    want = sorted((r.doc_id, format(f, "016x"), least[root[i]]) for i, (r, f) in enumerate(zip(docs, fps)) if r.doc_id is not None)
    assert sorted(tuple(r)[:3] for r in rows if r[0] is not None) == want
    assert len(rows) == len(docs)


def test_simhash_on_odd_rows(odd_docs, no_docs):
    check_simhash(simhash.near_duplicates(odd_docs).collect(), odd_docs.collect())
    assert simhash.near_duplicates(no_docs).collect() == []
    kept = simhash.one_per_group(odd_docs)
    assert kept.columns == odd_docs.columns
    groups = simhash.near_duplicates(odd_docs).select("component").distinct().count()
    assert kept.count() == groups
    assert simhash.one_per_group(no_docs).count() == 0


def test_simhash_query_on_small_tables(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    check_simhash(simhash.op3_simhash(spark, SMALL).collect(), docs)


def vectors():
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(24).tolist(), i % 3) for i in range(300)]
    centre = rng.standard_normal(24)
    rows += [(1000 + i, (centre + 0.05 * rng.standard_normal(24)).tolist(), 1) for i in range(150)]
    rows += [(2000 + i, (centre * 2).tolist(), 1 if i < 20 else 2) for i in range(40)]
    rows += [(3000, None, 1), (3001, [0.0] * 24, 1), (3002, [float("nan")] * 24, 1), (3003, [None] + [1.0] * 23, 1),
             (3004, [float("inf")] + [1.0] * 23, 1), (3005, centre.tolist(), None), (3006, centre[:8].tolist(), 1),
             (3007, centre[:8].tolist(), 1), (3008, [], 1)]
    return rows


@pytest.mark.parametrize("piece", [16, 512])
def test_embeddings_against_brute_force(spark, monkeypatch, piece):
    monkeypatch.setattr(embeddings, "PIECE", piece)
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in embeddings.near_duplicate_vectors(df).collect()}
    usable = {}
    for i, v, label in rows:
        if v and label is not None and None not in v:
            x = np.array(v, dtype=np.float32).astype(float)
            if np.isfinite(x).all() and x.any():
                usable[i] = (x / np.linalg.norm(x), label)
    links = [(a, b) for a in usable for b in usable if a < b and usable[a][1] == usable[b][1]
             and len(usable[a][0]) == len(usable[b][0]) and usable[a][0] @ usable[b][0] >= 0.98]
    n = {i: 0 for i, *_ in rows}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    assert len(links) > 1000
    found = sum(r.n_links for r in got.values())
    assert found <= 2 * len(links) and found >= 0.99 * 2 * len(links)
    assert all(got[i].n_links <= n[i] for i in n)
    root = union([i for i, *_ in rows], links)
    assert {i: r.component_id for i, r in got.items()} == root
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


def test_embeddings_empty_and_repeated(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (None, None, 1)],
                               "vec_id long, embedding array<float>, label int")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicate_vectors(df).collect()), key=repr)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (None, 0, None, True)], key=repr)
    assert embeddings.near_duplicate_vectors(df.limit(0)).collect() == []


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(5)
    x = embeddings._unit(rng.standard_normal((400, 64)))
    turn = embeddings.rotations(64, 1)[0]
    codes = np.where(x @ turn > 0, 1.0, -1.0) / 8
    c = ((x @ turn) * codes).sum(axis=1)
    error = (x @ turn) @ codes.T / c - x @ x.T
    error[np.arange(400), np.arange(400)] = 0
    width = np.sqrt((1 - c ** 2) / c ** 2 / 63)
    assert abs(error.mean()) < 0.002
    assert (np.abs(error) <= embeddings.EPSILON * width).mean() > 0.999


def plain_repeats(texts, window):
    ws = [(t or "").encode().split() for t in texts]
    count = {}
    for w in ws:
        for i in range(len(w) - window + 1):
            count[tuple(w[i:i + window])] = count.get(tuple(w[i:i + window]), 0) + 1
    out = []
    for w in ws:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if count[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        out.append((len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return out


@pytest.mark.parametrize("window", [8, 35])
def test_substrings_against_brute_force(spark, odd_docs, monkeypatch, window):
    monkeypatch.setattr(substrings, "BATCH", 3000)  # many batches
    rng = random.Random(4)
    shared = [words(rng, n) for n in (34, 35, 36, 80)]
    texts = [r.text for r in odd_docs.collect()]
    texts += [f"{words(rng, 20)} {rng.choice(shared)}\n{words(rng, rng.randrange(40))} {rng.choice(shared)}" for _ in range(40)]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, kept string").repartition(3)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substrings.remove_repeats(df, window=window).collect()}
    assert [got[i] for i in range(len(texts))] == plain_repeats(texts, window)
    assert substrings.remove_repeats(df.limit(0)).collect() == []


def test_substring_query_on_small_tables(spark):
    names, rows = duck(substrings.ORACLE, SMALL)
    same(substrings.op10_substring_dedup(spark, SMALL), names, rows)


def test_prefix_plan_splits_heavy_prefixes(spark):
    rng = random.Random(6)
    df = spark.createDataFrame([("the " + words(rng, 3) + " the " + words(rng, 50),) for _ in range(200)], "_text string")
    plan = substrings.prefix_plan(df, 8, 64)
    assert (plan[0] < 0).any() and (plan[0] >= 0).any()
    assert (plan[-1] >= 0).all()


def test_windows_that_share_their_first_words_are_dealt_to_all_groups(spark):
    rng = random.Random(8)
    texts = ["a b c d e f g h " + words(rng, 27, 100000) for _ in range(4000)]
    texts += texts[:50]  # copies meet, wherever they are dealt
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    plan = substrings.prefix_plan(df.withColumnRenamed("text", "_text").select("_text"), 35, 64)
    _, groups, _, _ = substrings.Suffixes([t.encode() for t in texts], 35).distinct(plan)
    sizes = np.bincount(groups, minlength=64)
    assert len(sizes) == 64 and sizes.sum() == 4000 and sizes.min() > 30 and sizes.max() < 110
    got = {r.doc_id: r.n_removed for r in substrings.remove_repeats(df).collect()}
    assert got == {i: 35 if i < 50 or i >= 4000 else 0 for i in range(len(texts))}
