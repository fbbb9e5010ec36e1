"""The manifest against its SQL and against a plain tree."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from firesight.llm import merkle
from tests.llm.conftest import SMALL
from tests.llm.oracle import duck, same

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h string, kids int"
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def climb(nodes):
    """Root of a level and, per node, (left, right) siblings up to it."""
    paths, own = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(own):
            a = at - at % 8
            paths[i].append(("".join(nodes[a:at]), "".join(nodes[at + 1:a + 8])))
        nodes = [H(*nodes[a:a + 8]) for a in range(0, len(nodes), 8)]
        own = [at // 8 for at in own]
    return nodes[0], paths


def plain(rows):
    """Expected result rows of (doc_id, text, lang, source, n_chars, ...) tuples."""
    def leaf(r, text):
        return H(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in (r[0], r[3], r[2], r[4], text)])

    def low(text):
        return text if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)

    by_lang = defaultdict(list)
    for r in rows:
        hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
        by_lang[r[2]].append((r[0], leaf(r, r[1]), leaf(r, low(r[1]) if hit else r[1])))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in langs:
        by_lang[lang].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees.append(climb([x[1] for x in by_lang[lang]]))
    out = []
    root, above = climb([t[0] for t in trees]) if trees else (None, [])
    for lang, (sub, paths), top in zip(langs, trees, above):
        for (doc_id, own, changed), path in zip(by_lang[lang], paths):
            folded = changed
            for left, right in path + top:
                folded = H(left, folded, right)
            proof = H(*[x for side in path + top for x in side])
            out.append((doc_id, own, sub, root, proof, folded, folded == root))
    return out


def check(df, rows):
    assert df.columns == COLUMNS
    assert Counter(tuple(r) for r in df.collect()) == Counter(plain(rows))


def test_manifest_equals_its_sql(spark):
    names, rows = duck(merkle.ORACLE, SMALL)
    same(merkle.op11_merkle(spark, SMALL), names, rows)


@pytest.mark.parametrize("counts", [{"en": 1}, {"en": 8, None: 1}, {"en": 9, "de": 64, "é": 65, "z": 2},
                                    {"en": 512, "de": 513, "fr": 4097}, {f"l{i}": 1 + i % 3 for i in range(70)}])
def test_manifest_equals_a_plain_tree(spark, counts):
    rng = random.Random(3)
    rows = [(None, "Same TEXT" if i % 5 else f"Text {i} É", lang, f"s{i % 3}", i, "x", 1)
            for lang, n in counts.items() for i in range(n)]
    rng.shuffle(rows)
    rows = [(i, *r[1:]) for i, r in enumerate(rows)]
    check(merkle.manifest(spark.createDataFrame(rows, SCHEMA).repartition(5)), rows)


def test_manifest_of_odd_rows(spark, odd_docs):
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in odd_docs.collect()]
    assert len({r[0] for r in rows}) < len(rows)
    check(merkle.manifest(odd_docs), rows)


def test_manifest_of_an_empty_table(no_docs):
    out = merkle.manifest(no_docs)
    assert out.columns == COLUMNS and out.collect() == []


def test_tampering_shows(spark):
    rows = [(i, "Abc" if i % 2 else "abc", "en", None, None, "x", 1) for i in range(40)]
    got = {r.doc_id: r.verified for r in merkle.manifest(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: not (i % 2 and zlib.crc32(str(i).encode()) % 3 == 0) for i in range(40)}
    assert not all(got.values())
