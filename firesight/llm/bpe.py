"""BPE encoding and decoding with content-defined chunks that documents share.

Each text is cut where a rolling hash of the last 16 bytes has its low bits zero,
so equal passages are cut alike wherever they stand. A chunk's text meets its
copies from all documents by digest and is encoded once. A cut may split a word;
the join is repaired where the whole text is at hand: a window around the cut is
encoded again, with one more word on either side each time, until its outer
words come out exactly as in the two chunks. The document's ids are then the
chunks' ids with the words at each cut replaced by the repaired ones. When the
pieces are put together, the outer words are compared again; a difference is an
error, never a silent change.

Words here are runs without ASCII white space. The supported tokenisers never let
a token span white space, which makes the outer words' agreement final.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firesight.llm.common import (Packer, exchange_rows, in_batches, key_count, pack, pack_rows, rows_sorted, run_exchange, table,
                                  texts_of, tune, unpack, unpack_rows)

#: Chunk lengths in bytes: least, mean distance of further cuts (a power of two), most.
LEAST, MEAN, MOST = 512, 1024, 8192
#: Words a worker keeps encoded, in each of two generations; results don't depend on it.
MEMORY_WORDS = 1 << 19
#: Text bytes per batch.
BATCH = 8 << 20
#: Chunks and ids travel compressed against a sample of the texts: so many bytes from the starts of
#: so many texts. Only their size on the wire depends on it.
SAMPLE_BYTES, SAMPLE_TEXTS, LEVEL = 1 << 18, 256, 6

_GEAR = np.frombuffer(hashlib.shake_256(b"content-defined chunks").digest(256 * 4), dtype="<u4")


class Words(dict):
    """Ids of a word (bytes without ASCII white space), as packed unsigned numbers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.older: dict[bytes, bytes] = {}
        self.dtype = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"

    def whole(self, text: bytes) -> bytes:
        """The ids of a text encoded in one go."""
        ids = self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids
        return np.array(ids, dtype=self.dtype).tobytes()

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= MEMORY_WORDS:
            self.older = dict(self)
            self.clear()
        packed = self.older.get(word)
        if packed is None:
            packed = self.whole(word)
        self[word] = packed
        return packed

    def encode(self, text: bytes) -> bytes:
        """The same, from the ids of the words."""
        return b"".join(map(self.__getitem__, text.split()))


_loaded: dict[str, Words] = {}


def words_of(path: str) -> Words:
    if path not in _loaded:
        _loaded[path] = Words(path)
    return _loaded[path]


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of a text. Cuts fall between UTF-8 characters."""
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    raw = np.frombuffer(data, dtype=np.uint8)
    h = _GEAR[raw]
    for step in (1, 2, 4, 8):  # h[i] covers bytes i-15..i
        nxt = h.copy()
        nxt[step:] += h[:-step] << np.uint32(step)
        h = nxt
    starts = np.append((raw[1:] & 0xC0) != 0x80, True)
    # high bits: they depend on all 16 bytes
    where = np.flatnonzero(((h >> np.uint32(15)) & np.uint32(MEAN - 1) == 0) & starts) + 1
    out, last = [], 0
    while last < n:
        if n - last <= LEAST:
            out.append(n)
            break
        i = np.searchsorted(where, last + LEAST)
        end = int(where[i]) if i < len(where) else n
        if end > last + MOST:
            end = last + MOST
            while end > last and end < n and raw[end] & 0xC0 == 0x80:
                end -= 1
        out.append(min(end, n))
        last = out[-1]
    return out


_SPACES = b" \t\n\r\x0b\x0c"
_NOT_SPACES = bytes(x for x in range(256) if x not in _SPACES)
_space = re.compile(rb"[ \t\n\r\x0b\x0c]")


def _word_left(data: bytes, at: int) -> int:
    """Start of the word that ends at or reaches over ``at``, skipping white space before it."""
    while at > 0 and data[at - 1] in _SPACES:
        at -= 1
    return _run_left(data, at)


def _run_left(data: bytes, at: int) -> int:
    width = 64
    while True:  # look back in growing steps: a long text isn't read to its start for every cut
        start = max(0, at - width)
        seen = data[start:at].rstrip(_NOT_SPACES)
        if seen or start == 0:
            return start + len(seen)
        width *= 4


def _run_right(data: bytes, at: int) -> int:
    found = _space.search(data, at)
    return found.start() if found else len(data)


def _word_right(data: bytes, at: int) -> int:
    while at < len(data) and data[at] in _SPACES:
        at += 1
    return _run_right(data, at)


def repair(data: bytes, cut: int, left: int, right: int, words: Words) -> tuple[int, int, bytes]:
    """Where the ids around a cut must be replaced: start and end in the text, and the new ids.

    ``left`` and ``right`` bound the text that the chunks beside the cut cover. The window
    grows by a word per side until its outer words agree with the chunks' own; beyond the
    bounds there is nothing to agree with.
    """
    a, b = _run_left(data, cut), _run_right(data, cut)
    inner = (a, b)
    while True:
        a, b = _word_left(data, a) if a > left else a, _word_right(data, b) if b < right else b
        window = words.whole(data[a:b])
        head = words.encode(data[a:inner[0]]) if a >= left else b""
        tail = words.encode(data[inner[1]:b]) if b <= right else b""
        fresh = words.encode(data[inner[0]:inner[1]])
        if window == head + fresh + tail:
            return inner[0], inner[1], fresh
        if a <= left and b >= right:
            return a, b, window
        inner = (a, b)


def plan(data: bytes, words: Words) -> tuple[list[tuple[int, int]], list[tuple[int, int, bytes]]]:
    """The chunks of a text, and its repairs: (start, end, ids) in order, never overlapping."""
    ends = cuts(data)
    chunks = list(zip([0, *ends[:-1]], ends))
    repairs: list[tuple[int, int, bytes]] = []
    for (s, cut), (_, e) in zip(chunks, chunks[1:]):
        if data[cut - 1] in _SPACES or data[cut] in _SPACES or (repairs and repairs[-1][1] > cut):
            continue
        a, b, ids = repair(data, cut, s, e, words)
        if repairs and a < repairs[-1][1]:  # they meet: one repair over both
            a = repairs.pop()[0]
            ids = words.encode(data[a:b])
        repairs.append((a, b, ids))
    return chunks, repairs


def _scan(path: str, keys: int, id_names: list[str], sample: bytes):
    def run(batches):
        words, chunks_out = words_of(path), Packer(sample, LEVEL)
        width = np.dtype(words.dtype).itemsize
        for g, batch in in_batches(batches, "_text", BATCH):
            known: dict[bytes, int] = {}
            sent: list[bytes] = []
            recipes = []
            for data in texts_of(batch, "_text"):
                chunks, repairs = plan(data, words)
                steps, r = [], 0
                for s, e in chunks:
                    lo, hi = s, e  # the part of the chunk that no repair covers
                    while r < len(repairs) and repairs[r][1] <= s:
                        r += 1
                    before = repairs[r] if r < len(repairs) and repairs[r][0] < s < repairs[r][1] else None
                    if before:
                        lo = min(e, before[1])
                    q = r + (before is not None)
                    after = repairs[q] if q < len(repairs) and repairs[q][0] < e else None
                    if after:
                        hi = max(lo, after[0])
                    if lo < hi:
                        piece = data[s:e]
                        digest = hashlib.blake2b(piece, digest_size=16).digest()
                        at = known.setdefault(digest, len(sent))
                        if at == len(sent):
                            sent.append(piece)
                        # ids of the words at either end that a repair replaces
                        drop = len(words.encode(data[s:lo])) // width, len(words.encode(data[hi:e])) // width
                        near = words.encode(data[lo:_word_right(data, lo)] if before else b"")
                        steps += [np.array([at, *drop, len(near)], "<u4").tobytes(), near]
                    else:
                        steps.append(np.array([0xFFFFFFFF, 0, 0, 0], "<u4").tobytes())
                    if after:
                        steps += [np.array([len(after[2])], "<u4").tobytes(), after[2]]
                    else:
                        steps.append(b"\0\0\0\0")
                recipes.append(b"".join(steps))
            by_key: dict[int, list[tuple[int, bytes]]] = {}
            for digest, at in known.items():
                by_key.setdefault(int.from_bytes(digest[:8], "little") % keys, []).append((at, digest))
            rows = [(k, g, 0, np.array([at for at, _ in some], "<u4").tobytes() + b"".join(d for _, d in some),
                     chunks_out.pack([sent[at] for at, _ in some])) for k, some in by_key.items()]
            rows.append((g % keys, g, 1, pack_rows(batch, id_names), pack(recipes)))
            yield exchange_rows(rows)
    return run


def _answer(path: str, sample: bytes, ids_sample: bytes):
    def run(batches):
        words, k, done = words_of(path), None, {}
        chunks_in, ids_out = Packer(sample, LEVEL), Packer(ids_sample, LEVEL)
        out, size = [], 0
        for key, g, kind, a, b in rows_sorted(batches):
            if key != k:
                k, done = key, {}
            if kind == 0:
                n = len(a) // 20
                answers = []
                for i, piece in enumerate(chunks_in.unpack(b)):
                    digest = a[4 * n + 16 * i:4 * n + 16 * i + 16]
                    ids = done.get(digest)
                    if ids is None:
                        ids = done[digest] = words.encode(piece)
                    answers.append(ids)
                a, b = a[:4 * n], ids_out.pack(answers)
            out.append((key, g, kind, a, b))
            size += len(b)
            if size > 4 << 20:
                yield exchange_rows(out)
                out, size = [], 0
        if out:
            yield exchange_rows(out)
    return run


def assemble(recipe: bytes, chunk_ids: dict[int, bytes], width: int) -> bytes:
    """A document's ids from its recipe and the ids of its chunks."""
    out, at = [], 0
    while at < len(recipe):
        chunk, head, tail, near = np.frombuffer(recipe, "<u4", 4, at).tolist()
        at += 16
        if chunk != 0xFFFFFFFF:
            ids = chunk_ids[chunk]
            ids = ids[head * width:len(ids) - tail * width]
            if near and ids[:near] != recipe[at:at + near]:
                raise ValueError("a chunk's ids don't agree with its repaired join")
            at += near
            out.append(ids)
        n = int(np.frombuffer(recipe, "<u4", 1, at)[0])
        at += 4
        out.append(recipe[at:at + n])
        at += n
    return b"".join(out)


def _finish(path: str, names: list[str], ids_sample: bytes):
    def run(batches):
        words, ids_in = words_of(path), Packer(ids_sample, LEVEL)
        width = np.dtype(words.dtype).itemsize
        tokens = np.array([words.tokenizer.id_to_token(i) or "" for i in range(words.tokenizer.get_vocab_size())], dtype=object)
        plain = words.tokenizer.decoder is None
        group, chunk_ids = None, {}
        for _, g, kind, a, b in rows_sorted(batches):
            if g != group:
                group, chunk_ids = g, {}
            if kind == 0:
                chunk_ids.update(zip(np.frombuffer(a, "<u4").tolist(), ids_in.unpack(b)))
                continue
            ids = unpack_rows(a)
            recipes = list(unpack(b))
            n = len(recipes)
            for start in range(0, n, 64):
                lists, texts = [], []
                for recipe in recipes[start:start + 64]:
                    one = np.frombuffer(assemble(recipe, chunk_ids, width), words.dtype).astype(np.int32)
                    lists.append(one)
                    # without a decoder, decode() joins the tokens by spaces
                    texts.append(" ".join(tokens[one].tolist()) if plain else
                                 words.tokenizer.decode(one.tolist(), skip_special_tokens=False))
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
                values = pa.array(np.concatenate(lists) if lists else np.array([], np.int32), pa.int32())
                rows = ids.slice(start, len(lists))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.ListArray.from_arrays(pa.array(offsets), values), pa.array(texts, pa.string())],
                    names=names)
    return run


def encode_documents(docs: DataFrame, tokenizer: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per row of ``docs``: the columns in ``keep``, ``ids`` (array<int>) and ``decoded``.

    ``tokenizer`` is the path of a tokenizers JSON file, the same on every machine; truncation
    and padding are off and no special tokens are added. Null and empty texts have no ids and an
    empty decoded text. A text without white space is one word and is repaired as a whole.
    Nulls in ``keep``, repeated rows and repeated ids give their rows; empty input gives no rows;
    columns outside ``keep`` and ``text`` aren't read.
    """
    tune(docs.sparkSession)
    names = [f"_keep{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.col(text).alias("_text"))
    kept = rows.drop("_text").schema
    schema = kept.add("ids", T.ArrayType(T.IntegerType())).add("decoded", "string")
    some = rows.select(F.substring("_text", 1, 2 * SAMPLE_BYTES // SAMPLE_TEXTS).alias("t")).limit(SAMPLE_TEXTS).collect()
    sample = b"\n".join((r.t or "").encode() for r in some)[:SAMPLE_BYTES]
    ids_sample = words_of(tokenizer).encode(sample)
    found = run_exchange(rows, _scan(tokenizer, key_count(docs.sparkSession), names, sample),
                         _answer(tokenizer, sample, ids_sample), _finish(tokenizer, schema.names, ids_sample), schema)
    return found.toDF(*keep, "ids", "decoded")


def digests(encoded: DataFrame, *keep: str) -> DataFrame:
    """Token count and SHA-256 of the ids and of the decoded text."""
    joined: Column = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(*keep, F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


def default_tokenizer() -> str:
    import public_tokenizers
    return str(public_tokenizers.path("word_bpe_49k.json"))


def op2_bpe(spark, sf_dir):
    return digests(encode_documents(table(spark, sf_dir, "documents"), default_tokenizer()), "doc_id")
