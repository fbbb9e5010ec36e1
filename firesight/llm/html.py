"""HTML extraction by markup and by what a host's pages repeat.

Markup says outright what some parts of a page are: article and main hold its text;
menus, headers, footers, sidebars, forms, scripts and blocks that call themselves
adverts, notices or comments don't; an article of such a name (a comment, an advert)
goes too. A name that only says where a block stands (sidebar, menu, search) drops it outside
an article, not within. An article or main within a form or within a block that is
dropped for its name is text if it is the page's largest, and the only one for blocks
called furniture. The rest is decided
by repeats: a substring of ``REPEAT`` tokens that stands on two pages of the host or
more is boilerplate, the tokens that such substrings cover are removed, and the
unique runs stay; beside an article or main, those of ``REPEAT`` tokens or more.
Copies of a page, exact or near (SimHash), count as one page, so that copies of a
text don't turn it into boilerplate.

Repeats are found over the whole host: batches send the distinct fingerprints of
their substrings to keys, pages are counted there, and one bit for each goes back.
Hosts on which markup decides every block need none of this. ``repeated`` is the
plain form for pages at hand: a suffix array, sorted by prefix doubling up to the
depth that decides.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firesight.llm.common import (exchange_rows, in_batches, key_count, pack, pack_rows, rows_sorted, run_exchange, table, tune,
                                  unpack, unpack_rows, written)
from firesight.llm.simhash import near_duplicates, simhash

REPEAT = 8
#: Near copies: pages of at most so many differing SimHash bits.
COPY_BITS = 2
#: Text bytes per batch.
BATCH = 4 << 20
#: The table of hosts with undecided blocks is broadcast up to so many rows, else joined.
BROADCAST_HOSTS = 100_000

_token = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<raw>script|style|noscript|template|svg|textarea|iframe|select|title)\b[^>]*+>.*?(?:</(?P=raw)\s*+>|\Z)"
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)[^>]*+>", re.S | re.I)
_attr = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\s*+(?:=\s*+("[^"]*+"|'[^']*+'|[^\s>]++))?""", re.I)

# What markup says about a part of a page.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span "
                   "strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("nav footer aside form head button menu dialog object canvas audio video".split())
#: How a part is dropped: for the name of its place (or as a form), outright, or for a name that furniture has.
BY_PLACE, OUTRIGHT, BY_NAME = 1, 2, 4
TEXT = frozenset("article main".split())
TEXT_ROLES = frozenset("main article".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar".split())
_NAMED = r"(?:^|[\s_-])(?:%s)(?:$|[\s_-])"
FURNITURE_NAME = re.compile(_NAMED % (
    r"ads?|advert\w*|sponsor\w*|promo\w*|cookies?|consent|notice|popup|comments?|disqus|share|sharing|related|newsletter"
    r"|subscribe"), re.I)
PLACE_NAME = re.compile(_NAMED % "banner|modal|menu|nav|navbar|navigation|breadcrumbs?|sidebar|footer|social|login|search", re.I)


class Block:
    """``held``: the number of the dropped block that its article or main stands in, 0 for none; ``named``:
    that block is called furniture."""
    __slots__ = ("text", "inside", "held", "named")

    def __init__(self, text: str, inside: bool, held: int = 0, named: bool = False):
        self.text, self.inside, self.held, self.named = text, inside, held, named


def _about(attrs: str) -> tuple[int, bool]:
    """(how it is dropped, text) by the attributes of an element."""
    dropped, text = 0, False
    for name, value in _attr.findall(attrs):
        value, name = value.strip("\"'"), name.lower()
        if name in ("class", "id"):
            dropped |= BY_NAME * bool(FURNITURE_NAME.search(value)) | BY_PLACE * bool(PLACE_NAME.search(value))
        elif name == "role":
            text |= value.lower() in TEXT_ROLES
            dropped |= OUTRIGHT * (value.lower() in DROPPED_ROLES)
        elif name == "hidden":
            dropped |= OUTRIGHT * (value.lower() != "until-found")
        else:
            dropped |= OUTRIGHT * (value.lower() == "true")
    return dropped, text


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page that aren't dropped by markup; ``inside``: within article or main."""
    out: list[Block] = []
    parts: list[str] = []
    stack: list[tuple[str, int, bool, int, bool]] = []  # element, dropped, inside, held, named, as inherited
    outside = (0, False, 0, False)
    held_blocks = 0

    def close():
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                out.append(Block(text, inside, held, named))

    dropped, inside, held, named = outside
    at = 0
    for m in _token.finditer(page):
        if m.start() > at and not dropped:
            parts.append(page[at:m.start()])
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            if m["raw"]:
                close()
            continue
        ends, attrs = (m["end"] or m["end2"]) == "/", m["attrs"] or ""
        if not ends and tag not in VOID:
            drop, text = _about(attrs) if attrs else (0, False)
            if inside:
                drop &= ~BY_PLACE
            inline = tag in INLINE
            if inline and not drop:
                continue  # inline markup only matters if it is dropped
            close()
            if tag in ("p", "li", "option") and stack and stack[-1][0] == tag:
                stack.pop()
                dropped, inside, held, named = stack[-1][1:] if stack else outside
            text |= tag in TEXT
            # a header is furniture unless it stands in the article
            drop |= BY_PLACE * (tag == "form") | OUTRIGHT * ((tag in DROPPED and tag != "form") or (tag == "header" and not inside))
            # the page's text as a whole isn't dropped for its class, an article is if it is called furniture
            if text or tag in ("body", "html"):
                drop = drop & BY_NAME if tag == "article" else 0
            if drop and not dropped:
                held_blocks += 1
            # an article or main may be text for all that its surroundings are called
            kept = text and not drop and not inside and dropped and not dropped & OUTRIGHT
            if kept:
                now = (0, True, held, bool(dropped & BY_NAME))
            else:
                now = (dropped | drop, inside or text, held_blocks if drop and not dropped else held, named)
            stack.append((tag, *now))
            dropped, inside, held, named = now
        elif ends:
            if any(s[0] == tag for s in stack):
                close()
                while stack.pop()[0] != tag:
                    pass
                dropped, inside, held, named = stack[-1][1:] if stack else outside
            elif tag not in INLINE:
                close()
        elif tag not in INLINE:
            close()
    if at < len(page) and not dropped:
        parts.append(page[at:])
    close()
    return _settled(out)


def _settled(blocks: list[Block]) -> list[Block]:
    """Without the articles in dropped blocks that aren't the page's text (see the module's text)."""
    if not any(b.held for b in blocks):
        return blocks
    size: dict[int, int] = {}
    for b in blocks:
        if b.inside:
            size[b.held] = size.get(b.held, 0) + len(b.text)
    most = max(size.values())
    kept = {h for h in size if h and size[h] == most}
    return [b for b in blocks if not b.held or (b.held in kept and (not b.named or len(size) == 1))]


def repeated(tokens: np.ndarray, page: np.ndarray, depth: int = REPEAT, copies: np.ndarray | None = None) -> np.ndarray:
    """Which tokens are covered by a substring of ``depth`` tokens that starts on two pages or more.

    ``tokens`` are numbers from 0, ``page`` never falls. ``copies``: a number for each token that
    copies of a page share; they count as one page. Suffixes are ranked by prefix doubling; a
    suffix that is shorter than the depth within its page ranks apart from longer ones.
    """
    n = len(tokens)
    if not n:
        return np.zeros(0, dtype=bool)
    rank, length = tokens.astype(np.int64) + 1, 1
    stop = np.searchsorted(page, page, side="right")
    while length < depth:
        step = min(length, depth - length)
        there = np.arange(n) + step
        nxt = np.where(there < stop, rank[np.minimum(there, n - 1)], 0)
        _, rank = np.unique(rank * (rank.max() + nxt.max() + 1) + nxt, return_inverse=True)
        rank += 1
        length += step
    counted = page if copies is None else copies
    order = np.lexsort((counted, rank))  # the suffix array to this depth
    r, p = rank[order], counted[order]
    node = np.concatenate([[0], np.cumsum(r[1:] != r[:-1])])
    pages = np.bincount(node, weights=np.concatenate([[True], (r[1:] != r[:-1]) | (p[1:] != p[:-1])]))
    start = np.zeros(n, dtype=bool)
    start[order] = (pages > 1)[node]
    start &= np.arange(n) + depth <= stop
    return _covered(np.flatnonzero(start), n, depth)


def _covered(starts: np.ndarray, n: int, depth: int = REPEAT) -> np.ndarray:
    """Which of n tokens the substrings of ``depth`` tokens at ``starts`` cover."""
    edges = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + depth, -1)
    return np.cumsum(edges[:-1]) > 0


def text_of(blocks: list[Block], gone: np.ndarray) -> str:
    """The text of a page whose repeated tokens are known: what markup keeps, and the unique runs of the rest.

    Beside an article or main, a run of fewer than ``REPEAT`` tokens isn't text: it is too short to tell.
    """
    marked = any(b.inside for b in blocks)
    texts, at = [], 0
    keep = ~gone
    if marked and not all(b.inside for b in blocks):
        outside = np.repeat([not b.inside for b in blocks], [len(b.text.split()) for b in blocks])
        run = (keep & outside).astype(np.int8)
        edges = np.flatnonzero(np.diff(run, prepend=0, append=0))
        for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if hi - lo < REPEAT:
                keep[lo:hi] = False
    for b in blocks:
        words = b.text.split()
        own = keep[at:at + len(words)]
        at += len(words)
        texts.append(b.text if b.inside or own.all() else " ".join(w for w, k in zip(words, own.tolist()) if k))
    return " ".join(t for t in texts if t)


def _joined(blocks: list[Block]) -> str:
    return "\n".join(b.text for b in blocks)  # a block's text holds no line ends


def _blocks(text: str, inside: str) -> list[Block]:
    return [Block(t, i == "1") for t, i in zip(text.split("\n"), inside)]


def main_texts(pages: list[str]) -> list[str]:
    """The main text of each page of a host: the plain form of ``extract``, every pair of pages compared."""
    parsed = [blocks_of(p) for p in pages]
    marks = [simhash(_joined(b).encode()) for b in parsed]
    copies = list(range(len(pages)))
    for i in range(len(pages)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= COPY_BITS and copies[i] != copies[j]:
                copies = [copies[j] if c == copies[i] else c for c in copies]
    ids: dict[str, int] = {}
    streams = [[ids.setdefault(w, len(ids)) for b in blocks for w in b.text.split()] for blocks in parsed]
    sizes = [len(s) for s in streams]
    flat = np.fromiter((t for s in streams for t in s), dtype=np.int64, count=sum(sizes))
    gone = repeated(flat, np.repeat(np.arange(len(pages)), sizes), copies=np.repeat(np.array(copies, dtype=np.int64), sizes))
    stops = np.cumsum(sizes)
    return [text_of(blocks, gone[stop - size:stop]) for blocks, size, stop in zip(parsed, sizes, stops)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _windows(host: str, text: str) -> np.ndarray:
    """A fingerprint of the host and of every substring of REPEAT tokens, in order."""
    words = text.split()
    n = len(words) - REPEAT + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    h = np.fromiter((xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))
    acc = np.full(n, xxhash.xxh3_64_intdigest(host.encode("utf-8", "surrogatepass")), np.uint64)
    for i in range(REPEAT):
        acc = _mixed(acc + h[i:i + n])
    return acc


def _batch_windows(batch: pa.RecordBatch):
    """Distinct fingerprints of a batch, each page's places in them, and the number of windows of each page."""
    per_page = [_windows(h, t) for h, t in zip(batch.column("_host").to_pylist(), batch.column("_text").to_pylist())]
    u, at = np.unique(np.concatenate(per_page), return_inverse=True)
    return u, at, np.array([len(w) for w in per_page], dtype=np.int64)


def _by_key(u: np.ndarray, keys: int):
    k = (u % np.uint64(keys)).astype(np.int64)
    order = np.argsort(k, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(k[order])) + 1) if len(u) else []:
        yield int(k[part[0]]), part


_KEPT = ["_id", "_url", "_host", "_text", "_inside"]


def _scan(keys: int):
    """Fingerprints with the least and the greatest group of copies that has each; and the pages for the last step."""
    def run(batches):
        for g, batch in in_batches(batches, "_text", BATCH):
            u, at, sizes = _batch_windows(batch)
            groups, group = np.unique(batch.column("_copies").to_numpy(zero_copy_only=False), return_inverse=True)
            least, most = np.full(len(u), len(groups)), np.full(len(u), -1)
            np.minimum.at(least, at, np.repeat(group, sizes))
            np.maximum.at(most, at, np.repeat(group, sizes))
            rows = []
            for k, p in _by_key(u, keys):
                here, ends = np.unique(np.concatenate([least[p], most[p]]), return_inverse=True)
                rows.append((k, g, 1, u[p].tobytes(), pack([groups[here].astype("<i8").tobytes(), ends.astype("<u4").tobytes()])))
            yield exchange_rows([*rows, (g % keys, g, 2, pack([pack_rows(batch, _KEPT)]), b"")])
    return run


def _answer(batches):
    """One bit per fingerprint: whether pages of different groups have it."""
    def done(k, asked):
        u, at = np.unique(np.concatenate([x for _, x, _, _ in asked]), return_inverse=True)
        least = np.full(len(u), np.iinfo(np.int64).max)
        most = np.full(len(u), np.iinfo(np.int64).min)
        np.minimum.at(least, at, np.concatenate([x for _, _, x, _ in asked]))
        np.maximum.at(most, at, np.concatenate([x for _, _, _, x in asked]))
        several, start = (least < most)[at], 0
        for g, x, _, _ in asked:
            yield exchange_rows([(k, g, 1, np.packbits(several[start:start + len(x)]).tobytes(), b"")])
            start += len(x)

    key, asked = None, []
    for k, g, kind, a, b in rows_sorted(batches):
        if asked and (k != key or kind == 2):
            yield from done(key, asked)
            asked = []
        key = k
        if kind == 2:
            yield exchange_rows([(k, g, kind, a, b)])
            continue
        groups, ends = unpack(b)
        ends = np.frombuffer(groups, "<i8")[np.frombuffer(ends, "<u4")]
        u = np.frombuffer(a, np.uint64)
        asked.append((g, u, ends[:len(u)], ends[len(u):]))
    if asked:
        yield from done(key, asked)


def _texts(batch: pa.RecordBatch, gone) -> pa.RecordBatch:
    ids, urls, texts, inside = (batch.column(c) for c in ("_id", "_url", "_text", "_inside"))
    out = [text_of(_blocks(t, i), g) for t, i, g in zip(texts.to_pylist(), inside.to_pylist(), gone)]
    return pa.RecordBatch.from_arrays([ids, urls, pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                                      names=["_id", "_url", "text", "n_chars"])


def _finish(keys: int):
    def run(batches):
        group, answers = None, []
        for _, g, kind, a, _ in rows_sorted(batches):  # by key within a batch, as asked
            if g != group:
                group, answers = g, []
            if kind == 1:
                answers.append(a)
                continue
            batch = unpack_rows(next(unpack(a)))
            u, at, sizes = _batch_windows(batch)
            several = np.zeros(len(u), dtype=bool)
            for bits, (_, p) in zip(answers, _by_key(u, keys)):
                several[p] = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(p)).astype(bool)
            stops, gone = np.cumsum(sizes), []
            for text, size, stop in zip(batch.column("_text").to_pylist(), sizes, stops):
                gone.append(_covered(np.flatnonzero(several[at[stop - size:stop]]), len(text.split())))
            yield _texts(batch, gone)
    return run


def _by_markup(batches):
    """Pages of hosts on which no block waits for a decision."""
    for batch in batches:
        yield _texts(batch, [np.zeros(len(t.split()), dtype=bool) for t in batch.column("_text").to_pylist()])


def _parse(batches):
    for batch in batches:
        parsed = [blocks_of(p or "") for p in batch.column("_page").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("_id", "_url", "_host")), pa.array([_joined(b) for b in parsed], pa.string()),
             pa.array(["".join("01"[x.inside] for x in b) for b in parsed], pa.string())], names=_KEPT)


def extract(pages: DataFrame, id_col: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per row of ``pages``: the id, the url, ``text`` and ``n_chars``.

    Null and empty pages have an empty text. Pages without a host (null or odd urls) are grouped as
    one more host. Text within article or main always stays, whether it repeats or not. Copies of a
    page, exact or near, all keep their text. Repeated rows get a row each; other columns aren't
    read; empty input gives no rows.
    """
    spark = pages.sparkSession
    tune(spark)
    host = F.lower(F.regexp_extract(F.coalesce(F.col("_url"), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    rows = (pages.select(F.col(id_col).alias("_id"), F.col(url).alias("_url"), F.col(page).alias("_page"))
            .select("_id", "_url", host.alias("_host"), "_page"))
    parsed = written(rows.mapInArrow(_parse, rows.drop("_page").schema.add("_text", "string").add("_inside", "string")), "html-blocks")
    schema = parsed.select("_id", "_url").schema.add("text", "string").add("n_chars", "long")
    hosts = written(parsed.filter(F.col("_inside").contains("0")).select("_host").distinct(), "html-hosts")
    n_hosts = hosts.count()
    if not n_hosts:
        return parsed.mapInArrow(_by_markup, schema).toDF(id_col, url, "text", "n_chars")
    if n_hosts <= BROADCAST_HOSTS:
        hosts = F.broadcast(hosts)
    decided = parsed.join(hosts, "_host", "left_anti").mapInArrow(_by_markup, schema)
    waiting = parsed.join(hosts, "_host", "left_semi").withColumn("_content", F.xxhash64("_text"))
    copies = near_duplicates(waiting.select("_content", "_text").dropDuplicates(["_content"]), "_content", "_text", max_bits=COPY_BITS)
    found = waiting.join(copies.select("_content", F.col("component").alias("_copies")), "_content").select(*_KEPT, "_copies")
    keys = key_count(spark)
    # batches are numbered by their place in the table, so the table is written
    found = run_exchange(written(found, "html-pages"), _scan(keys), _answer, _finish(keys), schema)
    return decided.unionAll(found).toDF(id_col, url, "text", "n_chars")


def op9_html(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages"))
