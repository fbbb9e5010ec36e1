"""Merkle manifest of a documents table: leaves, subroots per language, root and proofs.

A node is the SHA-256 of its run of at most eight children; per language the leaves ascend by id, and the
languages' subroots, in byte order, form the tree above. The method is a nested-struct rollup:

1. rows get their rank within the language from a range-sorted table: place in the partition, less where the
   language starts there, plus what earlier partitions hold of it (one row per partition and language);
2. the rank's lowest base-8 digits are columns, the rest is the block. Grouping a digit column away makes the
   structs of a run an array of the next node, so a block of 512 ranks ends as one row with its whole subtree;
3. blocks are the nodes of the next tower floor, rolled up the same way until one is left;
4. going down, transform and explode turn a block's arrays into one row per node with the siblings on its path.
   A block meets the path above it by grouping both under the block's key; no proof needs a join.

No row holds more than a block, whatever the language's share of the table. Blocks are dealt by language and
number, so a language with a third of all rows is as many blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firesight.llm.common import partitions, table, written

#: Children of a node: 8 by the manifest's format, three bits of the rank.
BITS = 3
#: Digit columns of a block: 8^3 = 512 ranks.
DIGITS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PATH = "array<struct<l:string,r:string>>"


def _sha(x: Column) -> Column:
    return F.sha2(x, 256)


def _field(x: Column) -> Column:
    """UTF-8 byte count, a colon and the value; ``-`` for null."""
    x = x.cast("string")
    return F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-"))


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, lang, ``h`` (the leaf) and ``changed`` (the leaf of the row after the tampering)."""
    text, key = F.col("text").cast("string"), F.crc32(F.col("doc_id").cast("string").cast("binary"))
    tampered = F.when(F.coalesce(key % 3 == 0, F.lit(False)), F.translate(text, UPPER, LOWER)).otherwise(text)
    head = [_field(F.col(c)) for c in FIELDS[:-1]]
    own = docs.select(*[F.col(f"`{c}`").alias(c) for c in FIELDS]).select(
        "doc_id", "lang", _sha(F.concat(*head, _field(text))).alias("h"),
        F.when(~tampered.eqNullSafe(text), _sha(F.concat(*head, _field(tampered)))).alias("changed"))
    return own.withColumn("changed", F.coalesce("changed", "h"))


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``idx``: their place from 0 within ``group`` by ``order`` (nulls first)."""
    keys = [group, *order]
    placed = rows.repartitionByRange(partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys)
    number = F.monotonically_increasing_id()
    stored = written(placed.withColumns({"_part": F.shiftright(number, 33),
                                         "_at": number.bitwiseAND(F.lit((1 << 33) - 1))}), "merkle-sorted")
    parts = stored.groupBy("_part", group).agg(F.min("_at").alias("start"), F.count("*").alias("n"))
    # a group has a row per partition that it reaches into
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    moved = parts.select(F.col("_part").alias("_p"), F.col(group).alias("_g"),
                         (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("start")).alias("_by"))
    return (stored.join(moved, (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")))
            .withColumn("idx", F.col("_at") + F.col("_by")).drop("_part", "_at", "_p", "_g", "_by"))


def rollup(nodes: DataFrame, group: str, payload: list[str]) -> DataFrame:
    """One row per block of ``group``: ``kids`` (its nested subtree), ``n`` ranks, ``levels`` and digest ``h``.

    Block 0 with free ranks is all its group has; its tree ends where one node remains. Every other block
    is hashed through all its levels.
    """
    digits = [f"d{k}" for k in reversed(range(DIGITS))]
    at = {f"d{k}": F.shiftright("idx", BITS * k).bitwiseAND(F.lit((1 << BITS) - 1)).cast("int") for k in range(DIGITS)}
    rows = nodes.select(group, F.shiftright("idx", BITS * DIGITS).alias("block"), *[at[d].alias(d) for d in digits],
                        F.lit(1).cast("long").alias("n"),
                        F.struct(at["d0"].alias("d"), "h", *payload).alias("kid")).repartition(group, "block")
    for k in reversed(range(DIGITS)):  # the block's partitioning serves all these groupings
        rows = rows.groupBy(group, "block", *digits[:k]).agg(
            F.sort_array(F.collect_list("kid")).alias("kids"), F.sum("n").alias("n"))
        h = _sha(F.array_join(F.col("kids.h"), ""))
        if k:
            rows = rows.withColumn("kid", F.struct(F.col(digits[k - 1]).alias("d"), h.alias("h"), "kids"))
    first, lone, levels, digest = F.col("kids")[0], F.col("block") == 0, F.lit(DIGITS), h
    for level in reversed(range(DIGITS)):
        fits = lone & (F.col("n") <= 1 << BITS * level)
        levels, digest = F.when(fits, level).otherwise(levels), F.when(fits, first["h"]).otherwise(digest)
        first = first["kids"][0] if level else None
    return rows.select(group, "block", "kids", "n", levels.cast("int").alias("levels"), digest.alias("h"))


def tower(nodes: DataFrame, group: str, payload: list[str]) -> list[DataFrame]:
    """Blocks of blocks until every group has one; the number of floors is the logarithm of the ranks to 512."""
    floors = []
    while True:
        floors.append(written(rollup(nodes, group, payload if not floors else []), "merkle-blocks"))
        if floors[-1].filter("block > 0").isEmpty():
            return floors
        nodes = floors[-1].select(group, F.col("block").alias("idx"), "h")


def descend(floors: list[DataFrame], group: str, tops: DataFrame) -> DataFrame:
    """All nodes of the lowest floor: group, ``idx``, ``node`` and ``top``, whose ``path`` has their siblings to
    the root, lowest level first. ``tops``: group, ``block``, ``top`` of the highest floor's blocks."""
    for floor in reversed(floors):
        blocks = floor.select(group, "block", F.struct("levels", "kids").alias("body"))
        both = blocks.withColumn("top", F.lit(None).cast(tops.schema["top"].dataType)).unionByName(
            tops.withColumn("body", F.lit(None).cast(blocks.schema["body"].dataType)))
        # one row of each kind per key
        rows = both.groupBy(group, "block").agg(F.first("body", ignorenulls=True).alias("body"),
                                                F.first("top", ignorenulls=True).alias("top"))
        rows = rows.select(group, F.col("block").alias("idx"), F.col("body.levels").alias("levels"),
                           F.col("body.kids").alias("kids"), F.col("top.path").alias("path"), "top")
        for level in reversed(range(DIGITS)):
            step = F.transform("kids", lambda x, i: F.struct(
                x.alias("node"), F.array_join(F.slice(F.col("kids.h"), 1, i), "").alias("l"),
                F.array_join(F.slice(F.col("kids.h"), i + 2, 1 << BITS), "").alias("r")))
            rows = rows.select(group, "idx", "levels", "path", "top", F.inline(step)).withColumns({
                "idx": F.shiftleft("idx", BITS) + F.col("node.d"),
                "path": F.when(F.col("levels") > level, F.concat(F.array(F.struct("l", "r")), F.col("path")))
                .otherwise(F.col("path"))})
            if level:
                rows = rows.withColumn("kids", F.col("node.kids"))
        rows = rows.withColumn("top", F.col("top").withField("path", F.col("path")))
        tops = rows.select(group, F.col("idx").alias("block"), "top")
    return rows.select(group, "idx", "node", "top")


def manifest(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Any column may be null (``-`` in the leaf); a null language is a group of its own, before the others; rows
    with a null id come first and aren't tampered with. Repeated rows are leaves of their own; rows of an
    id with other contents follow each other by leaf. A language of one leaf has that leaf as subroot, a
    table of one language its subroot as root; without siblings the proof is the digest of no bytes. An empty
    table gives no rows. Texts of any length are hashed whole; other columns aren't read.
    """
    rows = written(leaves(docs).withColumnRenamed("lang", "_lang"), "merkle-leaves")
    floors = tower(ranked(rows, "_lang", ["doc_id", "h"]), "_lang", ["doc_id", "changed"])
    subroots = floors[-1].select(F.lit(0).alias("_all"), "_lang", "h")
    above = tower(ranked(subroots, "_all", ["_lang"]), "_all", ["_lang"])
    root = above[-1].select("_all", "block", F.struct(F.array().cast(PATH).alias("path"), F.col("h").alias("root")).alias("top"))
    langs = descend(above, "_all", root).select(
        F.col("node._lang").alias("_lang"), F.lit(0).cast("long").alias("block"),
        F.col("top").withField("subroot", F.col("node.h")).alias("top"))
    found = descend(floors, "_lang", langs)
    path = F.col("top.path")
    folded = F.aggregate(path, F.col("node.changed"), lambda own, p: _sha(F.concat(p["l"], own, p["r"])))
    siblings = F.array_join(F.transform(path, lambda p: F.concat(p["l"], p["r"])), "")
    out = found.select(F.col("node.doc_id").alias("doc_id"), F.col("node.h").alias("leaf"),
                       F.col("top.subroot").alias("subroot"), F.col("top.root").alias("root"),
                       _sha(siblings).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op11_merkle(spark, sf_dir):
    return manifest(table(spark, sf_dir, "documents"))


def _levels(base: str, group: str, n: int, prefix: str) -> str:
    """CTEs ``{prefix}0..n``: nodes of each level with their siblings; ``base``: group, idx, m (nodes), h."""
    same = f"{group}, idx // 8"
    sides = (f"coalesce(string_agg(h, '') OVER (PARTITION BY {same} ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, "
             f"coalesce(string_agg(h, '') OVER (PARTITION BY {same} ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r")
    ctes = [f"{prefix}0 AS (SELECT {group}, idx, m, h, {sides} FROM {base})"]
    for k in range(1, n + 1):
        ctes.append(f"""{prefix}{k} AS (SELECT {group}, idx, m, h, {sides} FROM (
            SELECT {group}, idx // 8 AS idx, CASE WHEN any_value(m) = 1 THEN 1 ELSE (any_value(m) + 7) // 8 END AS m,
                   CASE WHEN any_value(m) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY idx)) END AS h
            FROM {prefix}{k - 1} GROUP BY {group}, idx // 8))""")
    return ",\n".join(ctes)


def oracle(levels: int = 8, lang_levels: int = 4) -> str:
    """DuckDB SQL of ``manifest`` for up to 8^levels rows of a language and 8^lang_levels languages."""
    def leaf(text):
        parts = [f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in (*FIELDS[:-1], text)]
        return f"sha256({' || '.join(parts)})"
    digits = "list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT)"
    bits = "list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {digits}), lambda c, b: {bits}), 4294967295)"
    steps = [("a", k, "lang") for k in range(levels)] + [("b", k, "one") for k in range(lang_levels)]
    joins = "\n".join(
        f"JOIN {p}{k} ON " + (f"a{k}.lang IS NOT DISTINCT FROM d.lang AND a{k}.idx = d.idx // {8 ** k}" if p == "a"
                              else f"b{k}.idx = s.idx // {8 ** k}") for p, k, _ in steps)
    sides = " || ".join(f"CASE WHEN {p}{k}.m > 1 THEN {p}{k}.l || {p}{k}.r ELSE '' END" for p, k, _ in steps)
    folded = "d.changed"
    ctes, last = [], "d0"
    ctes.append(f"""d0 AS (SELECT d.doc_id, d.h AS leaf, s.h AS subroot, (SELECT h FROM b{lang_levels}) AS root, d.changed AS f,
        sha256({sides}) AS proof_sha256, {', '.join(f'{p}{k}.m AS {p}m{k}, {p}{k}.l AS {p}l{k}, {p}{k}.r AS {p}r{k}' for p, k, _ in steps)}
        FROM ranked d JOIN subs s ON s.lang IS NOT DISTINCT FROM d.lang {joins})""")
    for i, (p, k, _) in enumerate(steps):
        folded = f"CASE WHEN {p}m{k} > 1 THEN sha256({p}l{k} || f || {p}r{k}) ELSE f END"
        ctes.append(f"d{i + 1} AS (SELECT * REPLACE ({folded} AS f) FROM {last})")
        last = f"d{i + 1}"
    return f"""WITH rows AS (
        SELECT doc_id, lang, {leaf('text')} AS h,
               CASE WHEN doc_id IS NOT NULL AND {crc} % 3 = 0 THEN {leaf('low')} ELSE {leaf('text')} END AS changed
        FROM (SELECT *, translate(text, '{UPPER}', '{LOWER}') AS low FROM documents)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS idx,
                      count(*) OVER (PARTITION BY lang) AS m FROM rows),
    {_levels('ranked', 'lang', levels, 'a')},
    subs AS (SELECT 0 AS one, lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS m FROM a{levels}),
    {_levels('subs', 'one', lang_levels, 'b')},
    {', '.join(ctes)}
    SELECT doc_id, leaf, subroot, root, proof_sha256, f AS folded_root, f = root AS verified FROM {last}"""


ORACLE = oracle()
