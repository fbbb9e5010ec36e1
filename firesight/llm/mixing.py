"""Temperature mixing of sources, realised as budgeted block permutations.

Source weights are token shares to a power ``alpha``, normalised: 1 keeps the
corpus's shares, 0 makes sources equal. ``alpha`` is bisected to the target
entropy, and raised where a source would repeat more often than allowed. Each
source then gets its part of the token budget: passes over the source, each pass
in a fresh order of its blocks, ending where the budget ends.

Every value that decides an order is an MD5 of stated text, so any engine gives
the same mix from the same rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firesight.llm.common import WORD, table, whole_rows, written

#: Share of the largest possible entropy (ln of the number of sources) to reach.
ENTROPY = 0.97
#: Most passes over a source.
MAX_REPEATS = 4.0
#: Documents per block, blocks per group: no window holds more than about so many rows.
BLOCK_DOCS, GROUP_BLOCKS = 256, 256
SEED = 42
#: The exponent is narrowed so many times to one part in SECTIONS: bisection, several steps a job.
SECTIONS, ROUNDS = 64, 6
DIGITS = 9


def _number(text: Column) -> Column:
    """A text's place in a fixed random order, as a number under 2**60."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def source_tokens(rows: DataFrame) -> DataFrame:
    """(source, tokens, docs) of sources with any tokens; a null source is one more source."""
    return (rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs"))
            .filter("tokens > 0"))


def _least_alpha(shares: DataFrame, holds) -> float:
    """Smallest alpha in 0..1 for which holds(z, zl, least share) is true; 1 if none is.

    z is the sum of p**alpha over sources, zl of p**alpha * ln p. All sections of a round
    are tried in one aggregate, so only sums reach the driver however many sources there are.
    """
    lo, hi = 0.0, 1.0
    for _ in range(ROUNDS):
        at = [lo + (hi - lo) * i / SECTIONS for i in range(SECTIONS)]
        p = F.col("p")
        got = shares.agg(F.min("p"), *[F.sum(F.pow(p, F.lit(a))) for a in at],
                         *[F.sum(F.pow(p, F.lit(a)) * F.log(p)) for a in at]).first()
        first = next((i for i in range(SECTIONS) if holds(at[i], got[1 + i], got[1 + SECTIONS + i], got[0])), SECTIONS)
        if first == 0:
            return at[0]
        lo, hi = at[first - 1], (at[first] if first < SECTIONS else hi)
    return hi


def temperature(sources: DataFrame, total: int, budget: int, entropy: float = ENTROPY,
                max_repeats: float | None = MAX_REPEATS, cover: bool = False) -> float:
    """The exponent: as near to the target entropy as the repetition limit allows.

    Entropy falls and the rarest source's repeats fall as alpha grows, so the exponent is the
    larger of the one that meets the entropy and the least one that meets the limit. With ``cover`` the
    budget follows the exponent: the largest source is used once, the rarest (largest / least) ** (1 - alpha) times.
    """
    shares = sources.select((F.col("tokens") / F.lit(total)).alias("p"))
    largest = shares.agg(F.max("p")).first()[0] if cover else None
    goal = entropy * math.log(max(1, sources.count()))

    def entropy_met(a, z, zl, least):  # H <= goal
        return math.log(z) - a * zl / z <= goal

    def repeats_met(a, z, zl, least):
        if cover:
            return (largest / least) ** (1 - a) <= max_repeats
        return least ** (a - 1) / z * budget / total <= max_repeats

    alpha = _least_alpha(shares, entropy_met)
    if max_repeats is not None:
        alpha = max(alpha, _least_alpha(shares, repeats_met))
    return round(alpha, DIGITS)


def weights(sources: DataFrame, total: int, alpha: float) -> DataFrame:
    """``sources`` with ``weight`` (rounded to DIGITS)."""
    powered = F.pow(F.col("tokens") / F.lit(total), F.lit(alpha))
    z = sources.agg(F.sum(powered)).first()[0]
    return sources.withColumn("weight", F.round(powered / F.lit(z), DIGITS))


def document_rows(docs: DataFrame, id_col: str, text: str, source: str, seed: int) -> DataFrame:
    t = F.coalesce(F.col("_t"), F.lit(""))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("_id").cast("string"), F.lit("")), F.md5(t)))
    return (docs.select(F.col(id_col).alias("_id"), F.col(source).alias("source"), F.col(text).alias("_t"))
            .select("_id", "source", F.regexp_count(t, F.lit(WORD)).cast("long").alias("n_tokens"), key.alias("key")))


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
        budget: int | None = None, entropy: float = ENTROPY, max_repeats: float | None = MAX_REPEATS,
        seed: int = SEED, cover: bool = False) -> DataFrame:
    """The mix, one row per document and pass: id, source, ``pass``, ``block``, ``n_tokens``, ``start``, ``key``.

    ``start`` is the token offset in the source's stream; ``start`` over the source's budget is the
    place in the mixed stream. ``budget`` is in words; by default the corpus's own total, or with
    ``cover`` the least total at which every source is used in full at least once. A document is
    drawn if it ends within its source's budget. Null text has no words; null source is a source
    of its own; sources without any words have no share and aren't drawn; repeated rows are rows
    of their own; empty input gives no rows. Other columns aren't read.
    """
    rows = written(document_rows(docs, id_col, text, source, seed), "mix-rows")
    sources = written(source_tokens(rows), "mix-sources")
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    shape = [F.col("_id").alias(id_col), "source", "pass", "block", "n_tokens", "start", "key"]
    if not total:
        return rows.filter("false").withColumns({c: F.lit(0).cast("long") for c in ("pass", "block", "start")}).select(*shape)
    alpha = temperature(sources, total, budget or total, entropy, max_repeats, cover)
    weighed = weights(sources, total, alpha)
    if cover:
        budget = math.ceil(weighed.agg(F.max(F.col("tokens") / F.col("weight"))).first()[0])
    part = F.floor(F.col("weight") * F.lit(budget or total)).cast("long")
    if cover:
        part = F.greatest(part, F.col("tokens"))
    plan = weighed.select(
        "source", "tokens", part.alias("part"),
        F.ceil(F.col("docs") / BLOCK_DOCS).alias("blocks"), F.ceil(F.col("docs") / (BLOCK_DOCS * GROUP_BLOCKS)).alias("groups")
    ).withColumn("passes", F.ceil(F.col("part") / F.col("tokens")))
    # null-safe on source: a null is a source like any other
    r, p = rows.alias("r"), plan.alias("p")
    drawn = (r.join(p, F.col("r.source").eqNullSafe(F.col("p.source")))
             .select("r._id", "r.source", "r.n_tokens", "r.key", "p.tokens", "p.part", "p.blocks", "p.groups", "p.passes"))
    name = F.coalesce(F.col("source").cast("string"), F.lit(""))
    blocked = drawn.filter("passes > 0").withColumn(
        "block", F.pmod(F.conv(F.substring("key", 1, 15), 16, 10).cast("long"), F.col("blocks"))
    ).withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes") - 1)))
    turn = _number(F.concat_ws(":", F.lit(str(seed)), name, F.col("block"), F.col("pass")))
    placed = blocked.withColumn("turn", turn).withColumn("group", F.pmod(F.col("turn"), F.col("groups")))
    unit = ["source", "pass", "group"]

    def before(by, order):
        return F.sum("n").over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))

    # tokens before a group, before a block in its group, before a document in its block
    per_block = placed.groupBy(*unit, "block", "turn").agg(F.sum("n_tokens").alias("n"))
    per_group = per_block.groupBy(*unit).agg(F.sum("n").alias("n"))
    g = per_group.select(*unit, F.coalesce(before(["source", "pass"], ["group"]), F.lit(0)).alias("g0"))
    b = per_block.select(*unit, "block", F.coalesce(before(unit, ["turn", "block"]), F.lit(0)).alias("b0")).alias("b")
    g = g.alias("g")
    offsets = b.join(g, F.col("b.source").eqNullSafe(F.col("g.source")) & (F.col("b.pass") == F.col("g.pass"))
                     & (F.col("b.group") == F.col("g.group"))).select(
        F.col("b.source").alias("o_source"), F.col("b.pass").alias("o_pass"), F.col("b.block").alias("o_block"),
        (F.col("g0") + F.col("b0")).alias("offset"))
    in_block = F.coalesce(F.sum("n_tokens").over(
        Window.partitionBy("source", "pass", "block").orderBy("key", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = placed.withColumn("inside", in_block)
    at = placed.join(offsets, F.col("source").eqNullSafe(F.col("o_source")) & (F.col("pass") == F.col("o_pass"))
                     & (F.col("block") == F.col("o_block")))
    start = F.col("pass") * F.col("tokens") + F.col("offset") + F.col("inside")
    return at.withColumn("start", start).filter(F.col("start") + F.col("n_tokens") <= F.col("part")).select(*shape)


def op8_mixing(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents")).drop("key")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
                    wordless: bool = False, **options) -> DataFrame:
    """``docs`` as mixed: each row as often as it was drawn, with its own columns. Equal rows come as often
    as was drawn for them together. With ``cover`` (an option of ``mix``) every document comes, and none more
    than ``max_repeats`` times but for rounding.

    ``wordless``: the rows of sources without any words, which have no share in the mix, are passed through once.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    seed = options.get("seed", SEED)
    # rows of equal id, text and source share a key: of R such rows that were drawn D times, each comes D // R
    # times, and the first D % R of them, by their other columns, once more
    drawn = mix(docs, id_col, text, source, **options).groupBy("key", "source").agg(F.count("*").alias("_drawn"))
    own = docs.select(whole_rows(docs).alias("_row"), F.col(source).alias("_source"), F.md5(F.concat_ws(
        ":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(t))).alias("_key"))
    each = own.select("_key", "_source").groupBy("_key", "_source").agg(F.count("*").alias("_rows"))
    same = (F.col("key") == F.col("_key")) & F.col("source").eqNullSafe(F.col("_source"))
    share = drawn.join(each, same).select("key", "source", F.floor(F.col("_drawn") / F.col("_rows")).cast("int").alias("_times"),
                                          (F.col("_drawn") % F.col("_rows")).alias("_more"))
    met = own.join(share, same)
    place = F.row_number().over(Window.partitionBy("_key", "_source").orderBy(F.xxhash64("_row")))
    # only rows that are equal and unevenly drawn are numbered
    uneven = met.filter("_more > 0").withColumn("_times", F.col("_times") + (place <= F.col("_more")).cast("int"))
    mixed = met.filter("_more = 0").unionByName(uneven).filter("_times > 0").select(
        "_row", F.explode(F.array_repeat(F.lit(1), F.col("_times"))).alias("_copy")).select("_row.*")
    if not wordless:
        return mixed
    # one row per source: true if any of its texts has a word
    silent = (docs.select(F.col(source).alias("_silent"), t.rlike(WORD).alias("_words"))
              .groupBy("_silent").agg(F.max("_words").alias("_words")).filter(~F.col("_words")))
    rows = docs.select(whole_rows(docs).alias("_row"), F.col(source).alias("_source"))
    return mixed.unionAll(rows.join(silent, F.col("_source").eqNullSafe(F.col("_silent")), "left_semi").select("_row.*"))


def _number_sql(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


def _alpha_sql(name: str, holds: str) -> str:
    """The same narrowing, by halves, over the list of shares."""
    return f"""{name} AS (SELECT 0 AS i, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi
      UNION ALL SELECT i + 1, CASE WHEN {holds} THEN lo ELSE (lo + hi) / 2 END, CASE WHEN {holds} THEN (lo + hi) / 2 ELSE hi END
      FROM {name}, ps WHERE i < 45)"""


_Z = "list_sum([pow(p, (lo + hi) / 2) FOR p IN l])"
_ZL = "list_sum([pow(p, (lo + hi) / 2) * ln(p) FOR p IN l])"
ORACLE = f"""
WITH RECURSIVE r AS MATERIALIZED (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens,
    md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS key FROM documents),
s AS MATERIALIZED (SELECT source, CAST(sum(n_tokens) AS BIGINT) AS tokens, count(*) AS docs FROM r GROUP BY source HAVING sum(n_tokens) > 0),
tt AS (SELECT CAST(sum(tokens) AS BIGINT) AS total FROM s),
ps AS MATERIALIZED (SELECT list(tokens / total) AS l, min(tokens / total) AS least, {ENTROPY} * ln(count(*)) AS goal FROM s, tt),
{_alpha_sql("eb", f"ln({_Z}) - (lo + hi) / 2 * {_ZL} / {_Z} <= goal")},
{_alpha_sql("rb", f"pow(least, (lo + hi) / 2 - 1) / {_Z} <= {MAX_REPEATS}")},
al AS (SELECT round(greatest((SELECT hi FROM eb WHERE i = 45), (SELECT hi FROM rb WHERE i = 45)), {DIGITS}) AS alpha),
w AS (SELECT source, tokens, docs, total, pow(tokens / total, alpha) AS q FROM s, tt, al),
pl AS (SELECT source, tokens, CAST(floor(round(q / (SELECT sum(q) FROM w), {DIGITS}) * total) AS BIGINT) AS part,
    CAST(ceil(docs / {BLOCK_DOCS}) AS BIGINT) AS blocks, CAST(ceil(docs / {BLOCK_DOCS * GROUP_BLOCKS}) AS BIGINT) AS grps FROM w),
d AS (SELECT doc_id, r.source, n_tokens, key, tokens, part, grps, {"CAST('0x' || substr(key, 1, 15) AS BIGINT)"} % blocks AS block,
    unnest(range(0, CAST(ceil(part / tokens) AS BIGINT))) AS pass FROM r JOIN pl ON r.source IS NOT DISTINCT FROM pl.source),
t AS (SELECT *, {_number_sql(f"'{SEED}:' || coalesce(source, '') || ':' || block || ':' || pass")} AS turn FROM d),
o AS (SELECT *, pass * tokens + CAST(coalesce(sum(n_tokens) OVER (PARTITION BY source, pass ORDER BY turn % grps, turn, block, key, n_tokens
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM t)
SELECT doc_id, source, pass, block, n_tokens, start FROM o WHERE start + n_tokens <= part
"""
