"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Each text is scanned once. Candidates are hashed, and the hashes are counted over
the whole corpus by distinct owners and repositories. A value that many owners
carry is a widely copied example; a value of few owners that looks random is
taken for a live credential. The verdict is joined back to every span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firesight.llm.common import table, whole_rows, written

# Kinds in the order of the output, pattern, group that holds the
# value, least length of the value, whether the kind is a base kind. A kind's
# matches are leftmost and don't overlap; those with a shorter value are dropped.
KINDS = [
    ("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"""
               r"""[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
     2, 6, True),
    ("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    ("hex", r"[0-9a-f]+", 0, 24, True),
    ("bearer", r"[Bb]earer\x20+([A-Za-z0-9._~+/=-]+)", 1, 16, False),
    ("userinfo", r"[a-z][a-z0-9+.-]*://[A-Za-z0-9._~%-]+:([A-Za-z0-9._~%+!$*-]+)@", 1, 6, False),
    ("keyblock", r"-----BEGIN [A-Z ]*PRIVATE KEY-----\x20?([A-Za-z0-9+/=]+)", 1, 16, False),
]
#: For hex, runs that are too short are never matches of interest: the pattern asks for the length itself.
_FAST = {"hex": r"[0-9a-f]{24,}", "access": r"AKIA[A-Z0-9]{16,}"}
PLACEHOLDER = r"example|changeme|your|dummy|placeholder|sample|xxxx"

#: From so many distinct owners on, a value is a widely copied example.
COPIED_OWNERS = 3

#: Matches of one text that are placed at a time.
BLOCK = 256

_SPAN = "array<struct<s:int,k:int,e:int,v:string>>"


def _spans(text: Column, matches: Column, kind: int) -> Column:
    """Matches of a kind as (start, kind, end, value): the text between matches gives the positions."""
    name, pattern, group, least, _ = KINDS[kind]
    pattern = _FAST.get(name, pattern)
    whole = F.lit(pattern)
    value = F.regexp_extract_all(text, whole, F.lit(group)) if group else matches
    parts = F.arrays_zip(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches)).alias("gap"),
                         matches.alias("m"), value.alias("v"))
    empty = F.array().cast(_SPAN)

    def run(block: Column, at: Column) -> Column:  # the spans of a block that starts at a place in the text
        def step(acc, x):
            s = acc["at"] + F.length(x["gap"])
            e = s + F.length(x["m"])
            one = F.array(F.struct(s.alias("s"), F.lit(kind).alias("k"), e.alias("e"), x["v"].alias("v")))
            return F.struct(e.alias("at"), F.concat(acc["out"], F.when(F.length(x["v"]) >= least, one).otherwise(empty)).alias("out"))
        return F.aggregate(block, F.struct(at.alias("at"), empty.alias("out")), step, lambda acc: acc["out"])

    def starts(blocks: Column) -> Column:  # where each block starts
        def step(acc, block):
            size = F.aggregate(block, F.lit(0), lambda n, x: n + F.length(x["gap"]) + F.length(x["m"]))
            return F.struct((acc["at"] + size).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
        return F.aggregate(blocks, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), step,
                           lambda acc: acc["out"])

    def in_blocks(p: Column) -> Column:  # arrays grow by concat, so a text of very many matches goes in blocks
        cut = F.transform(F.sequence(F.lit(0), F.floor((F.size(p) - 1) / BLOCK).cast("int")),
                          lambda i: F.slice(p, i * BLOCK + 1, F.lit(BLOCK)))
        return _let(cut, lambda blocks: F.flatten(F.zip_with(blocks, starts(blocks), run)))

    return F.when(F.size(matches) > 0, _let(parts, in_blocks)).otherwise(empty)


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _looks_live(value: Column) -> Column:
    return (F.length(value) >= 8) & value.rlike("[0-9]") & value.rlike("[A-Za-z]") & ~F.lower(value).rlike(PLACEHOLDER)


def _candidates(docs: DataFrame, id_col: str, text: str, owner: str, repository: str) -> DataFrame:
    t = F.coalesce(F.col("_t"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(owner).cast("string").alias("_owner"),
                       F.col(repository).cast("string").alias("_repo"), F.col(text).alias("_t"))
    found = rows.select("_id", "_owner", "_repo", t.alias("_t"), F.xxhash64(t, F.col("_id")).alias("_key"), *[
        F.regexp_extract_all(t, F.lit(_FAST.get(name, pattern)), F.lit(0)).alias(f"_m{k}")
        for k, (name, pattern, *_) in enumerate(KINDS)])
    spans = found.select("_id", "_owner", "_repo", "_key", F.concat(
        *[_spans(F.col("_t"), F.col(f"_m{k}"), k) for k in range(len(KINDS))]).alias("_all"))
    hashed = F.transform("_all", lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"),
                                                    F.sha2(x["v"], 256).alias("h"), _looks_live(x["v"]).alias("live")))
    return spans.select("_id", "_owner", "_repo", "_key", F.array_sort(hashed).alias("_all"))


def ownership(candidates: DataFrame) -> DataFrame:
    """(h, n_owners, n_repositories, n_spans) of every candidate hash over the corpus.

    Pre-aggregated per hash, owner and repository, so a hash that everyone carries
    is a few rows per task. A null owner or repository counts as one more.
    """
    each = candidates.select("_owner", "_repo", F.explode("_all").alias("x")).select("_owner", "_repo", "x.h")
    return (each.groupBy("h", "_owner", "_repo").agg(F.count("*").alias("n"))
            .groupBy("h", "_owner").agg(F.count("*").alias("r"), F.sum("n").alias("n"))
            .groupBy("h").agg(F.count("*").alias("n_owners"), F.sum("r").alias("n_repositories"),
                              F.sum("n").alias("n_spans")))


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", owner: str = "source",
                repository: str = "lang", copied_owners: int = COPIED_OWNERS) -> DataFrame:
    """One row per row of ``docs``: the id and ``spans``, an array of (start, k, end, kind, verdict).

    Spans are sorted by start, then kind. ``verdict`` is "copied" (``copied_owners`` or more
    owners), "live" (fewer owners, letters and digits, no placeholder) or "other". Base kinds
    always stay; added kinds are returned only when live. A repository is counted within its
    owner. Null text is empty and has no spans; null owner or repository is a value of its own;
    repeated rows each get their row; empty input gives no rows. Other columns aren't read.
    """
    cands = written(_candidates(docs, id_col, text, owner, repository), "secret-candidates")
    counted = written(ownership(cands), "secret-ownership")
    verdict = F.when(F.col("n_owners") >= copied_owners, "copied").when(F.col("live"), "live").otherwise("other")
    spans = (cands.select("_key", F.explode("_all").alias("x")).select("_key", "x.*").distinct()
             .join(counted.select("h", "n_owners"), "h")
             .select("_key", "s", "k", "e", verdict.alias("verdict"))
             .filter((F.col("verdict") == "live") | F.col("k").isin([k for k, x in enumerate(KINDS) if x[4]])))
    kind = F.element_at(F.array(*[F.lit(x[0]) for x in KINDS]), F.col("k") + 1)
    per_doc = spans.groupBy("_key").agg(F.array_sort(F.collect_list(F.struct(
        F.col("s").alias("start"), "k", F.col("e").alias("end"), kind.alias("kind"), "verdict"))).alias("spans"))
    have = cands.filter(F.size("_all") > 0).select("_id", "_key").join(per_doc, "_key", "left")
    none = cands.filter(F.size("_all") == 0).select("_id", "_key", F.lit(None).cast(per_doc.schema["spans"].dataType)
                                                    .alias("spans"))
    empty = F.array().cast(per_doc.schema["spans"].dataType)
    return have.select("_id", "_key", "spans").unionAll(none).select(
        F.col("_id").alias(id_col), "_key", F.coalesce("spans", empty).alias("spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def op1_secret_scans(spark, sf_dir):
    spans = F.col("spans")
    base = [k for k, x in enumerate(KINDS) if x[4]]

    def count(cond):
        return F.size(F.filter(spans, cond)).cast("long")

    def of_kind(k):
        return count(lambda x: x["k"] == k).alias(f"n_{KINDS[k][0]}")

    return secret_scan(table(spark, sf_dir, "documents")).select(
        "doc_id", *[of_kind(k) for k in base],
        F.sha2(_joined(F.filter(spans, lambda x: x["k"] < len(base))), 256).alias("base_sha256"),
        _joined(spans).alias("spans"),
        count(lambda x: x["verdict"] == "live").alias("n_live"),
        count(lambda x: x["verdict"] == "copied").alias("n_copied"))


def redact(docs: DataFrame, id_col: str = "doc_id", text: str = "text", owner: str = "source",
           repository: str = "lang", mask: str = "[secret]") -> DataFrame:
    """``docs`` with every span whose verdict is "live" replaced by ``mask``.

    Widely copied examples, placeholders and other spans that don't look random stay as they are.
    Overlapping spans become one mask. Other columns, rows and their number stay as they are.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    found = (secret_scan(docs, id_col, text, owner, repository)
             .select(F.col("_key"), F.filter("spans", lambda x: x["verdict"] == "live").alias("_spans"))
             .filter(F.size("_spans") > 0).dropDuplicates(["_key"]))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, x):
        gap = F.substring(F.col("_text"), acc["at"] + 1, x["start"] - acc["at"])
        return F.when(x["start"] >= acc["at"], F.struct(x["end"].alias("at"), F.concat(acc["out"], gap, F.lit(mask)).alias("out"))
                      ).otherwise(F.struct(F.greatest(acc["at"], x["end"]).alias("at"), acc["out"].alias("out")))

    clean = F.aggregate(F.col("_spans"), start, step,
                        lambda acc: F.concat(acc["out"], F.substring(F.col("_text"), acc["at"] + 1, F.length("_text"))))
    rows = docs.select(whole_rows(docs).alias("_row"), F.xxhash64(t, F.col(id_col)).alias("_key"), F.col(text).alias("_text"))
    masked = rows.join(found, "_key", "left").select("_row", F.when(F.col("_spans").isNull(), F.col("_text")).otherwise(clean)
                                                     .alias("_masked"))
    return masked.select(*[F.col("_masked").alias(c) if c == text else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def _sql_string(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _kind_sql(k: int) -> str:
    name, pattern, group, least, base = KINDS[k]
    p = _sql_string(pattern)
    return f"""
    SELECT rid, {k} AS k, '{name}' AS kind, {str(base).upper()} AS base, v, s, s + length(m) AS e FROM (
      SELECT rid, ms[i] AS m, vs[i] AS v,
             CAST(coalesce(list_sum([length(x) FOR x IN gaps[1:i]]), 0)
                  + coalesce(list_sum([length(x) FOR x IN ms[1:i - 1]]), 0) AS BIGINT) AS s
      FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM (
        SELECT rid, regexp_extract_all(t, {p}, 0) AS ms, regexp_extract_all(t, {p}, {group}) AS vs,
               string_split_regex(t, {p}) AS gaps FROM d)))
    WHERE length(v) >= {least}"""


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, source, lang FROM documents),
c AS ({" UNION ALL ".join(_kind_sql(k) for k in range(len(KINDS)))}),
o AS (SELECT v, count(DISTINCT coalesce(source, chr(1))) AS n_owners FROM c JOIN d USING (rid) GROUP BY v),
j AS (SELECT c.*, CASE WHEN n_owners >= {COPIED_OWNERS} THEN 'copied'
        WHEN length(v) >= 8 AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]')
             AND NOT regexp_matches(lower(v), '{PLACEHOLDER}') THEN 'live' ELSE 'other' END AS verdict
      FROM c JOIN o USING (v)),
s AS (SELECT * FROM j WHERE base OR verdict = 'live'),
a AS (SELECT rid, count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access,
        count(*) FILTER (WHERE k = 2) AS n_hex,
        string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (WHERE base) AS b,
        string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS spans,
        count(*) FILTER (WHERE verdict = 'live') AS n_live, count(*) FILTER (WHERE verdict = 'copied') AS n_copied
      FROM s GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
FROM d LEFT JOIN a USING (rid)
"""
