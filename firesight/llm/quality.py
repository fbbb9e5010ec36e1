"""Line-first cleaning and document quality rules, in DataFrame functions only.

Lines are judged first: a line fails by punctuation (a long line without a single
mark, or words that trail symbols), by navigation (separators between short links)
or by boilerplate (licence, cookie and page furniture phrases). Failing lines are
removed, then a document is rejected if it loses too much of its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firesight.llm.common import SPACE, WORD, table

# Fixed values of the base rules.
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = r"[#*$%&|<>]"

# Line rules.
#: A line of so many words without any of MARKS fails.
UNMARKED_WORDS = 30
MARKS = r"[.!?,;:…。，！？]"
#: A line fails if so many percent of its words carry a symbol, or end in two or more marks.
SYMBOL_WORDS_PERCENT = 30
SYMBOL_WORD = rf"[^{SPACE}]*(?:{SYMBOLS}|[!?]{{2,}})[^{SPACE}]*"
#: A line with separators between words: so many of them, or so many percent of its words.
SEPARATOR = rf"(?:^|[{SPACE}])(?:\||>|>>|/|-|»|›|·)(?=[{SPACE}]|$)"
SEPARATORS_PERCENT = 20
NAVIGATION = r"^(?:home|menu|next|previous|back|login|log in|sign in|sign up|contact|about|search|share|tweet)$"
BOILERPLATE = ["all rights reserved", "released under", "licensed under", "terms of use", "terms of service",
               "privacy policy", "cookie", "javascript", "lorem ipsum", "click here", "subscribe to",
               "copyright (c)", "copyright ©", "© 19", "© 20", "©19", "©20"]
#: A document keeps at least so many percent of its words, or it is rejected.
KEEP_PERCENT = 50


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, f"[{SPACE}]+", -1), "")


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_words(words: str) -> Column:
    """Words inside five-word windows that occur twice or more in the text."""
    w = F.col(words)
    starts = F.sequence(F.lit(1), F.size(w) - (WINDOW - 1))
    keys = F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + (k - 1)) for k in range(WINDOW)]))

    def covered(at: Column) -> Column:  # starts in order: each covers up to the next one, five words at most
        return F.aggregate(at, F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")), lambda acc, s: F.struct(
            (acc["n"] + F.least(F.lit(WINDOW), s - acc["last"])).alias("n"), s.alias("last")), lambda acc: acc["n"])

    def repeated(h: Column) -> Column:
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = _let(ordered, lambda a: F.transform(a, lambda x, j: F.when(
            (F.get(a, j - 1)["h"] == x["h"]) | (F.get(a, j + 1)["h"] == x["h"]), x["i"])))
        return covered(F.array_sort(F.filter(twice, lambda x: x.isNotNull())))

    some = _let(keys, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), repeated(h)).otherwise(0))
    return F.when(F.size(w) >= WINDOW + 1, some).otherwise(0).cast("long")


def line_fails(line: Column) -> Column:
    """True if a line with words fails a rule."""
    def on_words(n: Column) -> Column:
        # the count of symbol words is only taken where a word can be one
        symbols = F.when(line.rlike(rf"{SYMBOLS}|[!?]{{2}}"), F.regexp_count(line, F.lit(SYMBOL_WORD))).otherwise(0)
        return ((n >= UNMARKED_WORDS) & ~line.rlike(MARKS)) | (100 * symbols > SYMBOL_WORDS_PERCENT * n) \
            | (100 * F.regexp_count(line, F.lit(SEPARATOR)) > SEPARATORS_PERCENT * n)

    def on_phrases(low: Column) -> Column:
        found = low.rlike(NAVIGATION)
        for phrase in BOILERPLATE:
            found = found | F.contains(low, F.lit(phrase))
        return found

    return _let(F.regexp_count(line, F.lit(WORD)), on_words) | _let(F.trim(F.lower(line)), on_phrases)


def clean_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, base counts, ``base_failed``, lines and words left, ``kept``, ``cleaned``.

    ``cleaned`` is the text without the failing lines (blank lines stay). ``kept`` is false if
    the base rules fail or fewer than ``KEEP_PERCENT`` of the words are left. Null text has no
    words and fails; repeated rows each get their row; other columns aren't read; empty input
    gives no rows. Nothing is shuffled.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), t.alias("_t")).select("_id", "_t", _words(F.col("_t")).alias("_w"),
                                                                        F.split("_t", "\n", -1).alias("_lines"))
    worded = F.filter("_lines", lambda x: x.rlike(WORD))
    good = F.filter("_lines", lambda x: F.when(x.rlike(WORD), ~line_fails(x)).otherwise(True))
    counted = rows.select(
        "_id", F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        _let(worded, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _repeat_words("_w").alias("n_repeat_words"), F.size("_lines").cast("long").alias("n_lines"),
        good.alias("_good"))
    cleaned = counted.select("*", F.array_join("_good", "\n").alias("cleaned"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    left = cleaned.select("*", F.regexp_count("cleaned", F.lit(WORD)).cast("long").alias("n_words_left"),
                          failed.alias("base_failed"), (F.col("n_lines") - F.size("_good")).alias("n_lines_removed"))
    return left.select(F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "base_failed", (~F.col("base_failed") & (100 * F.col("n_words_left") >= KEEP_PERCENT * F.col("n_words"))
                                       ).alias("kept"), "n_lines_removed", "n_words_left", "cleaned")


def op5_quality_rules(spark, sf_dir):
    return clean_lines(table(spark, sf_dir, "documents")).drop("cleaned")


_W = r"[^\x20\x09-\x0D]+"
_SW = SYMBOL_WORD.replace(SPACE, r"\x20\x09-\x0D")


def _count(pattern: str, column: str) -> str:
    return f"len(regexp_extract_all({column}, '{pattern}'))"


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '{_W}') AS ws, string_split(t, chr(10)) AS ls FROM d),
win AS (SELECT rid, i, ws[i:i + 4] AS x FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, x) AS c FROM win) WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM rep, range(5) r(k) GROUP BY rid),
l AS (SELECT rid, j, ls[j] AS line FROM (SELECT rid, ls, unnest(range(1, len(ls) + 1)) AS j FROM w)),
m AS (SELECT *, {_count(_W, 'line')} AS n, lower(line) AS low FROM l),
f AS (SELECT *, n > 0 AND (
        (n >= {UNMARKED_WORDS} AND NOT regexp_matches(line, '[.!?,;:…。，！？]'))
        OR 100 * {_count(_SW, 'line')} > {SYMBOL_WORDS_PERCENT} * n
        OR 100 * len(list_filter(regexp_extract_all(line, '{_W}'), lambda x: x IN ('|', '>', '>>', '/', '-', '»', '›', '·'))) > {SEPARATORS_PERCENT} * n
        OR regexp_matches(trim(low), '{NAVIGATION}')
        OR {" OR ".join(f"contains(low, '{x}')" for x in BOILERPLATE)}) AS bad FROM m),
a AS (SELECT rid, count(*) FILTER (WHERE n > 0) - count(DISTINCT line) FILTER (WHERE n > 0) AS n_dup_lines,
        count(*) FILTER (WHERE bad) AS n_lines_removed, coalesce(sum(n) FILTER (WHERE NOT bad), 0) AS n_words_left
      FROM f GROUP BY rid),
b AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
        CAST({_count(SYMBOLS, 't')} AS BIGINT) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines_removed, 0) AS n_lines_removed,
        CAST(coalesce(n_words_left, 0) AS BIGINT) AS n_words_left
      FROM w LEFT JOIN cov USING (rid) LEFT JOIN a USING (rid)),
c AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * n_words_left >= {KEEP_PERCENT} * n_words AS kept, n_lines_removed, n_words_left FROM c
"""
