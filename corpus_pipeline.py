"""Corpus pipeline: documents through five of the training-data operators.

Documents that the toxicity operator rejects go, one document of each near-duplicate
group stays, live-looking credentials are masked, sources are
mixed to target weights, and what is left is encoded. Every stage works on all that
its predecessor kept.

Odd rows, in every stage: an empty table gives an empty table with the stage's columns; a null
text counts as empty; texts of any length are worked on whole; repeated rows are documents of
their own until the near-duplicate stage keeps one of them; null ids, sources and languages are
values like any other; further columns travel along unread, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from firesight.llm import bpe, mixing, secrets, simhash, toxicity
from firesight.llm.common import table, written

#: The mix aims at this share of the largest entropy by repeating small sources; none loses a document.
ENTROPY = 0.9


def drop_toxic(spark, docs, sf_dir):
    """Documents whose score stays below the operator's threshold.

    Documents without any word get the score of such documents in the labelled sample and are kept
    with it; rows with equal scores are decided alike."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.accepted(docs, model)


def drop_near_duplicates(spark, docs, sf_dir):
    """One document of each SimHash group: 3-word shingles, at most 2 differing bits.

    The smallest id stays (a null id only if the group has no other); of rows that agree in id
    one stays. Documents without words are one group, as their fingerprints are equal."""
    return simhash.one_per_group(docs, shingle=3, max_bits=2)


def mask_secrets(spark, docs, sf_dir):
    """Texts with their live-looking credentials masked; ``n_chars`` follows the text.

    A null text stays null. Overlapping spans are masked together; texts without a live
    span, those with placeholders or widely copied examples included, stay as they are."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark, docs, sf_dir):
    """Documents repeated so that source shares approach the target entropy; every document stays.

    No document comes more than four times (the operator's limit), so that a source of a few
    documents doesn't multiply; documents of sources without any word come once."""
    return mixing.mixed_documents(docs, entropy=ENTROPY, cover=True, wordless=True)


def encode(spark, docs, sf_dir):
    """The training rows: ids with their digests; an empty text has no ids and the digest of none."""
    ids = bpe.encode_documents(docs, bpe.default_tokenizer(), keep=("doc_id", "lang", "source"))
    return bpe.digests(ids, "doc_id", "lang", "source", "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: The classifier and the tokeniser have no SQL form; tests/llm holds run() against a plain version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """STAGES over the documents table, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
