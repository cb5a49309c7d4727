"""The training-data pipeline: its stages, each of which calls one operator.

Every stage works on all rows that its predecessor kept; all but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stratum.llm import chunk_dedup, mixing, sentencepiece_codec, simhash_dedup, toxicity
from stratum.llm.common import materialize, table
from stratum.llm.queries import tokenizer_file
from stratum.session import apply_defaults

#: No source is read more often than this, and none less than once.
MAX_REPEATS = 1.25


def drop_toxic(spark, docs, sf_dir):
    """Drop the documents whose toxicity is one half or more."""
    apply_defaults(spark)
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark, docs, sf_dir):
    """Keep one document of each group of SimHash near-duplicates."""
    apply_defaults(spark)
    return simhash_dedup.deduplicate(docs).select(docs.columns)


def substring_dedup(spark, docs, sf_dir):
    """Cut passages out of every document but the first that has them."""
    apply_defaults(spark)
    cut = chunk_dedup.remove_copies(docs, removed=None)
    return cut.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def mix_sources(spark, docs, sf_dir):
    """Repeat documents of rarer sources; each document is read at least once."""
    apply_defaults(spark)
    return mixing.mix(docs, max_repeats=MAX_REPEATS, budget=None, added=False)


def encode(spark, docs, sf_dir):
    """Token ids (little-endian unsigned 32-bit) and their round trip, per document read."""
    apply_defaults(spark)
    coded = sentencepiece_codec.encode_and_decode(docs, tokenizer_file("piece_bpe_32k.model"))
    return coded.select("doc_id", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [("toxicity", drop_toxic), ("simhash_dedup", near_dedup), ("substring_dedup", substring_dedup),
          ("mixing", mix_sources), ("sentencepiece", encode)]


def run(spark, sf_dir):
    """Apply the stages to the documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs


#: Learned scores and content-defined chunks have no SQL form; the tests compare with brute force.
ORACLE_SQL = None
