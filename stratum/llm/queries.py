"""Registered queries of the numbered operators: ``(spark, sf_dir) -> DataFrame``.

Each applies its operator, with production parameters, to its whole table.
"""

from __future__ import annotations

from stratum.llm import (centroids, chunk_dedup, embedding_dedup, fingerprints, line_dedup, manifest, mixing, quality, repeat_dedup, sentencepiece_codec,
                         simhash_dedup, token_store, toxicity)
from stratum.llm.common import table
from stratum.session import apply_defaults, scratch_dir


def tokenizer_file(name: str) -> str:
    """Path of a public tokenizer's vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sentencepiece(spark, sf_dir):
    apply_defaults(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece_codec.digests(
        sentencepiece_codec.encode_and_decode(docs, tokenizer_file("piece_bpe_32k.model")))


def op2_fingerprints(spark, sf_dir):
    apply_defaults(spark)
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op3_simhash_dedup(spark, sf_dir):
    apply_defaults(spark)
    return simhash_dedup.digests(table(spark, sf_dir, "documents"))


def op4_embedding_dedup(spark, sf_dir):
    apply_defaults(spark)
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_mixing(spark, sf_dir):
    apply_defaults(spark)
    return mixing.schedule(table(spark, sf_dir, "documents"))


def op6_chunk_dedup(spark, sf_dir):
    apply_defaults(spark)
    return chunk_dedup.digests(table(spark, sf_dir, "documents"))


def op7_repeat_dedup(spark, sf_dir):
    apply_defaults(spark)
    return repeat_dedup.digests(table(spark, sf_dir, "documents"))


def op8_toxicity(spark, sf_dir):
    apply_defaults(spark)
    return toxicity.digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_token_store(spark, sf_dir):
    apply_defaults(spark)
    path = scratch_dir(spark, "tokens")
    token_store.write(table(spark, sf_dir, "documents"), path, tokenizer_file("word_bpe_49k.json"), end_id=2)
    return token_store.read(spark, path)


def op10_quality(spark, sf_dir):
    apply_defaults(spark)
    return quality.digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_centroids(spark, sf_dir):
    apply_defaults(spark)
    return centroids.digests(table(spark, sf_dir, "embeddings"))


def op12_line_dedup(spark, sf_dir):
    apply_defaults(spark)
    return line_dedup.digests(table(spark, sf_dir, "documents"), scratch_dir(spark, "lines"))


def op13_manifest(spark, sf_dir):
    apply_defaults(spark)
    return manifest.digests(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_fingerprints": op2_fingerprints,
    "op3_simhash_dedup": op3_simhash_dedup,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_mixing": op5_mixing,
    "op6_chunk_dedup": op6_chunk_dedup,
    "op7_repeat_dedup": op7_repeat_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_token_store": op9_token_store,
    "op10_quality": op10_quality,
    "op11_centroids": op11_centroids,
    "op12_line_dedup": op12_line_dedup,
    "op13_manifest": op13_manifest,
}
#: Hashes, learned scores and tokenizers have no SQL form; the tests compare those with brute force.
ORACLE: dict[str, str] = {
    "op4_embedding_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach(id, node) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.id, l.b FROM reach r JOIN l ON l.a = r.node),
low AS (SELECT id, min(node) AS component_id FROM reach GROUP BY id),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT id AS vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, component_id = id AS kept
FROM low LEFT JOIN n ON n.a = low.id""",
    "op11_centroids": centroids.SQL,
    "op12_line_dedup": line_dedup.SQL,
}
