"""Registered queries of the training-data operators, with production parameters."""

import public_tokenizers

from verbalance.llm import (
    alignment,
    bpe,
    embedding_dedup,
    exact_dedup,
    fingerprint,
    html_text,
    language,
    line_dedup,
    merkle,
    minhash,
    mixing,
    toxicity,
    url_filter,
)

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def op1_line_dedup(spark, sf_dir):
    return line_dedup.dedup_lines(documents(spark, sf_dir)).drop("keep")


def op2_toxicity(spark, sf_dir):
    return toxicity.score(documents(spark, sf_dir), table(spark, sf_dir, "labels")).drop("spans")


def op3_bpe(spark, sf_dir):
    return bpe.encode_decode(documents(spark, sf_dir), VOCABULARY)


def op4_embedding_dedup(spark, sf_dir):
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op5_mixing(spark, sf_dir):
    return mixing.mix(documents(spark, sf_dir))


def op6_language(spark, sf_dir):
    return language.identify(documents(spark, sf_dir))


def op7_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(documents(spark, sf_dir)).drop("locator", "repeats")


def op8_url_filter(spark, sf_dir):
    judged = url_filter.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))
    return judged.drop("rate", "bound")


def op9_html_text(spark, sf_dir):
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op10_minhash(spark, sf_dir):
    return minhash.near_duplicates(documents(spark, sf_dir))


def op11_token_alignment(spark, sf_dir):
    return alignment.align(documents(spark, sf_dir), VOCABULARY, PIECES)


def op12_merkle_manifest(spark, sf_dir):
    return merkle.manifest(documents(spark, sf_dir))


def op13_fingerprints(spark, sf_dir):
    return fingerprint.fingerprints(documents(spark, sf_dir))


QUERIES = {
    query.__name__: query
    for query in (
        op1_line_dedup,
        op2_toxicity,
        op3_bpe,
        op4_embedding_dedup,
        op5_mixing,
        op6_language,
        op7_exact_dedup,
        op8_url_filter,
        op9_html_text,
        op10_minhash,
        op11_token_alignment,
        op12_merkle_manifest,
        op13_fingerprints,
    )
}
