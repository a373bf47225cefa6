"""From raw documents to token ids: five stages, each written before the next one reads it."""

from verbalance import session
from verbalance.llm import bpe, exact_dedup, minhash, mixing, queries, toxicity


def drop_toxic(spark, docs, sf_dir):
    """Documents the conditional random field does not find toxic."""
    return toxicity.clean_documents(docs, queries.table(spark, sf_dir, "labels"))


def drop_copies(spark, docs, sf_dir):
    """One document of each set of equal texts."""
    return exact_dedup.kept_documents(docs)


def drop_near_copies(spark, docs, sf_dir):
    """One document of each group linked by shingles of five words, four fifths of them shared."""
    return minhash.kept_documents(docs)


def mix_sources(spark, docs, sf_dir):
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def encode(spark, docs, sf_dir):
    """Counts and digests of token ids and of what they decode to, one row per document taken."""
    return bpe.encode_decode(docs, queries.VOCABULARY)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

# No stage but the second has an equivalent in SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``; each result is a table that the next one reads."""
    docs = queries.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        path = session.scratch_path(spark, f"pipeline-{name.replace(' ', '-')}")
        docs = session.written(stage(spark, docs, sf_dir), path)
    return STAGES[-1][1](spark, docs, sf_dir)
