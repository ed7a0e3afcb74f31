"""Documents to training tokens, in stages that each read what the last one kept."""

from naviscope.llm import bpe, leaks, near, pii, quality
from naviscope.llm.queries import VOCABULARY, table
from naviscope.session import materialise

DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def documents_of(docs):
    """The columns of documents, whatever else the table has."""
    return docs.select(*DOCUMENT)


def quality_rules(spark, docs, sf_dir):
    """Documents that the quality rules keep."""
    return quality.kept_documents(documents_of(docs))


def jaccard_join(spark, docs, sf_dir):
    """One document of each near-duplicate class."""
    return near.without_duplicates(documents_of(docs))


def decontamination(spark, docs, sf_dir):
    """Documents that hold no benchmark passage."""
    return leaks.clean_documents(documents_of(docs), table(spark, sf_dir, "benchmark"))


def personal_data(spark, docs, sf_dir):
    """All documents, personal data replaced by its kind."""
    return pii.redacted(documents_of(docs))


def token_ids(spark, docs, sf_dir):
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit) of every document."""
    return bpe.encode(documents_of(docs), VOCABULARY)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", jaccard_join),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("BPE encoding and decoding", token_ids),
]
# Signatures, sketches, automata and merges have no SQL form: tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over `documents`, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
