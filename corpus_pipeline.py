"""The corpus pipeline: quality rules, near-dedup, decontamination, source mixing, token output.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; between stages the rows are written as
Parquet and read back. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from cadenza.llm import decontaminate, minhash, mixing, quality_rules, token_store
from cadenza.llm.common import passing_tables, remove, table
from cadenza.session import ensure_checkpoint_dir


def quality(spark, docs, sf_dir):
    """Documents that pass the quality rules, without their failing lines."""
    return quality_rules.keep_good(docs)


def dedup(spark, docs, sf_dir):
    """One document of each group of near duplicates (the smallest id)."""
    return minhash.keep_one(docs)


def decontam(spark, docs, sf_dir):
    """Documents without a benchmark window."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark, docs, sf_dir):
    """The documents of the mix, each as often as it is taken."""
    return mixing.mixed_documents(docs)


def tokens(spark, docs, sf_dir):
    """Token ids in the block file format, read back."""
    return token_store.token_report(docs)


STAGES = [("quality rules", quality), ("near duplicates", dedup), ("decontamination", decontam),
          ("source mix", mix), ("token output", tokens)]

# The mix is a pseudorandom draw and the ids come from a tokenizer: SQL cannot express either.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``. A stage's table, and what its operators wrote on the way, is deleted as soon as the
    next table is complete; what stays is the input of the last stage and the token files."""
    docs = table(spark, sf_dir, "documents")
    base = f"{ensure_checkpoint_dir(spark)}/cadenza-llm/{spark.sparkContext.applicationId}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES[:-1]):
        with passing_tables(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(f"{base}/{i}")
        docs = spark.read.schema(out.schema).parquet(f"{base}/{i}")
        if i:
            remove(spark, f"{base}/{i - 1}")
    return STAGES[-1][1](spark, docs, sf_dir)
