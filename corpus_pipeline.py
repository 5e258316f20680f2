"""The corpus pipeline: toxicity, line dedup, near-dedup, decontamination, token counts.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its
predecessor kept. All but the last return the columns of documents; the last
returns one row of token counts and digests per document that is left.
"""

from __future__ import annotations

from pointcluster.llm import bpe, decontaminate, linededup, neardup, toxicity
from pointcluster.llm.common import Tables, closing_tables, table

STAGES = [
    ("toxicity", toxicity.drop_toxic),
    ("line_dedup", linededup.drop_lines),
    ("near_dedup", neardup.drop_near_duplicates),
    ("decontamination", decontaminate.drop_contaminated),
    ("byte_bpe", bpe.encode_stage),
]

# learned scores and connected components have no SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark, sf_dir):
    """The stages in order over documents, each result written and read again; a stage's
    own tables go once its result is stored."""
    tables = Tables(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with closing_tables():
            docs = tables.store(stage(spark, docs, sf_dir), name)
    return docs
