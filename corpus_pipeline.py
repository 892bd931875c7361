"""The corpus pipeline: documents -> packed training sequences.

``STAGES`` are applied in order; each takes (spark, docs, sf_dir), works on all
that the stage before it kept, and is written as Parquet before the next one.
All but the last return the columns of ``documents``.  Each stage calls one
operator of ``cellhouse.llm``.

Defined for all stages: further columns are kept unchanged, whatever their names
(the last stage has columns of its own); repeated rows are rows of their own unless
a stage drops copies; null ids, sources, langs and sizes are allowed; an empty table
gives an empty result with the same columns; texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cellhouse.llm import decontaminate, lang_id, secret_scan, simhash
from cellhouse.llm.common import stored, table
from cellhouse.llm.queries import packed


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no labelled language go: those with null, empty or letterless
    text, and those of whose letters less than half occur in any labelled text.  Ties
    between languages do not matter, nor does the document's own label.  With no
    labelled document at all, every one with a letter stays."""
    return lang_id.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of the least id stays (null ids
    count as greatest; of rows of equal least id one stays).  Wordless texts, null or
    not, have fingerprint zero and are near each other."""
    return simhash.without_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by a benchmark passage go: at least a twentieth of
    their words lies in windows of benchmark items.  Null and wordless texts stay; an
    empty benchmark, or items without text, contaminate nothing."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; n_chars follows where the text changes (a null
    n_chars too); all documents stay, and those without a secret are unchanged.  A
    table too small to make labelled findings has every candidate masked."""
    return secret_scan.redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit decreasing packing of what is left into sequences of 2048 tokens; a
    null text is the end id alone; a long one is cut into full windows first."""
    return packed(docs)


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("packing", packing),
]

#: cross-parsing, XXH64, the forest and the tokenizer have no SQL form; tests/llm holds the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
