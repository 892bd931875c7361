"""The registered queries of this subpackage: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import functions as F

from . import oracles
from .common import table

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {"op1_lm_score": oracles.OP1, "op4_line_quality": oracles.OP4,
                           "op10_decontaminate": oracles.OP10, "op11_conv_trie": oracles.OP11,
                           "op12_merkle": oracles.OP12, "op13_ann": oracles.OP13}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_lm_score(spark, sf_dir):
    """Stupid-backoff score of all documents; counts over all documents."""
    from .lm_score import score

    out = score(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", F.round("log_score", 4).alias("log_score"),
                      F.round("mean_log_score", 6).alias("mean_log_score"))


@query
def op2_language_id(spark, sf_dir):
    """Language of all documents by cross-parsing entropy."""
    from .lang_id import identify

    return identify(table(spark, sf_dir, "documents"))


@query
def op3_secrets(spark, sf_dir):
    """Secret candidates of all documents with the forest's verdict."""
    from .secret_scan import find_secrets

    out = find_secrets(table(spark, sf_dir, "documents"))
    return out.withColumn("probability", F.round("probability", 6))


@query
def op4_line_quality(spark, sf_dir):
    """Base counts, cross-document line frequency and verdict of all documents."""
    from .line_quality import judge

    return judge(table(spark, sf_dir, "documents"))


def packed(docs):
    """``docs`` packed with the production parameters, without the ids."""
    import public_tokenizers

    from .packing import PIECE_SCHEMA, pack_documents
    from .tokens import WORD_END

    out = pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), WORD_END, 1, with_ids=False)
    return out.select(*(c.split()[0] for c in PIECE_SCHEMA.split(", ")), "sequence_id", "offset")


@query
def op5_packing(spark, sf_dir):
    """Best-fit decreasing packing of all documents into 2048-token sequences."""
    return packed(table(spark, sf_dir, "documents"))


@query
def op6_licenses(spark, sf_dir):
    """Licence sentences and licences of all documents."""
    from .licenses import scan

    out = scan(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "status", F.array_join("licenses", ",").alias("licenses"),
                      F.to_json("found").alias("found"))


@query
def op7_token_files(spark, sf_dir):
    """Token-id files of all documents, written and read back."""
    import public_tokenizers

    from ..session import new_path
    from .token_files import read_token_files, write_token_files
    from .tokens import BYTE_LEVEL

    path = new_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"),
                      BYTE_LEVEL, 2)
    return read_token_files(spark, path)


@query
def op8_simhash(spark, sf_dir):
    """Fingerprint and near-duplicate component of all documents."""
    from .simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op9_quality(spark, sf_dir):
    """Quality score of all documents by a linear-chain CRF over lines."""
    from .crf_quality import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_decontaminate(spark, sf_dir):
    """Benchmark contamination of all documents by winnowing."""
    from .decontaminate import find_hits

    return find_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("hits")


@query
def op11_conv_trie(spark, sf_dir):
    """Prefix trie of all rebuilt conversations."""
    from .conv_trie import prefix_trie

    return prefix_trie(table(spark, sf_dir, "conversations"))


@query
def op12_merkle(spark, sf_dir):
    """Merkle manifest of all documents, with the versions of tampered leaves checked."""
    from .merkle import manifest

    return manifest(table(spark, sf_dir, "documents"), with_nodes=False)


@query
def op13_ann(spark, sf_dir):
    """The 20 nearest of all vectors for each whose id is divisible by 20."""
    from .ann import search

    return search(table(spark, sf_dir, "embeddings"))
