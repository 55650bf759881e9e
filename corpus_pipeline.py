"""From raw documents to packed sequences: the stages of a corpus, each written before the next begins.

Every stage but the last returns rows of the documents with the columns it was given, whatever those are
named. Defined results: a null or empty text, or one without a letter, goes in the first stage, and so
does a text with letters of which no language reaches ``LEAST_SCORE``; where no document to learn from
has a language, there is no model and every text with a letter stays; of equal texts one row stays, and
of near copies one document; a null source is a source of its own; a null id is carried along, and sorts
last where the smallest id stays; texts of any length are read whole; every stage makes an empty table
of an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cashloom.llm.exact_dedup import unique_documents
from cashloom.llm.language_id import UNKNOWN, held_out, identified, trained
from cashloom.llm.mixing import copied, mixed
from cashloom.llm.packing import packed, token_pieces, tokenizer_file
from cashloom.llm.simhash import distinct_documents
from cashloom.llm.storage import new_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A document stays if one language has at least this probability.
LEAST_SCORE = 0.4


#: Names that the operators give to columns of their own.
LANGUAGE_NAMES, MIXING_NAMES = ("lang_pred", "score", "language_text"), ("mix",)


def _aside(docs: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """``docs`` with the columns of these names under others."""
    return docs.withColumnsRenamed({n: f"__given_{n}" for n in names})


def _back(docs: DataFrame, names: tuple[str, ...]) -> DataFrame:
    return docs.withColumnsRenamed({f"__given_{n}": n for n in names})


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in a language that the model knows; learned from those not held out.

    Without a label to learn from, the documents with a letter.
    """
    model = trained(docs.where(~held_out(F.col("doc_id"))))
    if model.network is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = identified(_aside(docs, LANGUAGE_NAMES), model)
    kept = found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return _back(kept.drop(*LANGUAGE_NAMES), LANGUAGE_NAMES)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return unique_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints that links of three bits or fewer connect."""
    return distinct_documents(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of every source as often as its target asks."""
    return _back(copied(mixed(_aside(docs, MIXING_NAMES))), MIXING_NAMES)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where the pieces of all documents lie in the sequences."""
    pieces = token_pieces(docs, tokenizer_file())
    return packed(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: A trained network and a packing search are not SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents below ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
