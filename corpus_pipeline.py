"""From raw documents to packed sequences: five stages, each written as Parquet and read again.

ORACLE_SQL is None: learned, hashed and tokenized stages have no SQL; tests hold run() against plain versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm import language, mixing, neardup, packing, substrings
from corpusflow.llm.common import collected, drop_saved, packed, save, table

ORACLE_SQL = None
#: The helper tables of the stage that ran last, with its place in the pipeline.
_last: tuple[int, list[str]] = (-1, [])
_places: dict[str, int] = {}


def _stage(function):
    """A stage's helper tables go when the stage after it starts, as its result is then written. Those of a last
    stage stay, as its result may not have been read yet."""
    place = _places[function.__name__] = len(_places)

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        global _last
        if _last[0] == place - 1:
            drop_saved(spark, _last[1])
        with collected() as paths:
            out = function(docs)
        _last = (place, paths)
        return out

    run_stage.__name__, run_stage.__doc__ = function.__name__, function.__doc__
    return run_stage


@_stage
def language_id(docs: DataFrame) -> DataFrame:
    """Predict each text's language; all columns are handed on, whatever their names; texts that are in none (`und`) go: null, empty and letterless ones. Repeated rows
    are judged alike and all kept or gone; null langs are not learned from; very long texts are scored whole."""
    model = language.train(docs.where(~language.held_out(F.col("doc_id"))))
    marked = language.predict(docs.select("text", packed(docs)), model)
    return marked.where("lang_pred != 'und'").select("row.*")


@_stage
def minhash_near_dedup(docs: DataFrame) -> DataFrame:
    """Keep one document of each class of near-duplicates, the one of the smallest doc_id (ties: the smallest digest, then
    one of the equal rows). Rows with a null doc_id, a null text or no words are no class's and all stay."""
    return neardup.keep_one(docs)


@_stage
def substring_dedup(docs: DataFrame) -> DataFrame:
    """Cut passages that start earlier in the corpus (ties of doc_id: by place); documents that lose all their words go,
    as do null and empty ones. Texts that lose nothing keep their white space."""
    others = packed(docs, without=("doc_id", "text"))
    cut = substrings.remove_repeats(docs.select("doc_id", "text", others), as_is=True).where("n_words > n_removed")
    return cut.select("doc_id", "text", "row.*").withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


@_stage
def mix_sources(docs: DataFrame) -> DataFrame:
    """Repeat and cut documents so that each source reaches its target. A null source is one of its own, null and empty
    texts have size 0 and go, and repeated rows take a share each."""
    return mixing.mix(docs)


@_stage
def best_fit_packing(docs: DataFrame) -> DataFrame:
    """Pack the token pieces of all documents; null and empty texts are the end token, repeated rows are packed each."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("minhash_near_dedup", minhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("mix_sources", mix_sources),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
