"""From raw documents to a training mix: five stages, each a table in and a table out.

language ID drops what is in no known language; line dedup removes lines that many
documents share; the n-gram join keeps one document of each group of near copies;
decontamination drops documents with copies of test items; mixing takes documents by
source weights. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewise.llm import decontamination, language, lines, mixing, ngram_join
from framewise.session import cut_lineage
from framewise.sources.tables import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document is rejected when no language is at least this likely, or when it has no letter.
LEAST_LANGUAGE_SCORE = 0.5
#: Lines found in at least so many documents go.
LINE_DOCUMENTS = 10


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the documents' own labels, but for the held-out fold. Documents that are NULL or have no
    letter go, and those of no likely language; if there are no labels to learn from, all others stay."""
    model = language.train(docs.where(~language.held_out(F.col("doc_id"))))
    if not model.languages:
        return docs.select(*COLUMNS).where(F.col("text").rlike(r"\p{L}"))
    said = language.predict(docs.select(*COLUMNS), model)
    return said.where((F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE_SCORE)).select(*COLUMNS)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that lose no line stay as they are; the others get their new length. A text that loses all
    its lines is empty, but its document stays."""
    done = lines.drop_common_lines(None, docs, min_docs=LINE_DOCUMENTS, keep=COLUMNS)
    lost = F.size("kept") < F.size("lines")
    text = F.when(lost, F.array_join("kept", "\n")).otherwise(F.col("text"))
    return (done.withColumns({"text": text, "n_chars": F.when(lost, F.char_length(F.array_join("kept", "\n")).cast("long")).otherwise(F.col("n_chars"))})
            .select(*COLUMNS))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that of the smallest id."""
    return ngram_join.drop_near_duplicates(docs.select(*COLUMNS))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a test item go."""
    return decontamination.drop_leaks(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark", ["item_id", "text"]))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each copy that the mix takes, with its number ``copy`` and what it was drawn by."""
    return mixing.emit(mixing.mix(docs, keep=COLUMNS))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_common_lines),
    ("ngram_join", drop_near_copies),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
]

#: Trained scores and alignments have no SQL; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
