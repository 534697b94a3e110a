"""The text operators as one pipeline over `documents`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closewright.llm import bpe, dartminhash, decontaminate, langid, pii
from closewright.llm.queries import table, vocabulary
from closewright.llm.shared import written

#: A document whose best language is less likely than this is rejected, as is one without a letter. Of more than four
#: languages it must be LEAST_LIFT times as likely as by chance, which is the same for four.
LEAST_SCORE, LEAST_LIFT = 0.3, 1.2


#: A benchmark item of fewer words, found as an exact run only, rejects no document.
LEAST_WORDS = 4


def least_score(n_labels: int) -> float:
    """The least probability of the best of so many languages."""
    return min(LEAST_SCORE, LEAST_LIFT / max(1, n_labels))


def free_name(docs: DataFrame, name: str) -> str:
    """The name, or one like it that no column has in any spelling."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in a language that the network, trained on these documents' labels, recognises.

    Null and empty texts, and texts without a letter, go; repeated rows go or stay together; ties of languages go to the
    first label; columns of any name are kept as they are.
    """
    net = langid.train(docs)
    lang, score = free_name(docs, "lang_found"), free_name(docs, "lang_score")
    found = langid.predict(docs, net, prediction=lang, score=score)
    kept = found.filter((F.col(lang) != langid.UNKNOWN) & (F.col(score) >= least_score(len(net.labels))))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: that of the smallest id, then of the smallest text hash; of repeated rows one stays."""
    return dartminhash.one_of_each(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item. Null and empty texts hold none; repeated rows go or stay together.

    Items of fewer than LEAST_WORDS words, which any text may hold, reject no document.
    """
    found = decontaminate.leaks(docs, table(spark, sf_dir, "benchmark"))
    return decontaminate.without_leaks(docs, found.filter(F.coalesce(F.col("exact_words") >= LEAST_WORDS, F.lit(True))))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced by its kind; no row goes, null and empty texts stay as they are."""
    return pii.redact(docs, pii.train(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded text of each row that is left; a null text has no token."""
    return bpe.digests(bpe.encode_documents(docs, vocabulary()))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("benchmark_free", benchmark_free), ("personal_data", without_personal_data), ("bpe", tokens)]

#: The stages train models, pass messages and run a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over `documents`; each result but the last is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
