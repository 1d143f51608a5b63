"""A corpus pipeline of five stages over documents; each calls an operator of skein.llm.

Stages take (spark, docs, sf_dir) and return a DataFrame; run() writes each result as Parquet into the shared folder and
reads it again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.bpe import encode_texts
from skein.llm.common import read, written
from skein.llm.decontaminate import contaminated
from skein.llm.exact import exact_duplicates
from skein.llm.langid import UNKNOWN, fit, held_out, identify, learning_rows
from skein.llm.simhash import near_duplicates

#: Least share of a document's letters that the predicted language must have; UNKNOWN documents go as well.
LEAST_SHARE = 0.3


def _kept(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of docs whose id is in ids (column keep); a null id is matched too."""
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["keep"]), "left_semi")


def _free(name: str, docs: DataFrame) -> str:
    """A column name that docs doesn't have."""
    while name in docs.columns:
        name = f"{name} of stage"
    return name


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose text is null or has no letter, or in which no language prevails. Repeated rows and null ids
    are judged by their texts like any other; an empty table, and one without labels, gives no rows."""
    model = fit(learning_rows(docs, "doc_id", "text", "lang", ~held_out("doc_id")))
    own = {c: _free(f"{c} of docs", docs) for c in ("lang_pred", "score") if c in docs.columns}
    judged = identify(docs.withColumnsRenamed(own), model).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SHARE))
    return judged.drop("lang_pred", "score").withColumnsRenamed({v: k for k, v in own.items()})


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of equal texts, a null one first; null texts count as empty. Rows that repeat both id
    and text collapse into one of them; an empty table gives no rows."""
    name = _free("sha of text", docs)
    keep = exact_duplicates(docs).where("kept").select(F.col("doc_id").alias("keep"), "text_sha256")
    sha = F.sha2(F.encode(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "), "UTF-8"), 256)
    rows = docs.withColumn(name, sha)
    rows = rows.join(keep, rows["doc_id"].eqNullSafe(keep["keep"]) & (rows[name] == keep["text_sha256"]), "left_semi")
    return rows.dropDuplicates(["doc_id", name]).select(docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each component of near duplicates. Null, empty and blank texts are near each other;
    all rows of a kept id stay, and a component of null ids alone stays; an empty table gives no rows."""
    keep = near_duplicates(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("keep"))
    return _kept(docs, keep)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item, with all rows of their ids. Null and empty texts hold nothing; without a
    benchmark all rows stay; an empty table gives no rows."""
    bad = contaminated(docs, read(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("bad")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["bad"]), "left_anti")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, ids, n_tokens): the documents as token ids, which are decoded again: a text that they don't
    give back is an error. A null text has no ids; repeated rows and null ids stay; an empty table gives no rows."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = encode_texts(docs.select("doc_id", "lang", "source", "text"), path, public_tokenizers.PATTERN, verify=True)
    return ids.select("doc_id", "lang", "source", "ids", F.size("ids").cast("bigint").alias("n_tokens"))


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", simhash_dedup),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE", tokens),
]

#: No stage but exact dedup can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage{i}")
    return docs
