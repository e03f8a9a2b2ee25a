"""The operators as stages of a pipeline over documents (doc_id, text, source, and whatever else comes along).

Every stage takes (spark, docs, sf_dir). All but the last return the columns of
their input; rows that a stage rejects are gone, texts that it changes are
changed. Null texts, ids and sources pass as the operators define it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlift.llm.decontamination import contamination
from adlift.llm.frames import written
from adlift.llm.mixing import mix
from adlift.llm.near_dup import near_duplicates
from adlift.llm.quality_rules import fails, ledger
from adlift.llm.substring_dedup import remove_repeats

POLICY = "full-1"
SHINGLE = 5


def _columns(df: DataFrame) -> list[str]:
    return [f"`{c}`" for c in df.columns]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of the policy rejects."""
    judged = ledger(docs, out="_ledger_of_quality")
    return judged.where(~fails(F.col("_ledger_of_quality.failures"), POLICY)).select(*_columns(docs))


def near_dup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates by shingles of five words: the one with the smallest id.

    Groups are of texts, whatever the ids: unlike texts of one id all stay, of
    copies without an id one does. Rows without an id come last in a group.
    """
    row = "_row_of_near_dup"
    # The numbers are written once: the operator and the filter must see the same.
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered-rows", compression="zstd")
    found = near_duplicates(numbered, shingle=SHINGLE, doc_id=row).select(F.col("doc_id").alias("_no"), "component_id")
    ids = numbered.select(F.col(row).alias("_own"), F.col("doc_id").cast("long").alias("_id"))
    grouped = found.join(ids, F.col("_no") == F.col("_own")).groupBy("component_id")
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_no"))
    kept = grouped.agg(first.alias("first")).select(F.col("first._no").alias("_kept"))
    return numbered.join(kept, F.col(row) == F.col("_kept"), "left_semi").select(*_columns(docs))


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that occurred before; ``n_chars``, if there, counts what is left."""
    others = [c for c in docs.columns if c != "text"]
    marked = docs.withColumn("_no_text", F.col("text").isNull())
    left = remove_repeats(marked, carry=[*others, "_no_text"])
    text = F.when(~F.col("row._no_text"), F.col("kept"))
    made = {"text": text.alias("text"), "n_chars": F.length(text).cast("long").alias("n_chars")}
    return left.select(*[made.get(c, F.col(f"row.`{c}`").alias(c)) for c in docs.columns])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the benchmark makes up less than a twentieth."""
    judged = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    bad = judged.where("contaminated").select(F.col("doc_id").alias("_bad_id"), F.col("text_key").alias("_bad_text"))
    same = docs.doc_id.cast("long").eqNullSafe(F.col("_bad_id")) & (F.xxhash64(docs.text) == F.col("_bad_text"))
    return docs.join(bad.distinct(), same, "left_anti")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of every document the mix of sources takes."""
    return mix(docs)[0]
