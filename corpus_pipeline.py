"""From documents to packed training sequences.

STAGES are applied in order; each takes what the one before kept, as written
and read again. All but the last return the columns of documents. Each stage
has the defined results of its operator for null, empty, long and repeated
texts; columns beyond those it reads pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commerce_lake.llm import decontam, neardup, packing, quality, secret_scan
from commerce_lake.llm.common import unused, written
from commerce_lake.llm.queries import tokenizer_path

SECRET_MARK = "[secret]"


def _without(docs: DataFrame, key: Column, dropped: DataFrame, name: str) -> DataFrame:
    """Documents but those whose key is in the one column of `dropped`."""
    gone = unused(docs, "_gone")
    keys = written(dropped.toDF(gone).distinct(), name)
    return docs.join(keys, key == F.col(gone), "left_anti")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail the base rules or lie beyond the fences of
    their language and source. Texts are measured twice, for the sketches and
    for the verdicts, which moves and stores none of them."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text", "lang", "source")
    fences = quality.fences(quality.measured(rows.drop("row"), drop_text=True))
    return quality.judge(quality.measured(rows, drop_text=True), fences).filter("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of copies and near-copies (five-word
    shingles, similarity of 0.8 or more): that of the smallest doc_id, rows
    without one last. Rows are numbered, so that those of one id, or of none,
    are judged each; the numbers are written, for a later scan might give others."""
    row = unused(docs, "_row")
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = neardup.link(numbered.select(F.col(row).alias("row"), "text"), key="row")
    copies = written(found.filter("NOT kept").select("row", "component_id"), "copies")
    members = copies.union(copies.select("component_id", "component_id").distinct())
    ids = numbered.select(F.col(row).alias("row"), "doc_id")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row")).alias("first")
    firsts = members.join(ids, "row").groupBy("component_id").agg(first).select("first.row")
    dropped = members.select("row").join(firsts, "row", "left_anti")
    return _without(numbered, F.col(row), dropped, "dropped").select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item. Rows are told
    apart by id and text, so that rows of one id, or of none, are judged each."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    row = F.struct(F.col("doc_id"), F.xxhash64("text").alias("hash"))
    found = decontam.find(docs.select(row.alias("row"), "text"), benchmark.select("item_id", "text"), key="row")
    return _without(docs, row, found.filter("n_hit > 0").select("row"), "leaked")


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in texts by a mark; n_chars follows the new text."""
    spans = unused(docs, "spans")
    found = secret_scan.find(docs, spans=spans)
    text = secret_scan.redacted(F.col("text"), F.col(spans), SECRET_MARK)
    changed = found.withColumn("text", text)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        changed = changed.withColumn("n_chars", F.when(F.size(spans) > 0, length).otherwise(F.col("n_chars")))
    return changed.select(*docs.columns)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents placed in sequences, with their token ids."""
    return packing.place(docs.select("doc_id", "lang", "source", "text"), tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_redaction", secret_redaction),
    ("packed_sequences", packed_sequences),
]

#: Near-copies are linked transitively and tokens come from a vocabulary file, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents; what each returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
