"""From raw documents to packed training sequences: five stages, each on all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from estate.llm import curriculum, ppm_language, slack_packing, substring_dedup, superminhash
from estate.llm.queries import PACKING_TOKENIZER, tokenizer_path
from estate.operators.ordering import number_rows
from estate.session import durable, new_location

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: below this share the language of a text is taken as not known
MIN_SCORE = 0.5
#: words of a shingle; op7 has two by its own contract
SHINGLE = 5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without letters and texts whose language is not clear go."""
    found = ppm_language.identify(docs.select(*COLUMNS))
    return found.filter((F.col("lang_pred") != ppm_language.UNKNOWN) & (F.col("score") >= MIN_SCORE)).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the text of the smallest id stays, in one row.

    Every distinct text of an id is a document of its own, and so is every distinct text without an id; those come last.
    Only ids and hashes are sorted to number them; the texts follow by a join on both, whose partitioning the grouping has made.
    """
    rest = [c for c in COLUMNS if c != "doc_id"]
    hashed = docs.select(*COLUMNS, F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("_hash"), F.col("text").isNull().alias("_none"))
    narrow = durable(hashed.select("doc_id", "_hash", "_none").distinct())
    numbered = number_rows(narrow, [F.col("doc_id").asc_nulls_last(), "_hash", "_none"], ordinal="_id")
    side = numbered.select(F.col("doc_id").alias("_d"), F.col("_hash").alias("_h"), F.col("_none").alias("_n"), "_id")
    one = hashed.groupBy("doc_id", "_hash", "_none").agg(F.min(F.struct(*rest)).alias("_row"))
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_hash") == F.col("_h")) & (F.col("_none") == F.col("_n"))
    rows = durable(one.join(side, same).select("doc_id", "_row.*", "_id"))
    kept = superminhash.near_duplicates(rows, shingle=SHINGLE, id_column="_id").filter("kept").select(F.col("doc_id").alias("_id"))
    return rows.join(kept, "_id", "left_semi").select(*COLUMNS)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut out; a document of which nothing is left goes, others that lose nothing stay as they are."""
    left = substring_dedup.remove_repeats(docs.select(*COLUMNS))
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    kept = left.filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    return kept.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("kept_text").cast("bigint")).otherwise(F.col("n_chars"))).select(
        *[text.alias(c) if c == "text" else c for c in COLUMNS]
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out to meet the weights, in training order."""
    return curriculum.mix(docs.select(*COLUMNS)).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences in training order, which is the order of the rows that the stage before has written; none holds a copy twice."""
    file, row = row_order(docs)
    keyed = docs.select(F.struct("doc_id", file.alias("file"), row.alias("row")).alias("_row"), "text")
    pieces = slack_packing.token_pieces(keyed, tokenizer_path(PACKING_TOKENIZER), id_column="_row")
    others = [c for c in pieces.columns if c != "doc_id"]
    ordered = pieces.select("doc_id.doc_id", *others, F.col("doc_id.file").alias("_file"), F.col("doc_id.row").alias("_at"))
    return slack_packing.pack_in_order(ordered, ["_file", "_at"]).drop("_file", "_at")


def row_order(docs: DataFrame) -> tuple[Column, Column]:
    """The place of a row: its file and place in it, as a global sort has written them, or its place in a table that is no file."""
    if docs.inputFiles():
        return F.col("_metadata.file_name"), F.col("_metadata.row_index")
    return F.lit(""), F.monotonically_increasing_id()


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("identify_language", identify_language),
    ("drop_near_duplicates", drop_near_duplicates),
    ("drop_repeated_passages", drop_repeated_passages),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: models and tokenizers decide the rows: tests/llm/test_pipeline.py holds stages and run against brute force or the operators instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet in the shared folder and read again by the next.

    Null and empty texts go with the first stage, which knows no language of them; repeated rows go with the second; a null id is kept
    as it is; other columns are dropped; an empty table gives an empty result.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            location = new_location(spark, name)
            docs.write.parquet(location)
            docs = spark.read.parquet(location)
    return docs
