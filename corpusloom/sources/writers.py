"""Writers for records, vectors, vocabularies, example shards and co-occurrence shards."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import RECORD_SEPARATOR
from corpusloom.plans.ranking import with_hash_order


def _write_column(df: DataFrame, value: Column, path: str, mode: str) -> None:
    df.select(value.alias("value")).write.mode(mode).text(path)


def record_line(columns: list[str]) -> Column:
    return F.concat_ws(RECORD_SEPARATOR, *[F.col(c).cast("string") for c in columns])


def write_records(df: DataFrame, path: str, columns: list[str] | None = None, mode: str = "error") -> None:
    """Columns joined by the record separator, one row per line."""
    _write_column(df, record_line(columns or df.columns), path, mode)


def vector_line(key: str, vec: str, sep: str = " ") -> Column:
    return F.concat_ws(sep, F.col(key).cast("string"), F.col(vec).cast("array<string>"))


def write_vectors(
    df: DataFrame, path: str, key: str = "key", vec: str = "vec", sep: str = " ", mode: str = "error"
) -> None:
    _write_column(df, vector_line(key, vec, sep), path, mode)


def vocab_with_specials(ranked: DataFrame, specials: list[str]) -> DataFrame:
    """``token, id``: the special tokens first, then the ranked tokens moved up behind them."""
    spark = ranked.sparkSession
    first = spark.createDataFrame(list(enumerate(specials)), "id bigint, token string")
    moved = ranked.select((F.col("id") + len(specials)).alias("id"), "token")
    return first.unionByName(moved)


def write_vocab(vocab: DataFrame, path: str, mode: str = "error") -> None:
    """Tokens in the order of their ids, over sorted part files."""
    ordered = vocab.orderBy("id")
    _write_column(ordered, F.col("token"), path, mode)


FILE_ROWS = 100_000
SHARD_ROWS = 64


def write_line_shards(df: DataFrame, path: str, lines_per_file: int, column: str = "text", mode: str = "error") -> None:
    """Text files of at most ``lines_per_file`` lines."""
    df.select(F.col(column).alias("value")).write.mode(mode).option(
        "maxRecordsPerFile", lines_per_file
    ).text(path)


def _dealt(df: DataFrame, shards: int, digest: Column) -> DataFrame:
    return with_hash_order(df, digest, "_no").withColumn("shard", (F.col("_no") % shards).cast("bigint"))


def deal_examples(df: DataFrame, shards: int, digest: Column) -> DataFrame:
    """Add ``shard``: examples in the order of their digest are dealt to the shards in turn."""
    return _dealt(df, shards, digest).drop("_no")


def write_example_shards(df: DataFrame, path: str, shards: int, digest: Column, mode: str = "error") -> None:
    """One folder per shard; each task writes files of one shard, of about ``FILE_ROWS`` rows."""
    part = F.floor(F.col("_no") / (shards * FILE_ROWS))
    _dealt(df, shards, digest).repartition("shard", part).drop("_no").write.mode(mode).partitionBy("shard").parquet(path)


def cooc_shards(cells: DataFrame, shards: int) -> DataFrame:
    """Cells with their shard by modulo of row and column, and their places inside the shard."""
    def place(column: str, name: str) -> list[Column]:
        return [
            (F.col(column) % shards).cast("bigint").alias(f"{name}_shard"),
            F.floor(F.col(column) / shards).cast("bigint").alias(f"local_{name}"),
        ]

    return cells.select(*place("row_id", "row"), *place("col_id", "col"), "value")


def write_cooc_shards(cells: DataFrame, path: str, shards: int, mode: str = "error") -> None:
    """One folder per shard, its cells in files of whole blocks of rows, sorted by place.

    ``cells`` must hold each cell once. Blocks of ``SHARD_ROWS`` rows are dealt to the tasks, so their number grows with
    the matrix and not with the shards.
    """
    (
        cooc_shards(cells, shards)
        .repartition("row_shard", "col_shard", F.floor(F.col("local_row") / SHARD_ROWS))
        .sortWithinPartitions("row_shard", "col_shard", "local_row", "local_col")
        .write.mode(mode)
        .partitionBy("row_shard", "col_shard")
        .parquet(path)
    )


def shard_manifest(batches: DataFrame) -> DataFrame:
    """Per task and pass: its file names in order, and its number of batches."""
    return batches.groupBy("task", "pass_id").agg(
        F.sort_array(F.collect_set("filename")).alias("filenames"),
        F.sum("num_batch").cast("bigint").alias("num_batch"),
    )


def merge_manifests(manifests: DataFrame, num_passes: int | None = None) -> DataFrame:
    """Total batches and files of all manifests.

    With ``num_passes``, later passes are skipped, and a manifest with more files than that
    keeps the first ones and the same share of its batches.
    """
    used = manifests
    if num_passes is not None:
        files = F.size("filenames")
        kept = F.least(F.lit(num_passes), files)
        used = manifests.filter(F.col("pass_id") < num_passes).select(
            F.slice("filenames", 1, num_passes).alias("filenames"),
            F.floor(F.col("num_batch") * (kept / files)).alias("num_batch"),
        )
    return used.agg(
        F.coalesce(F.sum("num_batch"), F.lit(0)).cast("bigint").alias("num_batch"),
        F.coalesce(F.sum(F.size("filenames")), F.lit(0)).cast("bigint").alias("num_files"),
    )


def tokenized_cache(df: DataFrame, path: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Build the tokenized corpus once and read it back when it is there already.

    It lies in a folder named by the number of rows and a sum of their hashes, so another input is built
    anew.
    """
    spark = df.sparkSession
    rows, total = df.agg(F.count("*"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()
    path = os.path.join(path, f"{rows}-{total or 0}")
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(path, "_SUCCESS"))
    files = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(hadoop_path):
        build(df).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
