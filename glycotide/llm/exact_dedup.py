"""Exact deduplication against a persistent digest index, with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glycotide.llm.shared import fresh, join_by_count, parts, require, shared_dir, text_or_empty, written


class DigestIndex:
    """SHA-256 digests of all texts seen so far, in a table that is bucketed and sorted by digest.

    ``add`` brings a batch: its distinct digests are kept from the index by a sort-merge anti-join and those left are
    appended. ``resolve`` gives each row of a batch the row that stays for its text. Within one batch the largest id
    stays; a text that an earlier batch brought keeps that batch's id. A null text counts as empty; repeated
    (id, text) rows count as rows of one group; an empty batch adds nothing. Texts that only rows without an id have get
    no entry, so that a later batch's row with an id can stay for them. Other columns of the batch are ignored.

    A table that exists is appended to where it is, with the buckets that it has, whichever object or session made it.
    """

    SCHEMA = "digest binary, keep_id long, batch long"

    def __init__(self, spark: SparkSession, table: str, buckets: int | None = None):
        self.spark, self.table, self.buckets = spark, table, buckets or max(8, parts(spark))
        if self.exists():
            about = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
            self.buckets = int(about["Num Buckets"])

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.table)

    def read(self) -> DataFrame:
        return self.spark.table(self.table) if self.exists() else self.spark.createDataFrame([], self.SCHEMA)

    @staticmethod
    def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        require(docs, id_col, text_col)
        return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.sha2(text_or_empty(text_col), 256)).alias("digest"))

    def add(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batch: int = 0) -> DataFrame:
        """Appends the batch's new texts; returns digest, batch_keep_id and group_size of all the batch's texts."""
        groups = written(
            self.digests(docs, id_col, text_col).groupBy("digest").agg(F.max("doc_id").alias("batch_keep_id"), F.count("*").alias("group_size")), "digests"
        )
        new = groups.filter("batch_keep_id is not null").hint("merge").join(self.read().select("digest"), "digest", "left_anti")
        new = new.select("digest", F.col("batch_keep_id").alias("keep_id"), F.lit(batch).cast("long").alias("batch"))
        if self.exists():
            written(new, "new-digests").repartition(self.buckets, "digest").write.insertInto(self.table)
        else:
            (
                new.repartition(self.buckets, "digest")
                .write.format("parquet").bucketBy(self.buckets, "digest").sortBy("digest")
                .option("path", shared_dir(self.spark, "digest-index")).saveAsTable(self.table)
            )
        return groups

    def resolve(self, docs: DataFrame, groups: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """doc_id, digest, keep_id, group_size (rows of the batch with that text) of each row."""
        table = groups.select("digest", "group_size").join(self.read().select("digest", "keep_id").hint("merge"), "digest", "left")
        table = table.select("digest", "keep_id", "group_size")
        return join_by_count(self.digests(docs, id_col, text_col), table, "digest", "group_size", docs.count(), "doc_id")


def exact_dedup(docs: DataFrame, table: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Adds ``docs`` to the index ``table``; doc_id, keep_id, group_size, kept, text_sha256 of each row.

    Kept is the row that its text's index entry names; of rows that repeat an id and a text, all are kept. Rows without an
    id are not kept; their keep_id is null if no row with an id has their text.
    """
    index = DigestIndex(docs.sparkSession, table)
    groups = index.add(docs, id_col, text_col)
    return index.resolve(docs, groups, id_col, text_col).select(
        "doc_id", "keep_id", "group_size", F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def without_copies(docs: DataFrame, table: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that stay: one of equal texts. Rows that repeat an id and a text leave one, too.

    Rows without an id are left out.
    """
    id_, sha, digest = fresh(docs, "_id", "_sha", "_digest")
    kept = exact_dedup(docs, table, id_col, text_col).filter("kept").select(F.col("doc_id").alias(id_), F.unhex("text_sha256").alias(sha)).distinct()
    rows = docs.withColumn(digest, F.unhex(F.sha2(text_or_empty(text_col), 256)))
    # copies of a hot text differ in their ids, and so in the join's key
    joined = rows.join(kept.hint("merge"), (F.col(id_col).cast("long") == F.col(id_)) & (F.col(digest) == F.col(sha)), "left_semi")
    return joined.dropDuplicates([id_col, digest]).drop(digest)
