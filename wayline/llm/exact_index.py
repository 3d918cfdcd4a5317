"""Exact dedup against a persistent digest index, bucketed and sorted by digest.

New documents are reduced to one row per digest, anti-joined by sort-merge with the index
and appended to it, one file per bucket. A run that is repeated finds its own digests and
appends nothing, so losing a job half-way costs a rerun and no rows.

Defined cases: null text counts as empty; a null id never wins over another; of rows
repeated in id and text one is kept; empty tables give empty results; other columns are
passed through by :func:`dedup` and ignored elsewhere.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wayline.llm.text import narrow
from wayline.scratch import shared_folder, stored

# A digest with more than this share of all rows is joined by broadcast: there are at
# most as many such digests as the share goes into one.
HOT_SHARE = 1000


def digest():
    return F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))


@dataclass(frozen=True)
class DigestIndex:
    """A table ``digest, keep_id, group_size``, one row per digest ever seen."""

    spark: SparkSession
    table: str
    path: str
    buckets: int = 16

    def open(self) -> DigestIndex:
        """Register the table over its folder, which may be new or hold earlier digests."""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{self.table}` (digest BINARY, keep_id BIGINT, group_size BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )
        return self

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, groups: DataFrame) -> None:
        """Add the digests not yet there; the largest id of a group stays."""
        fresh = groups.join(self.rows().select("digest").hint("merge"), "digest", "left_anti")
        (
            fresh.select("digest", "keep_id", "group_size").repartition(self.buckets, "digest")
            .write.format("parquet").bucketBy(self.buckets, "digest").sortBy("digest").mode("append").saveAsTable(self.table)
        )
        self.spark.catalog.refreshTable(self.table)


def new_index(spark: SparkSession, name: str = "digests", buckets: int | None = None) -> DigestIndex:
    """An empty index in the shared folder."""
    run = uuid.uuid4().hex
    buckets = buckets or max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return DigestIndex(spark, f"{name}_{run}", shared_folder(spark, f"{name}/{run}"), buckets).open()


def document_digests(docs: DataFrame) -> DataFrame:
    """``doc_id, digest`` of every row, written once to the shared folder."""
    return stored(narrow(docs, "doc_id", "text").select("doc_id", digest().alias("digest")), "digest_rows")


def decisions(digests: DataFrame, index: DigestIndex) -> DataFrame:
    """Add new digests to the index, then tell for every row which row stays.

    Groups holding more than a thousandth of the rows, of which there are fewer than a
    thousand, join by broadcast; all others by sort-merge on the index's buckets.
    """
    groups = digests.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = stored(groups, "digest_groups")
    index.append(groups)
    hot_size = max(1000, digests.count() // HOT_SHARE)
    hot = groups.where(F.col("group_size") > hot_size).select("digest")
    known = index.rows()
    hot_rows = known.join(F.broadcast(hot), "digest", "left_semi").select(
        F.col("digest").alias("hot_digest"), F.col("keep_id").alias("hot_keep"), F.col("group_size").alias("hot_group")
    )
    marked = digests.join(F.broadcast(hot_rows), F.col("digest") == F.col("hot_digest"), "left")
    common = marked.where(F.col("hot_digest").isNotNull()).select(
        "doc_id", "digest", F.col("hot_keep").alias("keep_id"), F.col("hot_group").alias("group_size")
    )
    rare = marked.where(F.col("hot_digest").isNull()).select("doc_id", "digest").join(known.hint("merge"), "digest")
    found = common.unionByName(rare.select("doc_id", "digest", "keep_id", "group_size"))
    copy = F.row_number().over(Window.partitionBy("digest", "doc_id").orderBy("group_size"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")) & (copy == 1))


def dedup_report(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """One row per document: the id that stays, the size of its group, whether it is kept."""
    index = index or new_index(docs.sparkSession)
    rows = decisions(document_digests(docs), index)
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def dedup(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """The kept documents, with the columns of ``docs``."""
    index = index or new_index(docs.sparkSession)
    kept = decisions(document_digests(docs), index).where("kept").select(
        F.col("doc_id").alias("_doc"), F.col("digest").alias("_kept")
    )
    rows = docs.withColumn("_digest", digest())
    same = (F.col("_digest") == F.col("_kept")) & F.col("doc_id").eqNullSafe(F.col("_doc"))
    extra = [c for c in ("source", "lang") if c in docs.columns]
    one = F.row_number().over(Window.partitionBy("_digest", "doc_id").orderBy(*(extra or ["doc_id"])))
    found = rows.join(kept.hint("merge"), same, "left_semi").withColumn("_copy", one).where("_copy = 1")
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])
