"""Exact deduplication over keyed streaming state (operator 1, native).

The rows are written once with the SHA-256 digest of their normalised text
and a stable row number.  A Structured Streaming aggregation reads that table
in micro-batches; its RocksDB state, which never expires, retains per digest
the smallest identifier, the locator (row number) of that row's content and
the number of rows.  The state is then read as a table.  Digests seen more
than once are hits: their full texts are compared (grouped by the bytes
themselves, copies fold map-side), and should two texts share a digest, the
texts decide instead of the digest.

DataFrame functions only: no Python on the executors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwise.llm.common import ASCII_SPACE, fresh, stored, text_or_empty
from cellwise.session import scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Files that one micro-batch reads; state carries over between batches.
FILES_PER_BATCH = 20_000
#: Parts over which the rows of a repeated digest are dealt for the byte check.
SALTS = 16


def normalised(col: str = "text") -> Column:
    """Every run of ASCII white space as one space; null counts as empty."""
    return F.regexp_replace(text_or_empty(col), ASCII_SPACE, " ")


def sha256(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def digest_state(spark: SparkSession, rows_path: str, schema, digest: str, first: Column,
                 files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """(digest, first = (no id, id, row), n) per digest, from the state that a
    streaming run over the Parquet files under ``rows_path`` leaves; only the
    columns that ``digest`` and ``first`` need are read.

    The run is incremental: started again on the same checkpoint it reads
    only new files.  Without any file the state is empty.
    """
    # A session of its own keeps the caller's state-store setting untouched.
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    # Many small stores: no disk set aside in advance for each one's logs.
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    # A state row is a hundred bytes a text, so fewer partitions do than for texts.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    session.conf.set("spark.sql.shuffle.partitions", str(max(1, parts // 4)))
    place = scratch_path(spark, "dedup_state")
    seen = (session.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
            .parquet(rows_path)
            .select(F.col(digest).alias("digest"), first.alias("first"))
            .groupBy("digest")
            .agg(F.min("first").alias("first"), F.count(F.lit(1)).alias("n")))
    run = (seen.writeStream.format("noop").outputMode("update")
           .option("checkpointLocation", place).trigger(availableNow=True).start())
    run.awaitTermination()
    if run.lastProgress is None:
        return spark.createDataFrame([], "digest string, first struct<no_id:boolean,id:bigint,row:bigint>, n long")
    state = spark.read.format("statestore").load(place)
    return state.select(F.col("key.digest").alias("digest"), F.col("value.*")).toDF("digest", "first", "n")


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     digest: Callable[[Column], Column] = sha256,
                     files_per_batch: int = FILES_PER_BATCH) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with four more columns, and their names by role:
    ``digest``, ``keep_id``, ``group_size`` and ``kept``.

    Of rows with equal normalised text the one with the smallest id is kept
    (null ids come last; of rows that also share the id, one is kept).  Null
    text counts as empty.  An empty table gives an empty result.  Columns of
    ``docs`` with clashing names are left alone.
    """
    spark = docs.sparkSession
    names = {}
    out = docs
    for role in ("digest", "row", "first", "keep_id", "group_size", "kept"):
        names[role] = fresh(out, role)
        out = out.withColumn(names[role], F.lit(None))
    d, r = names["digest"], names["row"]
    rows_path = scratch_path(spark, "dedup_rows")
    norm = normalised(text_col)
    numbered = docs.withColumn(d, digest(norm)).withColumn(r, F.monotonically_increasing_id())
    numbered.write.parquet(rows_path)
    numbered = spark.read.schema(numbered.schema).parquet(rows_path)
    first = F.struct(F.col(f"`{id_col}`").isNull().alias("no_id"),
                     F.col(f"`{id_col}`").cast("long").alias("id"), F.col(r).alias("row"))
    # The stream reads a part of the columns.
    narrow = numbered.select(*dict.fromkeys([d, id_col, r])).schema
    state = digest_state(spark, rows_path, narrow, d, first, files_per_batch)

    # Full bytes of every hit.  Copies fold before the shuffle, so a text that
    # a third of all rows share is a few rows per task.
    # The join is salted too: each repeated digest meets its rows in SALTS parts.
    salt = names["group_size"]
    repeated = state.where("n > 1").select(
        F.col("digest").alias(d), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias(salt))
    hits = (numbered.withColumn(salt, F.pmod(F.col(r), F.lit(SALTS)).cast("int"))
            .join(repeated, [d, salt], "left_semi")
            .groupBy(d, norm.alias("_norm"))
            .agg(F.min(first).alias("_first"), F.count(F.lit(1)).alias("_n")))
    clash = stored(hits.groupBy(d).agg(F.count(F.lit(1)).alias("_variants"))
                   .where("_variants > 1").select(d), "dedup_clash")
    by_digest = state.select(F.col("digest").alias(d), F.col("first").alias(names["first"]),
                             F.col("n").alias(names["group_size"]))
    if clash.isEmpty():
        found = numbered.join(by_digest, d, "left")
    else:
        f, n = names["first"], names["group_size"]
        same = (numbered.join(clash, d, "left_semi").withColumn("_norm", norm)
                .join(hits.join(clash, d, "left_semi")
                      .select(d, "_norm", F.col("_first").alias(f), F.col("_n").alias(n)),
                      [d, "_norm"], "left").drop("_norm"))
        cols = [*numbered.columns, f, n]
        found = (numbered.join(clash, d, "left_anti").join(by_digest, d, "left").select(*cols)
                 .unionByName(same.select(*cols)))
    found = (found.withColumn(names["keep_id"], F.col(names["first"])["id"])
             .withColumn(names["kept"], F.col(names["first"])["row"] == F.col(r)))
    keep = ("digest", "keep_id", "group_size", "kept")
    return (found.select(*docs.columns, *[names[k] for k in keep]), {k: names[k] for k in keep})


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, columns unchanged."""
    found, name = duplicate_groups(docs, id_col, text_col)
    return found.where(F.col(name["kept"])).select(*docs.columns)


def duplicate_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    found, name = duplicate_groups(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    return found.select("doc_id", F.col(name["keep_id"]).alias("keep_id"),
                        F.col(name["group_size"]).alias("group_size"),
                        F.col(name["kept"]).alias("kept"), F.col(name["digest"]).alias("text_sha256"))
