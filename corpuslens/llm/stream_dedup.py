"""Exact deduplication by a stateful stream.

Documents are digested where they are read; rows of digest, identifier and content locator
(file and row) feed a streaming aggregation by digest. Its state lives in RocksDB on the
executors' disks, saved to the shared folder with each micro-batch, and never expires, so a
later call with the same folder meets everything seen before. Per digest the state retains
the largest identifier, the locator of that row's content, and the number of rows.

A digest that is met again is a hit: the bytes of its rows are then compared in full with
the content that the locator names. Rows whose bytes differ, which a sound digest never
lets happen, are grouped anew by digest and full text.

Copies collapse within each task before the shuffle into the state, and the comparison is a
join that Spark can split, so a group may hold any share of the rows.

Defined results: texts are compared after lower-casing A-Z only; null is the empty text. Of
equal texts the row with the largest doc_id stays (a null one is smallest); of rows that
also share the doc_id, the one last by file and row. Other columns, whatever their names,
are ignored by ``deduplicate`` and kept by ``without_copies``. An empty table gives no row.
"""

import re
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.stored import on_file, shared_folder, stored

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MOST_BROADCAST = 100_000  # places of hits, some 200 bytes each
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # A store per partition: without this each sets tens of MB of disk aside for its log.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    # Stores of one executor share this memory, and give it back when they have committed.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "100",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def located(docs: DataFrame) -> DataFrame:
    """``(document, file, row)``: all columns of ``docs`` as one, and where they are."""
    place = docs.metadataColumn("_metadata")
    return docs.select(
        F.struct("*").alias("document"),
        place["file_path"].alias("file"),
        place["row_index"].alias("row"),
    )


def _into_state(landing: str, state: str, spark, schema) -> None:
    """Run all landed files that are new to the state through the stream, in a session of its own, so
    that its settings are nobody else's; all others are those of the caller's session."""
    settings = {k: v for k, v in spark.conf.getAll.items() if k.startswith("spark.sql.") and spark.conf.isModifiable(k)}
    spark = spark.newSession()
    for name, value in (settings | STATE_SETTINGS).items():
        spark.conf.set(name, value)
    rows = spark.readStream.schema(schema).parquet(landing)
    seen = rows.groupBy("digest").agg(
        F.max(F.struct("doc_id", "file", "row")).alias("newest"), F.count("*").alias("n")
    )
    seen.writeStream.outputMode("update").format("noop").option(
        "checkpointLocation", state
    ).trigger(availableNow=True).start().awaitTermination()


def deduplicate(
    docs: DataFrame, folder: str | None = None, digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, digest, file, row)``, one row per document of
    this and, where ``folder`` was used before, of all earlier calls.

    ``folder`` holds landed rows and state; without one, a new folder is taken. Earlier
    documents must still be where their locators say.
    """
    spark = docs.sparkSession
    folder = folder or shared_folder(spark)
    landing, state = f"{folder}/landing", f"{folder}/state"
    contents = located(on_file(docs)).select(
        F.col("document.doc_id").cast("long").alias("doc_id"),
        normalised(F.col("document.text")).alias("content"),
        "file",
        "row",
    )
    rows = contents.select("doc_id", digest(F.col("content")).alias("digest"), "file", "row")
    rows.write.mode("append").parquet(landing)
    _into_state(landing, state, spark, rows.schema)

    landed = spark.read.schema(rows.schema).parquet(landing)
    groups = _groups(spark, state)
    hits = stored(
        landed.join(groups.filter("group_size > 1"), "digest").select(
            "doc_id",
            "digest",
            "file",
            "row",
            ((F.col("file") == F.col("keep_file")) & (F.col("row") == F.col("keep_row"))).alias("stays"),
        )
    )
    return _decisions(landed, groups, stored(_differing(contents, hits)))


def _groups(spark, state: str) -> DataFrame:
    """What the state retains: ``(digest, keep_id, keep_file, keep_row, group_size)``."""
    entries = spark.read.format("statestore").load(state)
    newest, n = (F.col("value")[name] for name in entries.schema["value"].dataType.names)
    return entries.select(
        F.col("key")["digest"].alias("digest"),
        newest["doc_id"].alias("keep_id"),
        newest["file"].alias("keep_file"),
        newest["row"].alias("keep_row"),
        n.alias("group_size"),
    )


def _contents(current: DataFrame, hits: DataFrame) -> DataFrame:
    """``(file, row, content)`` of the rows of ``hits``: of this call's documents, and of earlier
    ones from the files that the locators name."""
    place = ["file", "row"]
    files = current.select("file").distinct()
    earlier = [r["file"] for r in hits.select("file").distinct().join(files, "file", "left_anti").collect()]
    found = current.select(*place, "content").join(_small(hits.select(place)), place)
    if earlier:
        old = located(current.sparkSession.read.schema("text string").parquet(*map(_path, earlier)))
        old = old.select(*place, normalised(F.col("document.text")).alias("content"))
        found = found.unionByName(old.join(_small(hits.select(place)), place))
    return found


def _path(file: str) -> str:
    """The path of a locator, which is a URL."""
    return re.sub(r"([][{}*?\\])", r"\\\1", unquote(file))


def _small(rows: DataFrame) -> DataFrame:
    """``rows``, broadcast if they are few, so that only what they match is shuffled."""
    return F.broadcast(rows) if rows.count() <= MOST_BROADCAST else rows


def _differing(current: DataFrame, hits: DataFrame) -> DataFrame:
    """Rows of hit digests whose bytes differ from those of the row that stays."""
    texts = stored(hits.join(_contents(current, hits), ["file", "row"]))
    staying = texts.filter("stays").select("digest", F.col("content").alias("_staying"))
    others = texts.filter("NOT stays").drop("stays")
    return others.join(staying, "digest").filter(F.col("content") != F.col("_staying")).drop("_staying")


def _decisions(landed: DataFrame, groups: DataFrame, odd: DataFrame) -> DataFrame:
    """The decisions of the state, except for ``odd`` rows, which are grouped by full text."""
    fewer = odd.groupBy("digest").agg(F.count("*").alias("_odd"))
    usual = (
        landed.join(odd.select("file", "row"), ["file", "row"], "left_anti")
        .join(groups.join(fewer, "digest", "left"), "digest")
        .select(
            "doc_id",
            "keep_id",
            (F.col("group_size") - F.coalesce("_odd", F.lit(0))).alias("group_size"),
            ((F.col("file") == F.col("keep_file")) & (F.col("row") == F.col("keep_row"))).alias("kept"),
            "digest",
            "file",
            "row",
        )
    )
    odd_groups = odd.groupBy("digest", "content").agg(
        F.max(F.struct("doc_id", "file", "row")).alias("_newest"),
        F.count("*").alias("group_size"),
    )
    apart = odd.join(odd_groups, ["digest", "content"]).select(
        "doc_id",
        F.col("_newest.doc_id").alias("keep_id"),
        "group_size",
        ((F.col("file") == F.col("_newest.file")) & (F.col("row") == F.col("_newest.row"))).alias("kept"),
        "digest",
        "file",
        "row",
    )
    return usual.unionByName(apart)


def without_copies(docs: DataFrame) -> DataFrame:
    """``docs``, all columns, without the rows that do not stay."""
    docs = on_file(docs)
    copies = deduplicate(docs).filter(~F.col("kept")).select("file", "row")
    return located(docs).join(copies, ["file", "row"], "left_anti").select("document.*")


def query(spark, directory: str) -> DataFrame:
    docs = spark.read.parquet(f"{directory}/documents.parquet")
    return deduplicate(docs).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


ORACLE_SQL = r"""
WITH texts AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text) AS keep_id, count(*) OVER (PARTITION BY text) AS group_size,
    doc_id = max(doc_id) OVER (PARTITION BY text) AS kept, sha256(text) AS text_sha256
FROM texts
"""
