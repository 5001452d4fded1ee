"""Similarity join of documents by their sets of word shingles.

Two documents link when the Jaccard similarity of their sets reaches ``percent``. Candidates
must share a shingle among the first ones of their sets under several different global
orders; all orders put rare shingles first, so a passage that many documents share is in
hardly any prefix.

1. Documents are dealt into batches. Each batch sends its distinct shingle keys, packed, to
   buckets of keys and is answered with their counts over the corpus. So every count is
   exact up to a hash, no table of shingles exists, and no row is made per shingle.
2. Documents with equal sets form a class; one batch speaks for it. A set all of whose
   prefix shingles are its own has no partner and ends here. The rest, usually a small
   share, becomes records: prefixes under each order, and the shingles others also hold.
3. Shingles of up to ``dense`` prefixes give pairs by a join, at most ``dense`` for each
   prefix entry. Shingles of more, as in large groups of near copies, give clusters; a cluster is
   checked in cells of two blocks of bounded size, which emit no pairs, only links spanning
   the linked sets and counts. Pairs that share prefix shingles under all orders, and only
   they, are verified exactly.
4. Links are joined into components.

Defined results: words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a text of fewer
words than a shingle has all its words as one; without words, or null, it has none and is in
a component of its own. Repeated rows and rows without doc_id take part; a component's id is
the least doc_id in it (null if it has none). Other columns are ignored by ``join`` and kept
by ``one_of_each_group``. An empty table gives no row. Shingles are compared by 64-bit hashes.
"""

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm import ngram_tasks, text_tasks
from corpuslens.llm.batches import batch_count, in_batches
from corpuslens.llm.components import components
from corpuslens.llm.stored import stored

BATCH_BYTES = 8 << 20
DENSE = 64  # prefix entries of a shingle that are paired by a join
BLOCK_SETS = 512  # of a cluster's block; a cell's matrices hold (2 * 512) ** 2 numbers
BLOCK_SHINGLES = 1 << 20

# Tasks get these functions with the query and need no copy of the package.
cloudpickle.register_pickle_by_value(text_tasks)
cloudpickle.register_pickle_by_value(ngram_tasks)

REQUEST = (
    "batch int, doc_id long, text_hash long, mark binary, n_shingles long,"
    " bucket int, keys binary, counts binary"
)
REPLY = "batch int, bucket int, counts binary, mark binary"
RECORD = (
    "mark binary, n long, shared array<long>, prefix_1 array<long>, prefix_2 array<long>,"
    " prefix_3 array<long>"
)


def join(docs: DataFrame, size: int = 5, percent: int = 80, dense: int = DENSE) -> DataFrame:
    """``(doc_id, text_hash, n_shingles, component_id, n_links, component)`` per document.

    ``component`` names the component where doc_ids may be null or not unique; null for a
    text without words. ``n_links`` counts the different sets that the document's set links with.
    """
    n_batches = batch_count(docs, BATCH_BYTES)
    dealt = in_batches(docs, n_batches)
    asked = stored(
        dealt.groupBy("batch").applyInArrow(
            lambda table: ngram_tasks.requests(table, size, n_batches), REQUEST
        )
    )
    rows = asked.filter("bucket IS NULL").select("batch", "doc_id", "text_hash", "mark", "n_shingles")
    classes = (
        rows.filter("mark IS NOT NULL")
        .groupBy("mark")
        .agg(F.min("doc_id").alias("least_id"), F.min("batch").alias("batch"))
    )
    found = stored(_records(dealt, asked, classes, size, percent))
    links = stored(_links(found, percent, dense))
    linked = _linked(classes, links)
    whole = stored(
        classes.join(linked, "mark", "left").select(
            "mark",
            F.coalesce("root", "mark").alias("component"),
            F.coalesce("component_id", "least_id").alias("component_id"),
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
        )
    )
    return rows.join(whole, "mark", "left").select(
        "doc_id",
        "text_hash",
        "n_shingles",
        F.when(F.col("mark").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        "component",
    )


def _records(dealt, asked, classes, size, percent) -> DataFrame:
    answers = (
        asked.filter("bucket IS NOT NULL")
        .select("batch", "bucket", "keys", "counts")
        .groupBy("bucket")
        .applyInArrow(ngram_tasks.replies, REPLY)
    )
    spokesmen = classes.select(
        "batch", F.lit(None).cast("int").alias("bucket"), F.lit(None).cast("binary").alias("counts"), "mark"
    )
    return (
        dealt.select("batch", "text")
        .groupBy("batch")
        .cogroup(answers.unionByName(spokesmen).groupBy("batch"))
        .applyInArrow(lambda left, right: ngram_tasks.records(left, right, size, percent), RECORD)
    )


def _links(records: DataFrame, percent: int, dense: int) -> DataFrame:
    """``(a, b, links)``: links that span each component, and at ``a`` the links counted."""
    entries = records.select("mark", "n", F.explode("prefix_1").alias("token"))
    held = stored(
        entries.groupBy("token")
        .agg(F.count("*").alias("holders"), F.min("mark").alias("hub"))
        .filter("holders > 1")
    )
    by_hub = entries.join(held.filter(F.col("holders") > dense), "token")
    clusters = components(by_hub.select(F.col("mark").alias("a"), F.col("hub").alias("b")).distinct())
    clusters = clusters.select(F.col("node").alias("mark"), F.col("root").alias("cluster"))
    return _links_of_pairs(records, entries, held.filter(F.col("holders") <= dense), clusters, percent).unionByName(
        _links_in_clusters(records, clusters, percent)
    )


def _links_of_pairs(records, entries, held, clusters, percent) -> DataFrame:
    sparse = entries.join(held.select("token"), "token").join(clusters, "mark", "left")

    def side(name):
        return sparse.select("token", *[F.col(c).alias(f"{c}_{name}") for c in ("mark", "n", "cluster")])

    alike = F.lit(100) * F.least("n_a", "n_b") >= F.lit(percent) * F.greatest("n_a", "n_b")
    apart = ~(F.coalesce(F.col("cluster_a") == F.col("cluster_b"), F.lit(False)))
    pairs = (
        side("a")
        .join(side("b"), "token")
        .filter((F.col("mark_a") < F.col("mark_b")) & alike & apart)
        .select("mark_a", "mark_b")
        .distinct()
    )

    def record(name):
        return records.select(*[F.col(c).alias(f"{c}_{name}") for c in records.columns])

    common = F.size(F.array_intersect("shared_a", "shared_b"))
    links = (
        pairs.join(record("a"), "mark_a")
        .join(record("b"), "mark_b")
        .filter(F.arrays_overlap("prefix_2_a", "prefix_2_b") & F.arrays_overlap("prefix_3_a", "prefix_3_b"))
        .filter(F.lit(100) * common >= F.lit(percent) * (F.col("n_a") + F.col("n_b") - common))
    )
    one = F.lit(1).cast("long")
    there = F.struct(F.col("mark_a").alias("a"), F.col("mark_b").alias("b"), one.alias("links"))
    back = F.struct(F.col("mark_b").alias("a"), F.col("mark_a").alias("b"), one.alias("links"))
    return links.select(F.inline(F.array(there, back)))


def _links_in_clusters(records, clusters, percent) -> DataFrame:
    members = records.join(clusters, "mark")
    blocks = members.groupBy("cluster").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK_SETS, F.sum(F.size("shared")) / BLOCK_SHINGLES))
        .cast("int")
        .alias("blocks")
    )
    cells = (
        members.join(blocks, "cluster")
        .withColumn("block", F.pmod(F.xxhash64("mark"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "cluster",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
            "block",
            *records.columns,
        )
    )
    found = cells.groupBy("cluster", "low", "high").applyInArrow(
        lambda table: ngram_tasks.linked_in_cell(table, percent),
        "mark binary, partner binary, links long",
    )
    return found.select(F.col("mark").alias("a"), F.col("partner").alias("b"), "links")


def _linked(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``(mark, root, component_id, n_links)`` of the sets that have links."""
    whole = components(links).select(F.col("node").alias("mark"), "root")
    least = classes.join(whole, "mark").groupBy("root").agg(F.min("least_id").alias("component_id"))
    degree = links.groupBy(F.col("a").alias("mark")).agg(F.sum("links").alias("n_links"))
    return whole.join(least, "root").join(degree, "mark", "left").select(
        "mark", "root", "component_id", "n_links"
    )


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """``docs``, all columns, with one document of each component: the one with its id.

    Of several texts with that doc_id the one with the least hash stays, and of rows that
    repeat it one. In a component without any doc_id the text with the least hash stays.
    Texts without words have no partner and stay, though not repeated rows of them.
    """
    found = join(docs)
    chosen = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash"))
    staying = (
        found.filter("component IS NOT NULL")
        .groupBy("component")
        .agg(chosen.alias("chosen"))
        .select("chosen.doc_id", "chosen.text_hash")
        .union(found.filter("component IS NULL").select("doc_id", "text_hash").distinct())
    )
    staying = stored(staying.withColumnsRenamed({"doc_id": "staying_id", "text_hash": "staying_hash"}))
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("staying_id")) & (F.col("text_hash") == F.col("staying_hash"))
    kept = rows.join(staying, same, "left_semi").dropDuplicates(["doc_id", "text_hash"])
    return kept.select("row.*")


def query(spark, directory: str) -> DataFrame:
    docs = spark.read.parquet(f"{directory}/documents.parquet")
    return join(docs).select("doc_id", "n_shingles", "component_id", "n_links")
