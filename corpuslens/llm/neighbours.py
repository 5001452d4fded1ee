"""Approximate nearest neighbours by multiprobe p-stable hashing.

1. Equal vectors form a point, which keeps the k + 1 least ids: no more of them can be among
   the k nearest of any row. So a vector that a third of the rows share is one point.
2. Every point is put into a cell of each of several hash tables. A query visits its own cell
   and those next to it, in the order of their estimated chance of success, by
   perturbing the slots whose borders are near.
3. Cells are dealt into groups by their number. A group of more points or queries than fit a
   task is cut into blocks of both. In a block, each query's distances to the points in
   the cells that it visits are worked out exactly, and only its k + 1 best ids leave, so
   candidates never are rows.
4. The best of all tables are merged by query and ranked. Queries that found fewer than k rows
   although there are as many are compared with all points, in blocks.

The number of slots follows the number of points, and their width is fitted: on at most
``SAMPLE_BYTES`` of vectors, the points with the least hashes of their ids, it is the least one
with which 100 of them find ``TARGET`` of their k nearest. All points are indexed. Random directions
are drawn from a seed, in every task alike.

Defined results: vectors that are null, empty or zero, or hold a null or non-finite entry take no
part, nor do rows without vec_id, nor vectors of another length than most rows have (of equally
frequent ones, the longest). Rows are told apart by vec_id: of several with one vec_id, the greatest
vector counts, compared entry by entry. Equal distances go by vec_id. Other columns are
ignored. An empty table, or one without queries, gives no row.
"""

import math

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslens.llm import neighbour_tasks
from corpuslens.llm.stored import stored

NEAREST = 10
TABLES = 8
PROBES = 300  # cells that a query visits in each table, besides its own
TARGET = 0.95  # of the k nearest, in the sample
SAMPLE_BYTES = 8 << 20  # of vectors as doubles, held by the driver
BLOCK_BYTES = 16 << 20  # likewise, held by a task

# Tasks get these functions with the query and need no copy of the package.
cloudpickle.register_pickle_by_value(neighbour_tasks)


def usable(rows: DataFrame) -> DataFrame:
    """``(vec_id, vector)`` of the rows that take part."""
    kind = rows.schema["embedding"].dataType.elementType
    vector = F.col("embedding").cast(T.ArrayType(kind if isinstance(kind, T.FloatType) else T.DoubleType()))
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    named = rows.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
    whole = named.filter(F.col("vec_id").isNotNull() & finite & F.exists("vector", lambda x: x != 0))
    one = whole.groupBy("vec_id").agg(F.max("vector").alias("vector"))
    lengths = whole.groupBy(F.size("vector").alias("size")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("size")).first()
    return one.filter(F.size("vector") == (most["size"] if most else 0))


def points_of(rows: DataFrame, k: int) -> DataFrame:
    """``(point, ids, vector)``: each different vector with its k least ids; ``point`` is the
    least. Spark cuts the groups of equal vectors before it shuffles them, for k below 1,000."""
    first = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    return (
        rows.withColumn("_rank", first)
        .filter(F.col("_rank") <= k)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .select(F.get("ids", F.lit(0)).alias("point"), "ids", "vector")
    )


def _blocks(number: Column, most: int) -> Column:
    return F.greatest(F.ceil(number / most), F.lit(1)).cast("int")


def _dealt(rows: DataFrame, name: str, own: str, across: str) -> DataFrame:
    """``rows`` in one of ``own`` blocks by ``name``, once for each of ``across`` blocks."""
    return rows.withColumn(own, F.pmod(F.xxhash64(name), F.col(own)).cast("int")).withColumn(
        across, F.explode(F.sequence(F.lit(0), F.col(across) - 1))
    )


def _searched(index: DataFrame, asked: DataFrame, sizes: DataFrame, k: int) -> DataFrame:
    """``(query, vec_id, score)``: in each block the k best of each query. ``sizes`` has ``group``
    and its numbers of blocks, ``rows`` and ``columns``."""
    keys = ["group", "rows", "columns"]
    points = _dealt(index.join(sizes, "group"), "point", "rows", "columns")
    queries = _dealt(asked.join(sizes, "group"), "query", "columns", "rows")
    return (
        points.groupBy(*keys)
        .cogroup(queries.groupBy(*keys))
        .applyInArrow(
            lambda left, right: neighbour_tasks.searched(left, right, k), "query long, vec_id long, score double"
        )
    )


def _through_tables(points: DataFrame, asked: DataFrame, hashes, n_points: int, most: int, k: int) -> DataFrame:
    n_groups = max(1, math.ceil(n_points / most))
    vector = dict(points.dtypes)["vector"]

    def index(vectors: bool) -> DataFrame:
        schema = "group long, cell long, point long" + (f", ids array<long>, vector {vector}" if vectors else "")
        return points.mapInArrow(lambda b: neighbour_tasks.indexed(b, hashes, n_groups, vectors), schema)

    visits = asked.mapInArrow(
        lambda b: neighbour_tasks.asking(b, hashes, n_groups), f"group long, cells binary, query long, vector {vector}"
    )
    held = index(False).groupBy("group").agg(F.count("*").alias("points"))
    visited = visits.groupBy("group").agg(F.count("*").alias("queries"))
    sizes = held.join(visited, "group").select(
        "group", _blocks(F.col("points"), most).alias("rows"), _blocks(F.col("queries"), most).alias("columns")
    )
    return _searched(index(True), visits, stored(sizes), k)


def _through_all(points: DataFrame, asked: DataFrame, n_points: int, most: int, k: int) -> DataFrame:
    n_queries = asked.agg(F.count("*").alias("n"))
    sizes = n_queries.select(
        F.lit(0).cast("long").alias("group"),
        _blocks(F.lit(n_points), most).alias("rows"),
        _blocks(F.col("n"), most).alias("columns"),
    )
    everywhere = F.lit(0).cast("long")
    cell = F.lit(bytes(8))
    index = points.select(everywhere.alias("group"), everywhere.alias("cell"), "point", "ids", "vector")
    return _searched(index, asked.select(everywhere.alias("group"), cell.alias("cells"), "query", "vector"), sizes, k)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query; what several tables or blocks found counts once."""
    order = Window.partitionBy("query").orderBy("score", "vec_id")
    return (
        found.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    )


def nearest(rows: DataFrame, is_query: Column, k: int = NEAREST) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for the rows of ``rows`` (vec_id, embedding) for which
    ``is_query`` holds; ``score`` is the Euclidean distance."""
    rows = stored(usable(rows))
    points = stored(points_of(rows, k + 1))
    n_rows, n_points = rows.count(), points.count()
    if n_rows == 0:
        return _ranked(rows.select(F.col("vec_id").alias("query_id"), F.col("vec_id").alias("query")), None, k)
    dimension = points.agg(F.max(F.size("vector"))).first()[0]
    most = max(64, BLOCK_BYTES // (8 * dimension))
    sample = points.orderBy(F.xxhash64("point"), "point").limit(max(256, SAMPLE_BYTES // (8 * dimension)))
    table = sample.select("vector").toArrow()
    hashes = neighbour_tasks.fit(neighbour_tasks.matrix(table["vector"]), n_points, k, TARGET, TABLES, PROBES)

    queries = stored(
        rows.filter(is_query)
        .join(points.select(F.col("point").alias("query"), "vector"), "vector")
        .select(F.col("vec_id").alias("query_id"), "query", "vector")
    )
    asked = stored(queries.groupBy("query").agg(F.max("vector").alias("vector")))
    found = stored(_best(_through_tables(points, asked, hashes, n_points, most, k + 1), k + 1))
    enough = found.groupBy("query").count().filter(F.col("count") >= min(k + 1, n_rows))
    rest = stored(asked.join(enough, "query", "left_anti"))
    if not rest.isEmpty():
        every = _best(_through_all(points, rest, n_points, most, k + 1), k + 1)
        found = found.join(rest, "query", "left_anti").unionByName(every)
    return _ranked(queries.select("query_id", "query"), found, k)


def _ranked(queries: DataFrame, found: DataFrame | None, k: int) -> DataFrame:
    if found is None:
        found = queries.select("query", F.lit(0).cast("long").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    near = (
        queries.join(found.drop("rank"), "query")
        .filter(F.col("vec_id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")))
    )
    return near.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark, directory: str) -> DataFrame:
    rows = spark.read.parquet(f"{directory}/embeddings.parquet").select("vec_id", "embedding")
    return nearest(rows, F.col("vec_id") % 100 == 0)
