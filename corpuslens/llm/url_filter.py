"""Exact URL lists by cascades of Bloom filters.

A key is a host and the start of a path, such as ``example.com/en/``. A first filter holds
the listed keys; the next one the keys of the whole corpus that pass it wrongly; the next
one the listed keys that pass that wrongly, and so on until no key of the corpus is in
doubt. A key is listed if the first level without it has an odd number. That is exact for
every key of the corpus (the universe) and needs no join: levels are constants in an
expression, a few bits for each *listed* key, whatever the size of the corpus. The universe
is reduced to the keys that pass level one where it is read; only those are shuffled.

Defined results: a url that is null or has no ``://`` has an empty host and path and no
rule. Of several rules that fit, the longest rule text wins, then the longer host. A url
without a rule is allowed, since the cascade finds none of its keys listed. Repeated rows
are judged alike; other columns are ignored; an empty table gives no row.
"""

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.stored import stored

WORD = 64
MOST_LEVELS = 64


@dataclass(frozen=True)
class Level:
    """A Bloom filter as a constant: ``words`` of 64 bits, probed at ``hashes`` places."""

    words: tuple[int, ...]
    hashes: int
    seed: int

    def holds(self, key: Column) -> Column:
        bits = F.from_json(F.lit("[" + ",".join(map(str, self.words)) + "]"), "array<bigint>")
        found = F.lit(True)
        for place in self.places(key):
            word = F.get(bits, F.floor(place / WORD).cast("int"))
            found = found & (F.getbit(word, (place % WORD).cast("int")) == 1)
        return found

    def places(self, key: Column) -> list[Column]:
        n_bits = len(self.words) * WORD
        return [
            F.pmod(F.xxhash64(key, F.lit(self.seed), F.lit(i)), F.lit(n_bits).cast("long"))
            for i in range(self.hashes)
        ]


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def listed(self, key: Column) -> Column:
        """Whether a key of the universe is listed: the parity of the first level without it."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for depth in range(len(self.levels) - 1, -1, -1):
            answer = F.when(self.levels[depth].holds(key), answer).otherwise(F.lit(depth % 2 == 1))
        return answer


def _level(keys: DataFrame, count: int, rate: float, seed: int) -> Level:
    """A filter of ``keys`` (column ``key``). Spark sets the bits; the driver gets words of
    64 bits, as many as ``count`` and ``rate`` give, none of the keys."""
    bits = max(1, math.ceil(count * -math.log(rate) / math.log(2) ** 2))
    n_words = -(-bits // WORD)
    hashes = max(1, round(-math.log2(rate)))
    blank = Level((0,) * n_words, hashes, seed)
    places = F.explode(F.array(*blank.places(F.col("key")))).alias("place")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("place") % WORD).cast("int"))
    rows = (
        keys.select(places)
        .groupBy(F.floor(F.col("place") / WORD).cast("int").alias("word"))
        .agg(F.bit_or(bit).alias("bits"))
        .collect()
    )
    words = [0] * n_words
    for row in rows:
        words[row["word"]] = row["bits"]
    return Level(tuple(words), hashes, seed)


def build(listed: DataFrame, universe: DataFrame, first_rate: float = 1 / 1024) -> Cascade:
    """The cascade for ``listed`` against all keys of ``universe`` (both ``key``).

    Null keys are ignored. Nothing listed: an empty cascade, which lists no key.
    """
    listed = stored(listed.filter(F.col("key").isNotNull()).distinct())
    count = listed.count()
    if count == 0:
        return Cascade(())
    levels = [_level(listed, count, first_rate, 0)]
    passed = universe.filter(F.col("key").isNotNull()).filter(levels[0].holds(F.col("key")))
    passed = passed.distinct().join(listed, "key", "left_anti")
    rivals, members = stored(passed), listed
    while (n_rivals := rivals.count()) > 0:
        if len(levels) == MOST_LEVELS:
            raise RuntimeError("the filters do not part the keys; are two of them equal?")
        levels.append(_level(rivals, n_rivals, 0.5, len(levels)))
        passing = members.filter(levels[-1].holds(F.col("key")))
        rivals, members = stored(passing), rivals
    return Cascade(tuple(levels))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path; both empty without ``://``."""
    place = F.position(F.lit("://"), url)
    rest = F.when(place > 0, F.substr(url, place + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)\A[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def candidate_keys(host: Column, path: Column, lengths: list[int], label_counts: list[int]) -> Column:
    """Every key that a rule for this url could have, the longest rule text first, then the
    longer host. Hosts are tried with the numbers of labels, and paths in the lengths, that occur
    among the rules, so that the keys of a url are no longer than it is, times these numbers."""
    n_labels = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1
    suffixes = F.filter(
        F.array(*[F.when(n_labels >= n, F.substring_index(host, ".", -n)) for n in label_counts]),
        lambda suffix: suffix.isNotNull(),
    )
    starts = F.filter(
        F.array(*[F.when(F.length(path) >= n, F.substr(path, F.lit(1), F.lit(n))) for n in lengths]),
        lambda start: start.isNotNull(),
    )
    pairs = F.flatten(
        F.transform(
            suffixes,
            lambda s: F.transform(
                starts,
                lambda p: F.struct(
                    F.length(F.concat(s, p)).alias("length"),
                    F.length(s).alias("host_length"),
                    F.concat(s, p).alias("key"),
                ),
            ),
        )
    )
    # Within one url a rule text can come from one host only, so no key stands twice.
    return F.when(host != "", F.sort_array(pairs, asc=False)["key"]).otherwise(
        F.array().cast("array<string>")
    )


def judge(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for ``pages`` (page_id, url).

    ``rules`` has ``host, path, action`` (allow or block). A rule given with both actions
    blocks; one without a host fits nothing. The path lengths and numbers of labels that
    occur among the rules, a handful of numbers, come to the driver.
    """
    labels = F.size(F.split("host", r"\."))
    rules = rules.filter("host != ''").select(
        F.concat("host", "path").alias("key"), F.length("path").alias("n"), labels.alias("labels"), "action"
    ).filter(F.col("key").isNotNull())
    shapes = rules.agg(F.sort_array(F.collect_set("n")), F.sort_array(F.collect_set("labels"))).first()
    lengths, label_counts = shapes[0] or [1], shapes[1] or [1]
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    keyed = urls.withColumn(
        "_keys", candidate_keys(F.col("host"), F.col("path"), lengths, label_counts)
    )
    universe = keyed.select(F.explode("_keys").alias("key"))
    of_any = build(rules.select("key"), universe)
    blocking = rules.filter(F.col("action") == "block").select("key")
    of_blocks = build(blocking, universe)
    rule = F.get(F.filter("_keys", of_any.listed), F.lit(0))
    return keyed.withColumn("rule", rule).select(
        "page_id",
        "host",
        "path",
        "rule",
        F.when(F.col("rule").isNotNull() & of_blocks.listed(F.col("rule")), "block")
        .otherwise("allow")
        .alias("verdict"),
    )


RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def query(spark, directory: str) -> DataFrame:
    pages = spark.read.parquet(f"{directory}/pages.parquet").select("page_id", "url")
    rules = spark.sql(
        "SELECT * FROM VALUES " + ", ".join(map(str, RULES)) + " AS rules(host, path, action)"
    )
    return judge(pages, rules)


ORACLE_SQL = r"""
WITH rests AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), parts AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM rests
), rules(rule_host, rule_path, action) AS (
    VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
        ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), ruled AS (
    SELECT page_id, host, path, rule_host || rule_path AS rule, action
    FROM parts LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC NULLS LAST) = 1
)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM ruled
"""
