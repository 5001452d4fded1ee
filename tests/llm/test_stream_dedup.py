import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from corpuslens.llm import stream_dedup as S
from tests.llm.cases import documents, lowered, no_documents, odd_documents


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[lowered(t)].append(i)
    return groups


def test_odd_cases(spark):
    docs = odd_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    groups = brute(rows)
    found = S.deduplicate(docs).collect()
    by_digest = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    assert len(found) == len(rows)
    for r in found:
        ids = by_digest[r.digest]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
    assert sum(r.kept for r in found) == len(groups)
    assert S.deduplicate(no_documents(spark)).count() == 0


def test_kept_rows_with_all_columns(spark):
    docs = odd_documents(spark)
    kept = S.without_copies(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    texts = [lowered(r.text) for r in rows]
    assert sorted(texts) == sorted({lowered(r.text) for r in docs.collect()})
    assert all(r.file == "f" and r["row"] == "r" for r in rows)


def test_bytes_decide_where_digests_collide(spark):
    rows = [(i, f"text {i % 5}") for i in range(40)] + [(99, "lone")]
    found = S.deduplicate(documents(spark, rows), digest=lambda text: F.lit("same")).collect()
    groups = brute(rows)
    texts = dict(rows)
    for r in found:
        ids = groups[texts[r.doc_id]]
        assert (r.group_size, r.keep_id, r.kept) == (len(ids), max(ids), r.doc_id == max(ids))


def test_state_lasts_over_calls(spark, tmp_path):
    folder = str(tmp_path / "dedup")
    S.deduplicate(documents(spark, [(1, "a"), (2, "b")]), folder)
    first = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    first.write.parquet(str(tmp_path / "first"))
    second = spark.createDataFrame([(3, "A"), (4, "c")], "doc_id long, text string")
    found = S.deduplicate(second, folder).collect()
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in found} == {
        1: (3, 2, False),
        2: (2, 1, True),
        3: (3, 2, True),
        4: (4, 1, True),
    }


@pytest.mark.parametrize("broadcast", [0, 100])
@pytest.mark.parametrize("first, second", [((9, "alpha"), (3, "beta")), ((3, "beta"), (9, "alpha"))])
def test_bytes_decide_across_calls(spark, tmp_path, monkeypatch, first, second, broadcast):
    """Digests collide; what an earlier call saw is read from the files that locators name."""
    monkeypatch.setattr(S, "MOST_BROADCAST", broadcast)
    folder = str(tmp_path / "dedup")
    for name, rows in (("a b [1]", [first, (50, "lone")]), ("c", [second, (7, second[1].upper())])):
        path = str(tmp_path / name)
        documents(spark, rows).write.parquet(path)
        last = S.deduplicate(spark.read.parquet(path.replace("[", "\\[").replace("]", "\\]")), folder, digest=lambda text: F.lit("same"))
    found = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in last.collect()}
    keep = max(second[0], 7)
    assert found == {
        first[0]: (first[0], 1, True),
        50: (50, 1, True),
        second[0]: (keep, 2, keep == second[0]),
        7: (keep, 2, keep == 7),
    }


def test_only_hits_are_shuffled(spark):
    rows = [(i, "copy" if i < 4 else f"text {i}") for i in range(100)]
    contents = S.located(S.on_file(documents(spark, rows))).selectExpr("document.text AS content", "file", "row")
    hits = contents.filter("content = 'copy'").select("file", "row")
    plan = S._contents(contents, hits)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan


def test_a_group_with_a_third_of_the_rows(spark):
    rows = [(i, "copy" if i % 3 == 0 else f"text {i}") for i in range(6000)]
    found = S.deduplicate(documents(spark, rows))
    assert found.filter("kept").count() == 4001
    assert found.filter("keep_id = 5997 AND group_size = 2000").count() == 2000


def test_the_session_keeps_its_settings_and_the_stream_has_them(spark):
    names = ["spark.sql.shuffle.partitions", *S.STATE_SETTINGS]
    before = {n: spark.conf.get(n, None) for n in names}
    spark.conf.set("spark.sql.shuffle.partitions", 3)
    try:
        folder = f"{S.shared_folder(spark)}/three"
        S.deduplicate(documents(spark, [(i, f"t{i}") for i in range(20)]), folder)
        state = spark.read.format("statestore").load(f"{folder}/state")
        assert state.select("partition_id").distinct().count() <= 3
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before["spark.sql.shuffle.partitions"])
    assert {n: spark.conf.get(n, None) for n in names} == before
