"""Changes of a stored dimension rewrite the buckets they touch, and no change is lost."""

import datetime as dt
import pathlib
import threading

import pytest
from pyspark.sql import functions as F

from granary import schemas
from granary.operators import dimension, quality
from granary.plans import jobs, publish
from granary.sources import commits
from tests.test_commits import break_rename
from tests.test_tables import AT, products

LATER = AT + dt.timedelta(days=1)


def shown(spark, root):
    rows = jobs.read_dimension(spark, root).drop("bucket").collect()
    return {r.inventory_id: (r.product_name, r.created_at, r.updated_at) for r in rows}


def files(root):
    return {p: p.stat().st_mtime_ns for p in pathlib.Path(root).rglob("*.parquet")}


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    root = str(tmp_path / "dimension")
    assert jobs.read_dimension(spark, root).count() == 0
    jobs.change_dimension(root, products(spark, *((i, f"n{i}", "S") for i in range(40))), AT)
    before = files(root)
    assert len(before) > 10
    rejected = jobs.change_dimension(root, products(spark, (3, "new", None), (99, "added", "L"), (5, "x", "S"), (5, "y", "S")), LATER)
    assert sorted(r.product_name for r in rejected.collect()) == ["x", "y"]
    touched = {r.bucket for r in products(spark, (3, "", ""), (99, "", ""), (5, "", "")).select(dimension.bucket()).collect()}
    after = files(root)
    same = {p for p in before if before[p] == after.get(p)}
    assert {p for p in before if not any(f"bucket={b}/" in str(p) for b in touched)} == same
    got = shown(spark, root)
    assert got[3] == ("new", AT, LATER) and got[99] == ("added", LATER, LATER) and got[5] == ("n5", AT, AT) and len(got) == 41


def test_the_job_equals_the_operator_on_the_whole(spark, tmp_path):
    root = str(tmp_path / "dimension")
    current = products(spark, *((i, f"n{i}", "S") for i in range(0, 30, 2)))
    changes = products(spark, *((i, f"c{i}", None) for i in range(0, 30, 3)), (6, "again", "S"))
    for how in (dimension.insert, dimension.upsert):
        publish.replace_partitions(current.withColumn("bucket", dimension.bucket()), ["bucket"], root)
        for b in set(commits.Files(spark, root).names(root)) - {f"bucket={r.bucket}" for r in current.select(dimension.bucket()).distinct().collect()}:
            commits.drop(spark, f"{root}/{b}")
        merged, refused = how(current, changes, LATER)
        rejected = jobs.change_dimension(root, changes, LATER, how)
        columns = schemas.PRODUCT_METADATA.columns
        rows = lambda df: sorted(map(repr, df.select(*columns).collect()))
        assert rows(jobs.read_dimension(spark, root)) == rows(merged)
        assert sorted(map(repr, rejected.collect())) == sorted(map(repr, refused.collect()))


def test_a_broken_change_leaves_the_dimension(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "dimension")
    jobs.change_dimension(root, products(spark, (1, "a", "S"), (2, "b", "S")), AT)
    before = shown(spark, root)
    for broken in (products(spark, (1, "z", "S"), (None, "no key", "S")), products(spark, (1, None, "S"))):
        with pytest.raises(quality.InvalidRowsError, match="required"):
            jobs.change_dimension(root, broken, LATER)
    with monkeypatch.context() as patch:
        break_rename(patch, 2)
        with pytest.raises(RuntimeError, match="boom"):
            jobs.change_dimension(root, products(spark, (1, "z", "S")), LATER)
    assert shown(spark, root) == before
    assert jobs.change_dimension(root, products(spark, (1, "z", "S")).limit(0), LATER).count() == 0
    assert shown(spark, root) == before


def test_changes_at_once_are_all_kept(spark, tmp_path, monkeypatch):
    """One bucket for all keys: every run has to merge what the others wrote."""
    monkeypatch.setattr(dimension, "BUCKETS", 1)
    root, errors = str(tmp_path / "dimension"), []
    jobs.change_dimension(root, products(spark, (0, "first", "S")), AT)

    def run(i):
        try:
            jobs.change_dimension(root, products(spark, (i, f"by {i}", "S")), LATER)
        except Exception as error:
            errors.append(error)

    threads = [threading.Thread(target=run, args=(i,)) for i in range(1, 5)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert errors == []
    assert {i: n for i, (n, _, _) in shown(spark, root).items()} == {0: "first"} | {i: f"by {i}" for i in range(1, 5)}


def test_buckets_are_registered(spark, tmp_path):
    root = str(tmp_path / "dimension")
    publish.create_table(spark, schemas.PRODUCT_DIMENSION, "stored_products", root)
    jobs.change_dimension(root, products(spark, (1, "a", "S"), (2, "b", "S"), (3, "c", "S")), AT, table="stored_products")
    assert sorted(r.product_name for r in spark.table("stored_products").collect()) == ["a", "b", "c"]
    spark.sql("DROP TABLE stored_products")


def test_lost_ids_are_named(spark, tmp_path):
    docs = spark.range(3000).select(F.col("id"), F.lit("x").alias("d"))
    flat = spark.range(0, 3003).filter("id not in (7, 1500, 2999)").withColumnRenamed("id", "order").crossJoin(spark.range(2).select())
    found = sorted((r.id, r.side) for r in quality.differing_ids(docs, "id", flat, "order").collect())
    assert found == [(7, "left"), (1500, "left"), (2999, "left"), (3000, "right"), (3001, "right"), (3002, "right")]
    assert sorted((r.id, r.side) for r in quality.differing_ids(docs, "id", flat, "order", ranges=1).collect()) == found
    none = quality.differing_ids(docs, "id", docs.withColumn("id", F.col("id")), "id")
    assert none.count() == 0 and "Join" not in none._jdf.queryExecution().optimizedPlan().toString()
    with pytest.raises(ValueError, match=r"3000 documents but 2999 ids after flattening, lost: 12, all in") as error:
        quality.require_complete(docs, "id", docs.filter("id <> 12").withColumnRenamed("id", "o"), "o", str(tmp_path / "lost"))
    assert "documents but" in str(error.value)
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "lost")).collect()] == [(12, "left")]
    empty = docs.limit(0)
    assert quality.differing_ids(empty, "id", empty, "id").count() == 0
    nulls = docs.limit(3).withColumn("id", F.when(F.col("id") > 0, F.col("id")))
    assert quality.differing_ids(nulls, "id", empty, "id").count() == 2


def test_lost_ids_read_either_side_once(spark):
    """One aggregate and no join, nothing runs before the result is asked for, and a union of
    two results does not put both aggregates in one task."""
    docs = spark.createDataFrame([(i % 50 if i % 7 else None,) for i in range(400)] + [(999,)] * 5, "id long").repartition(3)
    flat = spark.createDataFrame([(i % 60 if i % 5 else None,) for i in range(400)] + [(-1,)] * 5, "o int").repartition(3)
    here = {i % 50 for i in range(400) if i % 7} | {999}
    there = {i % 60 for i in range(400) if i % 5} | {-1}
    expected = sorted([(i, "left") for i in here - there] + [(i, "right") for i in there - here])
    spark.sparkContext.setJobGroup("lost ids", "")
    lost = quality.differing_ids(docs, "id", flat, "o")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("lost ids")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(tuple(r) for r in lost.collect()) == expected
    plan = lost._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("LogicalRDD") == 2
    both = lost.unionByName(quality.differing_ids(flat, "o", docs, "id"))
    assert sorted(tuple(r) for r in both.collect()) == sorted(expected + [(i, {"left": "right", "right": "left"}[s]) for i, s in expected])
    alone = lost._jdf.queryExecution().executedPlan().outputPartitioning().toString()
    assert "hashpartitioning(id" not in alone
