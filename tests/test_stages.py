"""Staged tables: freed by their query, found again by later ones, kept apart between threads."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from searchrank import session
from searchrank.plans import catalog, q_models, q_profile, q_ranking  # noqa: F401
from searchrank.sources.io import materialize

SF = "/root/testdata/sf0.001"


def _folder(spark):
    base = os.path.join(session.ensure_checkpoint_dir(spark).removeprefix("file:"), "tables")
    return set(os.listdir(base)) if os.path.isdir(base) else set()


def test_a_query_keeps_only_what_its_result_reads(spark):
    before = _folder(spark)
    got = catalog.QUERIES["describe_log"](spark, SF)   # its result is a local table
    assert _folder(spark) == before
    assert got.count() > 10
    got = catalog.QUERIES["ndcg5_by_country"](spark, SF)
    left = _folder(spark) - before
    assert got.count() > 0 and all(session.read_by(got, [p]) for p in left)


def test_tables_read_in_subqueries_are_kept(spark):
    @session.tidy
    def query(spark):
        a = materialize(spark.range(10), "keep-a")
        b = materialize(spark.range(5), "keep-b")
        gone = materialize(spark.range(7), "gone")
        low = b.agg(F.max("id")).scalar()
        return a.where(F.col("id") > low).withColumn("n", F.lit(gone.count()))

    before = _folder(spark)
    got = query(spark)
    left = {p.split("-")[0] + "-" + p.split("-")[1] for p in _folder(spark) - before}
    assert left == {"keep-a", "keep-b"}
    assert [(r["id"], r["n"]) for r in got.orderBy("id").collect()] == [(i, 7) for i in range(5, 10)]


def test_a_failing_query_leaves_nothing(spark):
    @session.tidy
    def query(spark):
        materialize(spark.range(10), "lost")
        raise RuntimeError("no result")

    before = _folder(spark)
    with pytest.raises(RuntimeError):
        query(spark)
    assert _folder(spark) == before


def test_model_queries_share_one_engineered_table(spark):
    session.release_shared(spark)
    a = q_models._engineered(spark, SF)
    mine = [p for p in _folder(spark) if p.startswith("shared-engineered")]
    assert len(mine) == 1
    b = q_models._engineered(spark, SF)
    assert set(a.inputFiles()) == set(b.inputFiles())
    n = b.count()
    assert [p for p in _folder(spark) if p.startswith("shared-engineered")] == mine
    # without the commit marker the folder does not count
    marker = os.path.join(session.ensure_checkpoint_dir(spark).removeprefix("file:"), "tables", mine[0], "_SUCCESS")
    os.remove(marker)
    assert q_models._engineered(spark, SF).count() == n and os.path.exists(marker)
    session.release_shared(spark)
    assert not [p for p in _folder(spark) if p.startswith("shared-engineered")]


def test_other_inputs_or_recipes_are_other_tables(spark, tmp_path):
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    spark.range(3).write.parquet(one)
    spark.range(4).write.parquet(two)

    def table(path, spec):
        return session.shared_table(spark, "n", [path], spec, lambda: spark.read.parquet(path).withColumn("s", F.lit(spec)))

    assert [table(one, "a").count(), table(two, "a").count(), table(one, "b").first()["s"]] == [3, 4, "b"]
    spark.range(6).write.mode("overwrite").parquet(one)   # changed files
    assert table(one, "a").count() == 6
    session.release_shared(spark)


def test_blocks_of_two_threads(spark):
    kept, seen = [], threading.Event()

    def other():
        kept.append(materialize(spark.range(3), "mine"))
        seen.set()

    with session.staging(spark) as paths:
        t = threading.Thread(target=other)
        t.start()
        seen.wait(60)
        t.join()
        inner = session.in_threads(lambda k: materialize(spark.range(k), "ours"), [1, 2], 2)
        assert [d.count() for d in inner] == [1, 2] and len(paths) == 2
    assert kept[0].count() == 3   # the other thread's table outlives this block
    assert not any("ours" in p for p in _folder(spark))


def test_queries_limit_generated_methods(spark):
    """A query of the log keeps its generated methods to what HotSpot compiles, and leaves a session's own limit alone."""
    from searchrank.plans import q_clean, q_models, q_profile  # noqa: F401
    from searchrank.plans.catalog import QUERIES
    key = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.unset(key)
    QUERIES["null_counts"](spark, "/root/testdata/sf0.001")
    assert spark.conf.get(key) == "8000"
    spark.conf.set(key, "7000")
    QUERIES["null_counts"](spark, "/root/testdata/sf0.001")
    assert spark.conf.get(key) == "7000"
    spark.conf.unset(key)


def test_queries_limit_what_a_task_reads(spark):
    """Joined shuffle partitions stay small (F25), and a session's own size is left alone."""
    from searchrank.plans import q_features  # noqa: F401
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.unset(key)
    catalog.QUERIES["rank_features"](spark, SF)
    assert spark.conf.get(key) == "16m"
    spark.conf.set(key, "32m")
    catalog.QUERIES["rank_features"](spark, SF)
    assert spark.conf.get(key) == "32m"
    spark.conf.unset(key)
