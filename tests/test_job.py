import tempfile

import pytest

from martlet.plans import job
from martlet.plans.job import CheckFailure, build_batch, published, register_views
from martlet.plans.batch_build import build
from martlet.sources.driver_tables import SECOND_BATCH, SELECTED_BATCH, raw_tables
from martlet.sources.raw_store import land_raw

from conftest import SMALL


def test_build_batch_from_partitioned_raw(spark):
    root = tempfile.mkdtemp(prefix="martlet-job-")
    land_raw(spark, raw_tables(spark, SMALL), f"{root}/raw")
    totals = build_batch(spark, f"{root}/raw", f"{root}/marts", SELECTED_BATCH, fail_on_errors=False)
    # Clean fixture: four driver event types (signup, error, click, view) are outside the declared list.
    assert totals == {"not_null": 0, "unique": 0, "relationships": 0, "accepted_values": 4,
                      "batch_row_count_matches": 0, "singular": 0}
    assert set(published(spark, f"{root}/marts")) == {*job.PUBLISHED, "check_results"}
    mart = published(spark, f"{root}/marts")["mart_daily_sales"]
    before = sorted(mart.collect())
    assert before and mart.select("source_batch_id").distinct().count() == 1
    # The second batch is incomplete (no events): it is refused before anything is built ...
    with pytest.raises(ValueError, match="incomplete"):
        build_batch(spark, f"{root}/raw", f"{root}/marts", SECOND_BATCH)
    # ... and, built all the same, fails its row-count check; the published mart stays.
    with pytest.raises(CheckFailure) as failed:
        build_batch(spark, f"{root}/raw", f"{root}/marts", SECOND_BATCH, require_complete=False)
    assert failed.value.totals["batch_row_count_matches"] == 1
    assert sorted(published(spark, f"{root}/marts")["mart_daily_sales"].collect()) == before
    build_batch(spark, f"{root}/raw", f"{root}/marts", SECOND_BATCH, require_complete=False, fail_on_errors=False)
    after = published(spark, f"{root}/marts")
    for name in job.PUBLISHED:
        assert [r[0] for r in after[name].select("source_batch_id").distinct().collect()] == [SECOND_BATCH]
    assert sorted(mart.collect()) == before  # a reader of the old set is not disturbed


def _small_build(spark, monkeypatch, root, batch, failures=0, during=None):
    """``build_and_check`` with one-row tables in place of the models."""
    one = spark.createDataFrame([(batch,)], "source_batch_id string")

    class Staged(dict):
        def __missing__(self, key):
            return one

    class Small:
        staged = Staged({"stg": one})

        def __getattr__(self, _):
            return one

    def summary(*_):
        if during:
            during()
        return spark.createDataFrame([("unique", "m", "c", failures)], "test_name string, model string, column_name string, failures bigint")

    monkeypatch.setattr(job, "build", lambda *_, **__: Small())
    monkeypatch.setattr(job.marts, "mart_daily_sales", lambda _: one)
    monkeypatch.setattr(job.checks, "check_summary", summary)
    for name in ("dimension_coverage", "fact_reconciliation", "order_quantities", "daily_expected", "daily_reconciliation"):
        monkeypatch.setattr(job.reconcile, name, lambda *_: one.limit(0))
    return job.build_and_check(spark, {}, root, batch)


def _batches(spark, root):
    return {n: df.first()[0] for n, df in published(spark, root).items()}


def test_faults_while_publishing_leave_the_old_set_whole(spark, monkeypatch, tmp_path):
    root = str(tmp_path)
    assert published(spark, root) == {}
    _small_build(spark, monkeypatch, root, SELECTED_BATCH)
    old = dict.fromkeys((*job.PUBLISHED, "check_results"), SELECTED_BATCH)
    assert _batches(spark, root) == old
    with pytest.raises(CheckFailure):
        _small_build(spark, monkeypatch, root, SECOND_BATCH, failures=1)
    real = job.versions.publish
    monkeypatch.setattr(job.versions, "publish", lambda *_, **__: (_ for _ in ()).throw(OSError("disk gone")))
    with pytest.raises(OSError, match="disk gone"):
        _small_build(spark, monkeypatch, root, SECOND_BATCH)
    assert _batches(spark, root) == old
    monkeypatch.setattr(job.versions, "publish", real)
    _small_build(spark, monkeypatch, root, SECOND_BATCH)
    assert _batches(spark, root) == dict.fromkeys(old, SECOND_BATCH)


def test_of_two_builds_from_one_version_the_first_is_published(spark, monkeypatch, tmp_path):
    root = str(tmp_path)
    inner = lambda: job.versions.publish(spark, root, {"batch_id": "other", "tables": {}}, after=0)
    with pytest.raises(RuntimeError, match="another writer"):
        _small_build(spark, monkeypatch, root, SELECTED_BATCH, during=inner)
    assert job.versions.current(spark, root)[1]["batch_id"] == "other"


def test_register_views_for_sql(spark):
    b = build(raw_tables(spark, SMALL), SELECTED_BATCH)
    names = register_views(b, prefix="t_")
    assert "t_mart_daily_sales" in names
    n = spark.sql("SELECT count(*) FROM t_fct_order_items f JOIN t_dim_products p USING (product_id)").first()[0]
    assert n == b.fct_order_items.count()


def test_run_profile_writes_tables_and_gates(spark):
    from martlet.config import TABLES
    from martlet.operators.profile import run_profile
    from martlet.sources.driver_tables import extract

    clean = raw_tables(spark, SMALL)
    sources = {t: extract(spark, SMALL, t) for t in TABLES}
    root = tempfile.mkdtemp(prefix="martlet-profile-")
    paths = run_profile(clean, sources, SELECTED_BATCH, f"{root}/clean")
    assert spark.read.parquet(paths["gate"]).count() == 0
    assert spark.read.parquet(paths["orphans"]).count() == 9
    faulty = raw_tables(spark, SMALL, faulty=True)
    faulty_sources = {t: extract(spark, SMALL, t, faulty=True) for t in TABLES}
    with pytest.raises(RuntimeError, match="orders"):
        run_profile(faulty, faulty_sources, SELECTED_BATCH, f"{root}/faulty")


def test_profile_refuses_bad_ids_missing_tables_and_empty_batches(spark):
    from martlet.config import TABLES
    from martlet.operators.profile import run_profile
    from martlet.sources.driver_tables import extract

    raw = raw_tables(spark, SMALL)
    sources = {t: extract(spark, SMALL, t) for t in TABLES}
    root = tempfile.mkdtemp(prefix="martlet-profile-")
    with pytest.raises(ValueError):
        run_profile(raw, sources, "not-a-batch", f"{root}/a")
    with pytest.raises(ValueError, match="exactly"):
        run_profile({t: df for t, df in raw.items() if t != "users"}, sources, SELECTED_BATCH, f"{root}/b")
    with pytest.raises(RuntimeError, match="refused"):
        run_profile(raw, {t: df.limit(0) for t, df in sources.items()}, "20300101T000000Z", f"{root}/c")
