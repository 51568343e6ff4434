import os
import tempfile

from parcelflow import schemas as S
from parcelflow.plans import jobs
from parcelflow.streaming.stage_feed import start_stage_feed
from tests.test_jobs import D1, D2, K1, K2, ledger, put_checks, put_full, record, stage_df


def test_stage_feed_integrates_each_landed_file(spark, root):
    put_full(spark, root, [(*K1, "A1")])
    put_checks(spark, root, [(1, K1), (2, K2)], None)
    jobs.integrate_job(spark, root, D1)            # first run seeds the ledger
    put_checks(spark, root, [(1, K1), (2, K2)], D2)
    landing = tempfile.mkdtemp(prefix="pf-landing-")
    ckpt = tempfile.mkdtemp(prefix="pf-stream-")
    stage_df(spark, [(*K1, "N1"), (*K2, "M1")], D2).write.mode("append").parquet(landing)
    q = start_stage_feed(spark, root, landing, checkpoint_location=ckpt)
    q.awaitTermination(120)
    assert ledger(spark, root).count() == 3
    assert record(spark, root, D2, K1) == [(1, 1, 2)]
    # A re-crawl of the same day lands later: the feed replaces, never doubles.
    stage_df(spark, [(*K1, "N1"), (*K1, "N2")], D2).write.mode("append").parquet(
        os.path.join(landing, "recrawl"))
    q = start_stage_feed(spark, root, landing + "/recrawl", checkpoint_location=ckpt + "2")
    q.awaitTermination(120)
    addrs = sorted(r.address for r in ledger(spark, root).collect())
    assert addrs == ["A1", "M1", "N1", "N2"]
    assert [f.name for f in S.STAGE.fields][-1] == "stage_date"


def test_replayed_micro_batch_gives_same_tables(spark, root):
    from parcelflow.streaming.stage_feed import integrate_batch
    put_full(spark, root, [(*K1, "A1")])
    put_checks(spark, root, [(1, K1)], None)
    jobs.integrate_job(spark, root, D1)
    put_checks(spark, root, [(1, K1)], D2)
    batch = stage_df(spark, [(*K1, "N1"), (*K1, "N2")], D2)
    integrate_batch(spark, root, batch)
    once = sorted(map(tuple, ledger(spark, root).select("address", "stage_date").collect()))
    integrate_batch(spark, root, batch)          # the same epoch again after a failure
    twice = sorted(map(tuple, ledger(spark, root).select("address", "stage_date").collect()))
    assert once == twice and len(once) == 3
    assert record(spark, root, D2, K1) == [(1, 2, 3)]
