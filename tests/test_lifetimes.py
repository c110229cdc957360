"""Written tables go with their lifetime; jobs leave their outputs only."""
import os
import tempfile

import pytest

from test_jobs import _corpus
from twinlens import session as ss
from twinlens.plans import jobs


def files(folder):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(folder) for f in fs if not f.endswith(".crc"))


def local(path):
    return path.removeprefix("file:")


@pytest.fixture
def scratch(spark):
    """The session's scratch folder; counts what is left in it."""
    run = local(ss._run_folder(spark))
    before = set(files(run))
    return lambda: [f for f in files(run) if f not in before]


def test_tables_go_with_the_innermost_lifetime(spark, scratch):
    with ss.lifetime(spark) as outer:
        a = ss.materialize(spark.range(5), "a")
        with ss.lifetime(spark) as inner:
            b = ss.materialize(spark.range(7), "b")
            c = inner.keep(ss.materialize(spark.range(9), "c"))
            assert b.count() == 7
        assert a.count() == 5 and c.count() == 9
        assert len(inner.paths) == 0 and len(outer.paths) == 2
        left = scratch()
        assert left and not any("/b-" in f for f in left)
    assert scratch() == []


def test_tables_go_after_an_error(spark, scratch):
    with pytest.raises(ZeroDivisionError), ss.lifetime(spark):
        ss.materialize(spark.range(5), "a")
        with ss.lifetime(spark):
            ss.materialize(spark.range(5), "b")
            1 / 0
    assert scratch() == [] and ss._OPEN.get() == ()


def test_discard_and_settled(spark, scratch):
    a = ss.materialize(spark.range(5), "a")
    assert scratch()
    report = ss.settled(a.groupBy().count())
    ss.discard(a)
    ss.discard(spark.range(3))
    assert scratch() == [] and report.collect()[0][0] == 5
    with pytest.raises(ValueError, match="bounded"):
        ss.settled(spark.range(20), 10)


def test_jobs_leave_their_outputs_only(spark, tmpdir_path, scratch):
    d, out = tmpdir_path, tempfile.mkdtemp(prefix="twinlens-out-")
    _corpus(d, 40)
    spec = jobs.FeatureSpec(image_size=8)
    jobs.train_job(spark, f"{d}/train.txt", d, f"{out}/model", spec, epochs=2, lr=0.05, hidden=8).collect()
    head, split = f"{out}/model/best_head", f"{out}/model/split"
    dist = jobs.predict_job(spark, f"{d}/test_without_label.txt", d, head, f"{out}/pred", spec)
    rep = jobs.ablation_job(spark, split, d, head, spec)
    n, first = jobs.bad_case_job(spark, split, d, head, f"{out}/bad", spec)
    rows, summary = jobs.audit_job(spark, f"{d}/train.txt", d, labelled=True, out_path=f"{out}/audit")
    assert scratch() == []
    # the reports stand without the tables they came from
    assert sum(r.n for r in dist.collect()) == 5 and rep.count() == 3 and n.count() == 1 and first.count() <= 5
    assert rows.count() == 40 and summary.collect()[0].total == 40
    assert sorted(os.listdir(out)) == ["audit", "bad", "model", "pred"]


def test_a_failed_job_leaves_nothing(spark, tmpdir_path, scratch):
    _corpus(tmpdir_path, 20)

    def broken():
        def encode(batch):
            raise RuntimeError("no encoder")
        return encode

    spec = jobs.FeatureSpec(image_size=8, image_encoder=broken)
    with pytest.raises(Exception, match="no encoder"):
        jobs.train_job(spark, f"{tmpdir_path}/train.txt", tmpdir_path, f"{tmpdir_path}/out", spec, epochs=1, hidden=4)
    assert scratch() == []
