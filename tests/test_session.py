from types import SimpleNamespace

import pytest

from shelfwise import session


def stub(master, named=None, app="app-1"):
    context = SimpleNamespace(master=master, applicationId=app, getCheckpointDir=lambda: None)
    conf = SimpleNamespace(get=lambda key, default: named)
    return SimpleNamespace(sparkContext=context, conf=conf)


def test_the_named_folder_is_used():
    assert session.shared_dir(stub("yarn", "hdfs://shared/x/")) == "hdfs://shared/x"


def test_only_local_sessions_fall_back(tmp_path, monkeypatch):
    monkeypatch.setattr(session.tempfile, "mkdtemp", lambda prefix: str(tmp_path / prefix))
    first = session.shared_dir(stub("local[2]", app="app-x"))
    assert first == session.shared_dir(stub("local[2]", app="app-x"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(stub("spark://host:7077"))


def test_materialized_rows_have_no_history(spark):
    df = session.materialize(spark.range(10).selectExpr("id", "id * 2 as twice"))
    assert sorted(r["twice"] for r in df.collect()) == list(range(0, 20, 2))
    assert "Range" not in df._jdf.queryExecution().executedPlan().toString()
