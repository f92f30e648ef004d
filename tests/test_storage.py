from types import SimpleNamespace

import pytest

from signalwatch.storage import save, shared_dir, together


def stub(setting=None, current=None, master="local[2]"):
    state = {"dir": current}
    context = SimpleNamespace(
        master=master,
        getCheckpointDir=lambda: state["dir"],
        setCheckpointDir=lambda path: state.update(dir=f"{path}/id"),
    )
    conf = SimpleNamespace(get=lambda name, default=None: setting or default)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_the_folder_the_cluster_names_is_used():
    assert shared_dir(stub("hdfs://shared/", "other", "yarn")) == "hdfs://shared"
    assert shared_dir(stub(None, "hdfs://given", "yarn")) == "hdfs://given"


def test_a_folder_is_chosen_in_local_mode_only():
    local = stub()
    assert shared_dir(local).endswith("/id")
    assert shared_dir(local) == shared_dir(local)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(stub(master="spark://host:7077"))


def test_tables_are_recreated(spark, tmp_path):
    path = str(tmp_path / "t")
    save(spark.range(3), path)
    assert save(spark.range(2), path).count() == 2


def test_steps_run_together_and_errors_surface(spark):
    got = together(spark, {n: (lambda n=n: spark.range(n).count()) for n in (1, 2, 3)})
    assert got == {1: 1, 2: 2, 3: 3}
    with pytest.raises(ZeroDivisionError):
        together(spark, {"a": lambda: 1 / 0})
