"""Where stages go."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from footfall.session import shared_folder


def session(master, **settings):
    conf = SimpleNamespace(get=lambda name, default=None: settings.get(name.replace(".", "_"), default))
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_a_local_warehouse_serves_one_machine_only():
    warehouse = {"spark_sql_warehouse_dir": "file:/work/warehouse/"}
    assert shared_folder(session("local[2]", **warehouse)) == "file:/work/warehouse/_stages"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("spark://host:7077", **warehouse))
    assert shared_folder(session("yarn", spark_sql_warehouse_dir="hdfs://n/w")) == "hdfs://n/w/_stages"
    assert shared_folder(session("yarn", spark_checkpoint_dir="hdfs://n/c", **warehouse)) == "hdfs://n/c"
