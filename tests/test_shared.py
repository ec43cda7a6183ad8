"""Where tables between steps go."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from tidewarden.sources.shared import on_one_disk, shared_folder


def session(master: str, **conf: str) -> SimpleNamespace:
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d)), sparkContext=context)


def test_a_cluster_needs_a_shared_folder():
    local, shared = {"spark.sql.warehouse.dir": "file:/work/warehouse"}, {"spark.sql.warehouse.dir": "s3a://bucket/warehouse/"}
    with pytest.raises(ValueError):
        shared_folder(session("yarn", **local))
    assert shared_folder(session("local[8]", **local), "a").startswith("file:/work/warehouse/_steps/a-")
    assert shared_folder(session("yarn", **shared)).startswith("s3a://bucket/warehouse/_steps/tables-")
    assert shared_folder(session("yarn", **local, **{"spark.checkpoint.dir": "/mnt/shared"})).startswith("/mnt/shared/tables-")


def test_paths_of_one_machine():
    assert on_one_disk("file:/a") and on_one_disk("/a") and not on_one_disk("hdfs://n/a") and not on_one_disk("viewfs://n/a")
