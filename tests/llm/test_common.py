from __future__ import annotations

from types import SimpleNamespace

import pytest

from forecourt.llm.common import shared_folder


def session(master, folder=None):
    context = SimpleNamespace(master=master, getConf=lambda: {"spark.checkpoint.dir": folder} if folder else {})
    return SimpleNamespace(sparkContext=context)


def test_clusters_need_a_shared_folder():
    assert shared_folder(session("spark://host:7077", "hdfs://host/x/")) == "hdfs://host/x"
    assert shared_folder(session("local[2]")).startswith("file:")
    with pytest.raises(ValueError, match="checkpoint"):
        shared_folder(session("spark://host:7077"))
