"""Helpers of the operators."""

from __future__ import annotations

import pytest

from flowstats.llm import common


class Session:
    class conf:  # noqa: N801
        settings = {"spark.master": "spark://host:7077"}

        @classmethod
        def get(cls, key, default=None):
            return cls.settings.get(key, default)


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        common.shared_dir(Session)


def test_addresses_as_spark_writes_them(tmp_path):
    from pyarrow.fs import LocalFileSystem, S3FileSystem

    from flowstats.llm.common import open_store

    for uri in (str(tmp_path), f"file:{tmp_path}", f"file://{tmp_path}"):
        store, path = open_store(uri)
        assert isinstance(store, LocalFileSystem) and path == str(tmp_path)
    store, path = open_store("s3a://bucket/a/b?region=eu-west-1")
    assert isinstance(store, S3FileSystem) and path == "bucket/a/b"
