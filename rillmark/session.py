"""Session helpers. On a cluster the caller's session is used as it is."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cores: int | str = 8, app: str = "rillmark", memory: str = "8g") -> SparkSession:
    """A local session for tests and benches."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> None:
    """Days, hours and epoch times are UTC throughout, whatever the caller's zone."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


_held: dict[tuple[int, str], tuple[int, str | None]] = {}
_holding = threading.Lock()


@contextmanager
def holding(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the caller's session for the time of a block; its own value is back afterwards.

    Blocks of several threads share it: the last one to end puts the caller's
    value back, so none loses the setting half way.
    """
    name = (id(spark), key)
    with _holding:
        n, own = _held.get(name) or (0, spark.conf.get(key, None))
        _held[name] = (n + 1, own)
        spark.conf.set(key, value)
    try:
        yield
    finally:
        with _holding:
            n, own = _held.pop(name)
            if n > 1:
                _held[name] = (n - 1, own)
            elif own is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, own)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``. Only where
    that is unset (local tests) a local temporary folder is used.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="rillmark-")
    return os.path.join(root, f"{purpose}-{uuid.uuid4().hex}")
