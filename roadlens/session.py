"""Session helpers: the caller owns the SparkSession; we read settings, or change them for one write or query.

Scratch output (round trips, stream checkpoints) lives under the shared
folder named by ``spark.checkpoint.dir``. A local default is set only when
the setting is missing, which is the case in unit tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    When the session names none, a folder under ``spark.sql.warehouse.dir``
    (the session's shared table storage) is set and used.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        root = ensure_checkpoint_dir(spark, f"{warehouse}/_checkpoints")
    return root.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession, default: str) -> str:
    """Use ``default`` as the checkpoint folder only where none is set (tests).

    ``spark.checkpoint.dir`` cannot change on a running session, so the
    fallback goes through ``SparkContext.setCheckpointDir``.
    """
    sc = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if not root:
        sc.setCheckpointDir(default)
        root = default
    elif sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/roadlens/{name}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]):
    """Queries started or tables written inside have these settings; the session's own come back afterwards."""
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def cut_lineage(df):
    """Reliable checkpoint into ``spark.checkpoint.dir`` (survives executor loss)."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_root(spark))
    return df.checkpoint(eager=True)


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once a session (``SparkContext.addPyFile``).

    Needed where executors do not have it installed and the driver was started
    from another folder; the driver serves the archive itself.
    """
    sc = spark.sparkContext
    if getattr(sc, "_roadlens_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="roadlens-"), "roadlens-src.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(archive)
    sc._roadlens_shipped = True
