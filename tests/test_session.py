"""Checkpoint folder fallback when the session names none (subprocess, empty conf)."""

from __future__ import annotations

import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent(
    f"""
    import sys
    sys.path.insert(0, {ROOT!r})
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    assert spark.conf.get("spark.checkpoint.dir", None) is None
    from roadlens.session import checkpoint_root, cut_lineage
    root = checkpoint_root(spark)
    assert root.endswith("/_checkpoints"), root
    assert cut_lineage(spark.range(5)).count() == 5
    print("OK", root)
    """
)


def test_checkpoint_fallback_without_conf(tmp_path):
    conf = tmp_path / "conf"
    conf.mkdir()
    env = dict(os.environ, SPARK_CONF_DIR=str(conf))
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=300)
    assert "OK" in out.stdout, out.stderr[-2000:]
