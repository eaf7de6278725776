"""Tables that are computed once and outlive lost executors."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame


def kept(df: DataFrame) -> DataFrame:
    """df by a reliable checkpoint in the folder of spark.checkpoint.dir; only a session in one JVM may go without it."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        root = sc.getConf().get("spark.checkpoint.dir") or df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not root and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(root or "file://" + tempfile.mkdtemp(prefix="skein-"))
    return df.checkpoint(eager=True)
