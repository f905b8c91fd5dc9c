"""Tables that are computed once and read several times by one query."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame


def settled(rows: DataFrame) -> DataFrame:
    """rows, computed now and read from the folder that spark.checkpoint.dir names from here on.

    Where the session names none, a temporary one is made if all runs in this process; on a cluster that is an error, as
    each machine would write to a folder of its own.
    """
    spark = rows.sparkSession
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="settled-"))
    return rows.checkpoint(eager=True)
