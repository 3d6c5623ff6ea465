"""Test harness: write rows as time-ordered files for a file-source replay."""

import os
import time

import numpy as np
import pandas as pd


def write_files(spark, pdf: pd.DataFrame, schema, folder: str, n_files: int, start: int = 0) -> list[str]:
    """Split ``pdf`` (already in replay order) into ``n_files`` parquet folders
    with increasing modification times; returns their paths."""
    paths = []
    for k, part in enumerate(np.array_split(pdf, n_files)):
        p = os.path.join(folder, f"part{start + k:03d}")
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(p)
        paths.append(p)
        time.sleep(0.05)
    return paths


def sentinels(ts_max, id_base: int = 10**9, name: str = "__sentinel__") -> list[pd.DataFrame]:
    """Two far-future rows of a name not in the data: they move the watermark
    past every pending expiry."""
    far = pd.Timestamp(ts_max) + pd.Timedelta(days=6)
    return [pd.DataFrame({"id": [id_base + k], "ts": [far + pd.Timedelta(hours=3 * k)], "name": [name]})
            for k in range(2)]
