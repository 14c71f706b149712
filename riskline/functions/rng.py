"""Deterministic pseudo-random numbers shared by Spark and the SQL oracles.

``rand(seed)`` depends on partitioning and cannot be reproduced in SQL, so every seeded
choice (split order, folds, SMOTE neighbour pick and gap, noise) is a digest of key, salt and
seed: identical in both engines, independent of how rows are partitioned, and independent
between salts.  The integers have 60 bits, and keys of any size work.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 60
RANGE = float(1 << BITS)


def lcg_int(key: Column, salt: int | Column = 0, seed: int = 42) -> Column:
    """Integer in [0, 2^60) from (key, salt, seed)."""
    salt_c = salt if isinstance(salt, Column) else F.lit(salt)
    text = F.concat_ws("|", key.cast("bigint").cast("string"), salt_c.cast("bigint").cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, BITS // 4), 16, 10).cast("bigint")


def lcg_uniform(key: Column, salt: int | Column = 0, seed: int = 42) -> Column:
    """Uniform double in [0, 1)."""
    return lcg_int(key, salt, seed) / F.lit(RANGE)


def lcg_uniform_np(key: np.ndarray, salt: int, seed: int = 42) -> np.ndarray:
    """The same numbers for an array of keys inside a task."""
    digest = [int(hashlib.md5(f"{int(k)}|{salt}|{seed}".encode()).hexdigest()[: BITS // 4], 16) for k in key]
    return np.array(digest, dtype=np.float64) / RANGE


def lcg_int_sql(key: str, salt: str = "0", seed: int = 42) -> str:
    """The same generator as DuckDB SQL text (for oracles)."""
    text = f"CAST(CAST({key} AS BIGINT) AS VARCHAR) || '|' || CAST(CAST({salt} AS BIGINT) AS VARCHAR) || '|{seed}'"
    return f"CAST('0x' || substr(md5({text}), 1, {BITS // 4}) AS BIGINT)"


def lcg_uniform_sql(key: str, salt: str = "0", seed: int = 42) -> str:
    return f"(CAST({lcg_int_sql(key, salt, seed)} AS DOUBLE) / CAST({RANGE!r} AS DOUBLE))"
