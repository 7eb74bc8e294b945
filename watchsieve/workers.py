"""Python workers."""

from __future__ import annotations

import ctypes
import functools
import os
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import SparkSession


def find_library(spark: SparkSession) -> None:
    """Lets workers that start in another folder find this library by its path, where it is not installed."""
    environment, root = spark.sparkContext.environment, str(Path(__file__).parents[1])
    if root not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, environment.get("PYTHONPATH")]))


@functools.cache
def _trim() -> Callable[[int], object]:
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)


def given_back() -> None:
    """Gives memory that is free in this worker back to the system, which a worker that is reused would hold besides what its next task takes."""
    pa.default_memory_pool().release_unused()
    _trim()(0)
