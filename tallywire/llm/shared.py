"""Objects of this package on every executor."""

from __future__ import annotations

import pickle
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import SparkSession


class Shared:
    """A broadcast object, sent with its class so that workers need no copy of the package."""

    def __init__(self, spark: SparkSession, value: Any):
        self._packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def value(self) -> Any:
        return pickle.loads(self._packed.value)
