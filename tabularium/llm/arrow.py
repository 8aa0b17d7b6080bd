"""Column functions over whole Arrow batches."""

from __future__ import annotations

import ctypes
import gc
import pickle
import sys
from collections.abc import Callable, Iterator
from types import ModuleType
from typing import Any

import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def batchwise(kind: str, run: Callable[[Iterator[pa.Array]], Iterator[pa.Array]]) -> Callable[..., Column]:
    """A column function of type ``kind`` from one over the batches of a partition.

    Spark tells kinds of UDF apart by real annotations, not by postponed ones. It is called
    nondeterministic so that Spark does not run it twice where two expressions use its result.
    """
    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, kind).asNondeterministic()


def batchwise_pairs(
    kind: str, run: Callable[[Iterator[tuple[pa.Array, pa.Array]]], Iterator[pa.Array]]
) -> Callable[..., Column]:
    """The same over two columns."""
    run.__annotations__ = {
        "batches": Iterator[tuple[pa.Array, pa.Array]],
        "return": Iterator[pa.Array],
    }
    return F.arrow_udf(run, kind).asNondeterministic()


def lasting() -> dict[str, Any]:
    """What stays for the life of a Python process.

    Functions that travel with the plan bring their modules' globals along, so these start anew with every
    task, and the last task's go only with the garbage.
    """
    return sys.modules.setdefault("tabularium_lasting", ModuleType("tabularium_lasting")).__dict__


def tidy() -> None:
    """Give back what earlier tasks of this Python process have left, to the system and not only to its allocators."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


class Sent:
    """A broadcast value whose classes travel with it, as executors need no copy of this package."""

    def __init__(self, packed: Broadcast):
        self.packed = packed

    @property
    def value(self) -> Any:
        """Unpacked anew each time; ask once per task. What earlier tasks left is given back first."""
        tidy()
        return pickle.loads(self.packed.value)


def send(spark: SparkSession, value: Any) -> Sent:
    return Sent(spark.sparkContext.broadcast(cloudpickle.dumps(value)))


def free_name(frame: DataFrame, base: str) -> str:
    """A column name that the frame does not have, in any case."""
    taken = {name.lower() for name in frame.columns}
    while base.lower() in taken:
        base += "_"
    return base
