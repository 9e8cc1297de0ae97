"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the given tables (through ``cardlens.sources.views``) over
their whole extent; no id subsets, prefixes or row caps.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco
