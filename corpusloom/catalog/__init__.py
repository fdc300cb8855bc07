"""All registered queries with the SQL that checks them."""

from __future__ import annotations

import importlib

from pyspark.sql import DataFrame, SparkSession

FAMILIES = ["texts", "words", "stats", "vectors", "training", "files"]


def _catalogs():
    return [importlib.import_module(f"corpusloom.catalog.{name}").catalog for name in FAMILIES]


def all_queries():
    return {name: fn for catalog in _catalogs() for name, fn in catalog.queries.items()}


def all_sql():
    return {name: sql for catalog in _catalogs() for name, sql in catalog.sql.items()}


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    return all_queries()["top_collocates"](spark, sf)
