"""Settings: defaults with a user's values over them."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import SparkSession


def overlay(defaults: Mapping, user: Mapping | None, deep: bool = True) -> dict:
    """defaults with user's values over them; deep: a mapping inside both is merged too, else it is replaced whole."""
    out = dict(defaults)
    for key, value in (user or {}).items():
        both = deep and isinstance(value, Mapping) and isinstance(out.get(key), Mapping)
        out[key] = overlay(out[key], value) if both else value
    return out


def read_config(spark: SparkSession, path: str, defaults: Mapping, deep: bool = True) -> dict:
    """A JSON file's settings over defaults; the file may lie in any store that Spark reads."""
    return overlay(defaults, json.loads(spark.read.text(path, wholetext=True).first()[0]), deep)
