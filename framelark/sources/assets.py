"""Lists of remote files, page by page, through any function that fetches JSON."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "path string, asset_id string, size long, sha256 string"


def listed(spark: SparkSession, first_page: str, get: Callable[[str], dict], digest: Callable[[str], str]) -> DataFrame:
    """(path, asset_id, size, sha256). get fetches a page with `results` and `next`; digest looks one file's digest up."""
    rows, page = [], first_page
    while page:
        got = get(page)
        rows += [(r["path"], r["asset_id"], int(r["size"]), digest(r["asset_id"])) for r in got["results"]]
        page = got.get("next")
    return spark.createDataFrame(rows, SCHEMA)
