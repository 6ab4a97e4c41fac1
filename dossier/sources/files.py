"""File listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.operators.collections import union_sources

# Fixed value: image extensions, in any case.
IMAGE_EXTENSIONS = ("png", "jpg", "jpeg")


def _any_case(extensions) -> str:
    """Glob for the extensions in any case, so that the listing itself filters."""
    each = ["".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in e) for e in extensions]
    return "*.{" + ",".join(each) + "}"


def scan_files(
    spark: SparkSession, roots: dict[str, str], exts=IMAGE_EXTENSIONS, content: bool = False
) -> DataFrame:
    """Files below several roots, by extension in any case, tagged with their root's name.

    Columns ``path``, ``length``, ``source``; ``content`` only on request, since the
    scan reads no bytes without it. Names starting with a dot or underscore are not
    listed by Spark.
    """
    columns = ["path", "length"] + (["content"] if content else [])
    return union_sources({
        name: spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true").option("pathGlobFilter", _any_case(exts))
        .load(root).select(*columns)
        for name, root in roots.items()
    })


def scan_pdfs(spark: SparkSession, folder: str, content: bool = False) -> DataFrame:
    """PDF files directly in a folder, extension in lower case only. Adds ``file``, the name."""
    columns = ["path", "length"] + (["content"] if content else [])
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(folder)
    return found.select(*columns, F.element_at(F.split("path", "/"), -1).alias("file"))
