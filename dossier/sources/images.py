"""Sizes of images from their first bytes."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.sources.files import scan_files

# Fixed values of the two formats: signature, and the JPEG markers that start a frame or stand alone.
PNG = b"\x89PNG\r\n\x1a\n"
FRAMES = {0xC0, 0xC1, 0xC2, 0xC3, 0xC5, 0xC6, 0xC7, 0xC9, 0xCA, 0xCB, 0xCD, 0xCE, 0xCF}
ALONE = {0x01, *range(0xD0, 0xD8)}


def image_size(raw: bytes | None) -> tuple[int, int]:
    """Width and height; ValueError says what is wrong with a header."""
    if not raw:
        raise ValueError("empty")
    if raw.startswith(PNG):
        if len(raw) < 24 or raw[12:16] != b"IHDR":
            raise ValueError("cut off")
        size = int.from_bytes(raw[16:20]), int.from_bytes(raw[20:24])
    elif raw.startswith(b"\xff\xd8"):
        size = _frame_size(raw)
    else:
        raise ValueError("unknown format")
    if 0 in size:
        raise ValueError("no size")
    return size


def _frame_size(raw: bytes) -> tuple[int, int]:
    """Walk the segments of a JPEG up to the one that describes the frame."""
    at = 2
    while at + 4 <= len(raw):
        if raw[at] != 0xFF:
            raise ValueError("broken segment")
        marker = raw[at + 1]
        if marker == 0xFF or marker in ALONE:  # fill bytes, markers without a segment
            at += 1 if marker == 0xFF else 2
        elif marker in (0xD9, 0xDA):
            raise ValueError("no frame")
        elif marker in FRAMES:
            if at + 9 > len(raw):
                break
            return int.from_bytes(raw[at + 7:at + 9]), int.from_bytes(raw[at + 5:at + 7])
        else:
            length = int.from_bytes(raw[at + 2:at + 4])
            if length < 2:
                raise ValueError("broken segment")
            at += 2 + length
    raise ValueError("cut off")


def page_dims(images: DataFrame, content: str = "content") -> tuple[DataFrame, DataFrame]:
    """(good, bad): ``width`` and ``height`` of each image, or the ``reason`` why there is none, with the other columns.

    ``images`` has the bytes in ``content``; only a few numbers of each leave the task.
    """
    others = [c for c in images.columns if c != content]

    def run(batches):
        for batch in batches:
            sizes, reasons = [], []
            for raw in batch.column(len(others)).to_pylist():
                try:
                    sizes.append(image_size(raw))
                    reasons.append(None)
                except ValueError as problem:
                    sizes.append((None, None))
                    reasons.append(str(problem))
            columns = [*batch.columns[: len(others)], *(pa.array([s[i] for s in sizes], pa.int64()) for i in (0, 1)), pa.array(reasons, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*others, "width", "height", "reason"])

    kept = images.select(*others)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    sized = images.select(*others, content).mapInArrow(run, f"{kinds}, width long, height long, reason string")
    return sized.filter(F.col("reason").isNull()).drop("reason"), sized.filter(F.col("reason").isNotNull()).drop("width", "height")


def read_page_dims(spark: SparkSession, roots: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Sizes of all images below several roots, and the files without one: ``path``, ``length``, ``source`` and the size or reason."""
    return page_dims(scan_files(spark, roots, content=True))
