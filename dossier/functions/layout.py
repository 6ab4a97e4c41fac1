"""Column expressions on boxes, token sequences and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label dictionaries, the position is the label id.
LABELS_CN = (
    "PERSONAL_INFO", "Nationality", "gender", "PHONE", "EMAIL", "BIRTHDAY",
    "NATIVE_PLACE", "REGISTERED_CITY", "POLITICAL_STATUS", "EDUCATION",
    "WORK_EXPERIENCE", "PROJECT_EXPERIENCE", "SKILL", "CERTIFICATION",
    "LANGUAGE", "SELF_EVALUATION", "HOBBY", "OTHER",
)
LABELS_EN = (
    "PERSONAL_INFO", "JOB_TITLE", "PROFESSIONAL_SUMMARY", "SKILL", "CERTIFICATION",
    "LANGUAGE", "EDUCATION", "WORK_EXPERIENCE", "HOBBY",
    "ADDITIONAL_ACTIVITY", "VOLUNTEERING", "PROJECT", "OTHERS",
)
# Ids of unknown labels, the ignored position, sequence length, box scale.
UNKNOWN_CN = LABELS_CN.index("OTHER")
UNKNOWN_EN = -1
IGNORED = -100
SEQUENCE_LENGTH = 512
BOX_SCALE = 1000


def label_encode(label: Column, labels=LABELS_EN, default: int = UNKNOWN_EN) -> Column:
    """Label name to id; ``default`` for unknown names."""
    ids = F.create_map(*[part for i, name in enumerate(labels) for part in (F.lit(name), F.lit(i))])
    return F.coalesce(F.try_element_at(ids, label), F.lit(default))


def id_to_label(i: Column, labels=LABELS_EN) -> Column:
    """Id to label name; negative ids count from the end, so -1 is the last label."""
    names = F.array(*[F.lit(name) for name in labels])
    return F.try_element_at(names, F.when(i < 0, i).otherwise(i + 1).cast("int"))


def int_box(box: Column) -> Column:
    """Coordinates cut to whole numbers."""
    return F.transform(box, lambda x: x.cast("int"))


def flatten_polygon(points: Column) -> Column:
    """Corner points to one flat coordinate list (four points give eight values)."""
    return F.flatten(points)


def envelope(coords: Column) -> Column:
    """Smallest upright box around a flat coordinate list: lowest x and y, highest x and y."""
    xs = F.filter(coords, lambda _, i: i % 2 == 0)
    ys = F.filter(coords, lambda _, i: i % 2 == 1)
    return F.array(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys))


def norm_box(coords: Column, width: Column, height: Column) -> Column:
    """Coordinates scaled to 0..1000 by page size, cut toward zero; null for a page of zero size.

    Even places are x, odd places y. Clamping comes before the cast, which would
    overflow on huge values.
    """

    def scaled(c, i):
        size = F.when(i % 2 == 0, width).otherwise(height).cast("double")
        value = F.lit(float(BOX_SCALE)) * (c.cast("double") / size)
        return F.greatest(F.lit(0.0), F.least(F.lit(float(BOX_SCALE)), value)).cast("int")

    return F.when((width != 0) & (height != 0), F.transform(coords, scaled))


def pack(seq: Column, n: int = SEQUENCE_LENGTH, pad: Column | int = 0) -> Column:
    """Exactly ``n`` items: cut, or filled up with ``pad``."""
    filler = pad if isinstance(pad, Column) else F.lit(pad)
    return F.slice(F.concat(seq, F.array_repeat(filler, n)), 1, n)


def attention_mask(seq: Column, n: int = SEQUENCE_LENGTH) -> Column:
    """1 for real items, 0 for filled ones, ``n`` long."""
    return pack(F.transform(seq, lambda _: F.lit(1)), n, 0)


def argmax(logits: Column) -> Column:
    """0-based place of the largest value, the first one on ties."""
    return (F.array_position(logits, F.array_max(logits)) - 1).cast("int")
