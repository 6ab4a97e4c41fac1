import pytest
from pyspark.sql import functions as F

from dossier.functions import layout, metrics, privacy
from dossier.operators import grouping


@pytest.mark.parametrize("box, want", [
    ([10.0, 20.0, 30.0, 40.0], [33, 28, 100, 57]),
    ([-5.0, 0.0, 900.0, 2000.0], [0, 0, 1000, 1000]),
    ([1e18, -1e18, 99.99, 0.3], [1000, 0, 333, 0]),
    ([1.0, 2.0, 299.0, 699.0, 300.0, 700.0, 150.0, 350.0], [3, 2, 996, 998, 1000, 1000, 500, 500]),
])
def test_norm_box(value, box, want):
    """Expected by hand for a page of 300 by 700."""
    got = value(layout.norm_box, box, 300, 700, types=["array<double>", "int", "int"])
    assert got == want


def test_envelope(value):
    polygon = [4.0, 2.0, 1.0, 3.0, 2.0, 7.0, 3.0, -1.0]
    assert value(layout.envelope, polygon, types=["array<double>"]) == [1.0, -1.0, 4.0, 7.0]


@pytest.mark.parametrize("n", range(12, 41))
def test_no_digit_of_a_long_number_survives(value, n):
    digits = ("9876543210" * 4)[:n]
    got = value(lambda t, k: privacy.scrub_pii(t, k), f"no {digits}.", 7, types=["string", "int"])
    assert got.startswith("no #") and got.endswith(".") and len(got) == len("no #12345678.")


def test_zero_page(value, spark):
    assert value(layout.norm_box, [1.0, 2.0], 0, 5, types=["array<double>", "int", "int"]) is None
    pages = spark.createDataFrame([(1, [1.0, 2.0], 0, 5), (2, [1.0, 2.0], 4, 5)], "k int, b array<double>, w int, h int")
    assert [r.k for r in grouping.normalize_boxes(pages, "b", "w", "h").collect()] == [2]


def test_boxes(value):
    assert value(layout.int_box, [1.9, -1.9, 3.0], types=["array<double>"]) == [1, -1, 3]
    points = [[1.0, 2.0], [3.0, 2.0], [3.0, 4.0], [1.0, 4.0]]
    assert value(layout.flatten_polygon, points, types=["array<array<double>>"]) == [1.0, 2.0, 3.0, 2.0, 3.0, 4.0, 1.0, 4.0]


@pytest.mark.parametrize("n", [0, 7, 8, 9, 30])
def test_pack(value, n):
    seq = list(range(1, n + 1))
    got = value(lambda s: layout.pack(s, 8, -100), seq, types=["array<int>"])
    assert got == (seq + [-100] * 8)[:8]
    mask = value(lambda s: layout.attention_mask(s, 8), seq, types=["array<int>"])
    assert mask == [1] * min(n, 8) + [0] * max(0, 8 - n)


def test_labels(value):
    encode = lambda name, **kw: value(lambda c: layout.label_encode(c, **kw), name)
    assert encode("SKILL") == layout.LABELS_EN.index("SKILL")
    assert encode("what") == -1 and encode(None) == -1
    cn = dict(labels=layout.LABELS_CN, default=layout.UNKNOWN_CN)
    assert encode("what", **cn) == 17 and encode("PHONE", **cn) == 3
    back = lambda i: value(layout.id_to_label, i, types=["int"])
    assert back(-1) == "OTHERS" and back(0) == "PERSONAL_INFO" and back(12) == "OTHERS" and back(99) is None
    assert len(layout.LABELS_CN) == 18 and len(layout.LABELS_EN) == 13


def test_argmax(value):
    assert value(layout.argmax, [0.1, 0.7, 0.7, 0.2], types=["array<double>"]) == 1


def test_mask_ignored(spark):
    rows = spark.createDataFrame([(1, [3, -100, 4], [3, 9, 5])], "k int, gold array<int>, pred array<int>")
    got = grouping.mask_ignored(rows, "gold", "pred").head()
    assert got.gold == [3, 4] and got.pred == [3, 5]
    flat = spark.createDataFrame([(3, 3), (-100, 9), (-1, 2)], "gold int, pred int")
    assert grouping.mask_ignored(flat, "gold", "pred").count() == 2


def test_cosine(value):
    types = ["array<float>", "array<float>"]
    assert value(metrics.cosine, [1.0, 0.0], [1.0, 1.0], types=types) == pytest.approx(0.5 ** 0.5)
    assert value(metrics.cosine, [0.0, 0.0], [1.0, 1.0], types=types) == 0.0


def test_scrub_pii(value):
    scrub = lambda s: value(lambda t: privacy.scrub_pii(t, F.lit(7)), s)
    out = scrub("Mail a.b@c.example.org, card 4111111111111111, call +1 (830) 555-5433, host 10.1.2.3.")
    assert "a.b@" not in out and "4111" not in out and "(830)" not in out and "10.1.2.3" not in out
    assert "@example.com" in out and "192.0.2." in out and "555-01" in out and "#" in out
    assert out == scrub("Mail a.b@c.example.org, card 4111111111111111, call +1 (830) 555-5433, host 10.1.2.3.")
    assert scrub("Born 1990, grade 5.") == "Born 1990, grade 5."
