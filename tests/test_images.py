"""Image effects against plain loops and known values."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.operators import images as im

RNG = np.random.default_rng(3)
PAGE = RNG.integers(0, 256, (9, 7)).astype(float)


@pytest.mark.parametrize("kind", ["ones", "upper_triangle", "lower_triangle", "x", "plus"])
def test_erode_and_dilate_by_loops(kind):
    k = im.kernel(3, 3, kind)
    low, high = np.zeros(PAGE.shape), np.zeros(PAGE.shape)
    for i in range(9):
        for j in range(7):
            inside = [(a, b) for a in range(3) for b in range(3) if k[a, b]]
            low[i, j] = min([PAGE[i + a - 1, j + b - 1] for a, b in inside if 0 <= i + a - 1 < 9 and 0 <= j + b - 1 < 7], default=255)
            high[i, j] = max([PAGE[i - a + 1, j - b + 1] for a, b in inside if 0 <= i - a + 1 < 9 and 0 <= j - b + 1 < 7], default=0)
    assert np.array_equal(im.erode(PAGE, RNG, kind=kind), low)
    assert np.array_equal(im.dilate(PAGE, RNG, kind=kind), high)
    assert (im.opening(PAGE, RNG, kind=kind) <= PAGE).all() and (im.closing(PAGE, RNG, kind=kind) >= PAGE).all()


def test_kernels():
    assert im.kernel(3, 3, "x").astype(int).tolist() == [[1, 0, 1], [0, 1, 0], [1, 0, 1]]
    assert im.kernel(3, 3, "plus").astype(int).tolist() == [[0, 1, 0], [1, 1, 1], [0, 1, 0]]
    assert im.kernel(5, 5, "ellipse").astype(int).tolist() == [[0, 0, 1, 0, 0], [1, 1, 1, 1, 1], [1, 1, 1, 1, 1], [1, 1, 1, 1, 1], [0, 0, 1, 0, 0]]
    with pytest.raises(ValueError):
        im.kernel(3, 3, "star")


def test_translation_and_overlays():
    moved = im.translation(PAGE, RNG, 2, -3)
    assert np.array_equal(moved[:6, 2:], PAGE[3:, :5]) and (moved[6:] == 255).all() and (moved[:, :2] == 255).all()
    assert (im.translation(PAGE, RNG, 7, 0) == 255).all()
    assert np.array_equal(im.overlay(PAGE, RNG, PAGE), PAGE)
    assert np.array_equal(im.overlay_weighted(PAGE, RNG, PAGE, 1, 0, 5), PAGE + 5)


def test_flat_pages_keep_their_level():
    flat = np.full((20, 30), 200.0)
    assert np.allclose(im.gaussian_blur(flat, RNG, 4), 200) and np.allclose(im.blur_zones(flat, RNG), 200)
    assert np.array_equal(im.ink_decay(flat, RNG), flat)
    assert 0.2 < (im.salt(flat, RNG) == 255).mean() < 0.4
    shade = im.border_shadow(flat, RNG, "right", 0.2, 0.5)
    assert (shade[:, -1] == 100).all() and (shade[:, 0] == 200).all()


def test_chains_follow_order_seed_and_state(spark):
    chain = [("pepper", {"amount": 0.2}), ("overlay_weighted", {"background": im.ORIGINAL, "alpha": 0.0, "beta": 1.0})]
    assert np.array_equal(im.applied(PAGE, chain, 5), PAGE)
    both = [("salt", {}), ("pepper", {})]
    assert not np.array_equal(im.applied(PAGE, both, 1), im.applied(PAGE, both[::-1], 1))
    with pytest.raises(ValueError):
        im.applied(PAGE, [("nothing", {})], 1)
    raw = PAGE.astype(np.uint8).tobytes()
    got = spark.createDataFrame([(bytearray(raw), 1), (bytearray(raw), 2), (None, 3), (bytearray(b""), 4)], "b binary, s long").select("s", im.chained(both)("b", F.lit(7), "s").alias("o")).collect()
    out = {r["s"]: r["o"] for r in got}
    assert bytes(out[1]) == im.applied(PAGE, both, 1).astype(np.uint8).tobytes() != bytes(out[2])
    assert out[3] is None and bytes(out[4]) == b""


def test_jpeg_size(spark):
    head = b"\xff\xd8\xff\xe0" + struct.pack(">H", 4) + b"ab"
    whole = head + b"\xff\xff\xc2" + struct.pack(">HBHH", 11, 8, 480, 640) + b"\x03xxx"
    assert im.frame_size(whole) == (640, 480)
    assert im.frame_size(head) is None and im.frame_size(None) is None and im.frame_size(b"PNG") is None
    rows = spark.createDataFrame([(1, bytearray(whole)), (2, bytearray(head)), (3, None)], "k int, b binary").select("k", im.jpeg_size(F.col("b")).alias("z")).collect()
    assert {r["k"]: r["z"] and tuple(r["z"]) for r in rows} == {1: (640, 480), 2: None, 3: None}
