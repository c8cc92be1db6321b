"""Effects on grey page images: chains of named effects with options, over a binary column.

An image is a float array from 0 (ink) to 255 (paper). A chain's effects follow each other and share one
generator, so what comes out depends on the image, the chain and the seed alone, on whatever executor.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

Chain = Sequence[tuple[str, dict[str, Any]]]
ACTIONS: dict[str, Callable[..., np.ndarray]] = {}
#: Options with these values stand for the image as it came in, and as the chain has left it so far.
ORIGINAL, CURRENT = "ORIGINAL", "CURRENT"


def action(f: Callable[..., np.ndarray]) -> Callable[..., np.ndarray]:
    ACTIONS[f.__name__] = f
    return f


def kernel(rows: int, cols: int, kind: str = "ones") -> np.ndarray:
    """A mask of a neighbourhood: ones, upper_triangle, lower_triangle, x, plus or ellipse."""
    y, x = np.mgrid[:rows, :cols]
    if kind == "ones":
        return np.ones((rows, cols), bool)
    if kind == "upper_triangle":
        return x >= y
    if kind == "lower_triangle":
        return x <= y
    if kind == "x":
        return (x == y) | (x == cols - 1 - y)
    if kind == "plus":
        return (y == rows // 2) | (x == cols // 2)
    if kind == "ellipse":
        ry, rx = rows // 2, cols // 2
        reach = np.rint(rx * np.sqrt(np.maximum(0, 1 - ((y - ry) / max(1, ry)) ** 2)))
        return np.abs(x - rx) <= reach
    raise ValueError(f"no kernel {kind!r}")


def _around(x: np.ndarray, mask: np.ndarray, pick: Callable, outside: float) -> np.ndarray:
    """pick over the neighbours under mask; what lies outside never wins."""
    top, left = mask.shape[0] // 2, mask.shape[1] // 2
    p = np.pad(x, ((top, mask.shape[0] - 1 - top), (left, mask.shape[1] - 1 - left)), constant_values=outside)
    out = np.full(x.shape, outside, float)
    for i, j in np.argwhere(mask).tolist():
        out = pick(out, p[i : i + x.shape[0], j : j + x.shape[1]])
    return out


@action
def erode(x, rng, rows=3, cols=3, kind="ones"):
    return _around(x, kernel(rows, cols, kind), np.minimum, 255.0)


@action
def dilate(x, rng, rows=3, cols=3, kind="ones"):
    return _around(x, kernel(rows, cols, kind)[::-1, ::-1], np.maximum, 0.0)


@action
def opening(x, rng, **shape):
    return dilate(erode(x, rng, **shape), rng, **shape)


@action
def closing(x, rng, **shape):
    return erode(dilate(x, rng, **shape), rng, **shape)


@action
def gaussian_blur(x, rng, radius=5):
    """A bell of 2 radius + 1 taps along each axis; edges are mirrored."""
    if radius < 1:
        return x
    d = np.arange(-radius, radius + 1)
    taps = np.exp(-0.5 * (d / (0.5 * radius)) ** 2)
    taps /= taps.sum()
    for axis in (0, 1):
        p = np.pad(x, [(radius, radius) if a == axis else (0, 0) for a in (0, 1)], mode="symmetric")
        x = sum(t * np.take(p, np.arange(i, i + x.shape[axis]), axis) for i, t in enumerate(taps))
    return x


@action
def blur_zones(x, rng, radius=3, zones=2, coverage=0.2, feather=0.5):
    """Some ellipses of blur whose rims fade; together they have about that share of the page."""
    soft, weight = gaussian_blur(x, rng, radius), np.zeros(x.shape)
    h, w = x.shape
    y, c = np.mgrid[:h, :w]
    size = np.sqrt(coverage / max(1, zones) / np.pi)
    for _ in range(zones):
        far = np.hypot((y - rng.uniform(0, h)) / max(1.0, size * h), (c - rng.uniform(0, w)) / max(1.0, size * w))
        weight = np.maximum(weight, np.clip((1 - far) / max(feather, 1e-6), 0, 1))
    return x + weight * (soft - x)


@action
def translation(x, rng, right=0, down=0):
    """The page moved; paper comes in behind it."""
    out = np.full(x.shape, 255.0)
    h, w = x.shape
    if abs(down) < h and abs(right) < w:
        out[max(0, down) : h + min(0, down), max(0, right) : w + min(0, right)] = x[max(0, -down) : h + min(0, -down), max(0, -right) : w + min(0, -right)]
    return out


@action
def overlay_weighted(x, rng, background=CURRENT, alpha=0.5, beta=0.5, gamma=0.0):
    return alpha * x + beta * background + gamma


@action
def overlay(x, rng, background=CURRENT):
    """Bitwise and of both."""
    return (np.rint(x).astype(np.uint8) & np.rint(background).astype(np.uint8)).astype(float)


@action
def show_through(x, rng, background=ORIGINAL, alpha=0.8, gamma=0.0, right=0, down=5):
    """The back of the sheet: background mirrored and moved, then mixed in."""
    back = translation(background[:, ::-1], rng, right, down)
    return alpha * x + (1 - alpha) * back + gamma


def _speckled(x, rng, amount, value):
    return np.where(rng.random(x.shape) < amount, value, x)


@action
def pepper(x, rng, amount=0.05):
    return _speckled(x, rng, amount, 0.0)


@action
def salt(x, rng, amount=0.3):
    return _speckled(x, rng, amount, 255.0)


@action
def salt_then_pepper(x, rng, salt_amount=0.1, pepper_amount=0.05):
    return pepper(salt(x, rng, salt_amount), rng, pepper_amount)


@action
def pepper_then_salt(x, rng, pepper_amount=0.05, salt_amount=0.1):
    return salt(pepper(x, rng, pepper_amount), rng, salt_amount)


@action
def halftone_screen(x, rng, cell=4.0, angle=45.0, strength=0.65):
    """Dots of a turned screen of crossed waves: paper where the page is lighter than the screen, ink elsewhere, mixed in
    by strength. No strength or no cell leaves the page as it is."""
    if strength <= 0 or cell <= 0:
        return x
    y, c = np.mgrid[: x.shape[0], : x.shape[1]]
    turn = np.deg2rad(angle)
    u, v = (c * np.cos(turn) + y * np.sin(turn)) / cell, (y * np.cos(turn) - c * np.sin(turn)) / cell
    screen = 127.5 * (np.sin(2 * np.pi * u) * np.sin(2 * np.pi * v) + 1)
    mixed = (1 - strength) * x + strength * np.where(x > screen, 255.0, 0.0)
    return np.where(x >= 1, mixed, x * mixed)


@action
def scan_banding(x, rng, period=38.0, amplitude=0.055, tilt=0.0):
    """Light and dark bands across the page, tilted by degrees: fine ones of the period, and coarse ones of about ten."""
    if amplitude <= 0 or period <= 1:
        return x
    y, c = np.mgrid[: x.shape[0], : x.shape[1]]
    along, phase, wide = y + c * np.tan(np.deg2rad(tilt)), rng.uniform(0, 2 * np.pi), rng.uniform(7, 13)
    fine, coarse = np.sin(2 * np.pi * along / period + phase), np.sin(2 * np.pi * along / (period * wide) + phase / 2)
    return x * (1 + amplitude * (0.72 * fine + 0.28 * coarse))


#: The luminance quantisers of the JPEG standard, by rows.
LUMINANCE = np.array(
    """16 11 10 16 24 40 51 61  12 12 14 19 26 58 60 55  14 13 16 24 40 57 69 56  14 17 22 29 51 87 80 62
    18 22 37 56 68 109 103 77  24 35 55 64 81 104 113 92  49 64 78 87 103 121 120 101  72 92 95 98 112 100 103 99""".split(),
    float,
).reshape(8, 8)
_K = np.arange(8)
_WAVES = np.sqrt(np.where(_K[:, None] == 0, 0.125, 0.25)) * np.cos(np.pi * (2 * _K[None, :] + 1) * _K[:, None] / 16)


def _coarser(x: np.ndarray, quality: int) -> np.ndarray:
    """The page after its blocks of 8 by 8 have lost what quantisers of that quality lose."""
    scale = 5000 / quality if quality < 50 else 200 - 2 * quality
    step = np.clip(np.floor((LUMINANCE * scale + 50) / 100), 1, 255)
    h, w = x.shape
    p = np.pad(x, ((0, -h % 8), (0, -w % 8)), mode="edge") - 128
    blocks = p.reshape(p.shape[0] // 8, 8, p.shape[1] // 8, 8).transpose(0, 2, 1, 3)
    back = _WAVES.T @ (np.rint(_WAVES @ blocks @ _WAVES.T / step) * step) @ _WAVES
    return back.transpose(0, 2, 1, 3).reshape(p.shape)[:h, :w] + 128


@action
def jpeg_blocks(x, rng, quality=28, passes=2):
    """Saved that many times, each time a little worse, but never below a quality of 5."""
    for i in range(passes):
        x = np.clip(np.rint(_coarser(x, max(int(quality) - 4 * i, 5))), 0, 255)
    return x


PLACES = ("center", "border", "corner")


def ragged(n: int, rng: np.random.Generator, roughness: float = 1.0) -> np.ndarray:
    """The depth of a tear along n places, from 0.05 to 1: a random walk smoothed widely and narrowly."""

    def walk(width: int) -> np.ndarray:
        path = np.convolve(np.cumsum(rng.standard_normal(n)), np.ones(max(1, width)) / max(1, width), "same")
        path -= path.mean()
        return path / max(np.abs(path).max(), 1e-9)

    return np.clip(0.55 + roughness * (0.3 * walk(max(n // 6, 3)) + 0.055 * walk(max(n // 90, 2))), 0.05, 1)


def torn(size: int, rng: np.random.Generator, roughness: float = 1.0, place: str = "center") -> np.ndarray:
    """True where the paper is gone in a square: from its upper edge, from its upper left corner, or around its middle."""
    size = max(int(size), 8)
    y, c = np.mgrid[:size, :size]
    if place == "border":
        return y < (ragged(size, rng, roughness) * size)[None, :]
    if place == "corner":
        return y + c < (ragged(2 * size, rng, roughness) * size * 1.3)[np.clip(c - y + size, 0, 2 * size - 1)]
    angle = np.arctan2(y - size / 2, c - size / 2)
    radius = 1 + roughness * sum(w * np.sin(k * angle + rng.uniform(0, 2 * np.pi)) for k, w in ((2, 0.3), (3, 0.22), (5, 0.14), (9, 0.09), (17, 0.05), (31, 0.03)))
    return np.hypot(y - size / 2, c - size / 2) < np.clip(radius, 0.25, 2) * size * 0.46


@action
def holes(x, rng, count=2, place="border", size_ratio=0.05, fill=0.0, outside=0.0, roughness=1.0, shadow=3, shade=0.45):
    """Torn holes at the page's middle, borders or corners, of a colour of their own, with a shade along their edge.

    outside: the share of a hole that lies beyond its border or corner.
    """
    if place not in PLACES:
        raise ValueError(f"holes are at one of {PLACES}")
    h, w = x.shape
    size = max(int(size_ratio * min(h, w)), 8)
    gone = np.zeros(x.shape, bool)
    for _ in range(int(count)):
        turn = int(rng.integers(4)) if place != "center" else 0
        mask = np.rot90(torn(size, rng, roughness, place), turn)
        out = int(size * outside) if place != "center" else 0
        far = {"top": -out, "left": -out, "bottom": h - size + out, "right": w - size + out}
        along = lambda span: int(rng.integers(-(size // 3), max(span - size + size // 3, 1 - size // 3)))
        if place == "center":
            top, left = int(rng.integers(max(h - size, 1))), int(rng.integers(max(w - size, 1)))
        elif place == "border":
            side = ("top", "left", "bottom", "right")[turn]
            top, left = (far[side], along(w)) if side in ("top", "bottom") else (along(h), far[side])
        else:
            top, left = (far["top"], far["bottom"])[turn in (1, 2)], (far["left"], far["right"])[turn in (2, 3)]
        a, b = max(top, 0), max(left, 0)
        part = mask[a - top : h - top, b - left : w - left]
        gone[a : a + part.shape[0], b : b + part.shape[1]] |= part
    edge = gone
    out = x.copy()
    for k in range(shadow):
        wider = _around(edge.astype(float), kernel(3, 3), np.maximum, 0.0) > 0
        out[wider & ~edge] *= 1 - shade * (1 - k / shadow)
        edge = wider
    out[gone] = fill
    return out


@action
def pattern_stamp(x, rng, pattern=None, alpha=0.5, scale=1.0):
    """A pattern laid at a random place of the page and multiplied in by alpha; a ring where none is given."""
    if pattern is None:
        n = max(8, int(scale * min(x.shape) / 4))
        y, c = np.mgrid[:n, :n]
        far = np.hypot(y - n / 2, c - n / 2) / (n / 2)
        pattern = np.where((far > 0.8) & (far < 0.95), 60.0, 255.0)
    h, w = min(pattern.shape[0], x.shape[0]), min(pattern.shape[1], x.shape[1])
    top, left = int(rng.integers(x.shape[0] - h + 1)), int(rng.integers(x.shape[1] - w + 1))
    out = x.copy()
    out[top : top + h, left : left + w] *= 1 - alpha + alpha * pattern[:h, :w] / 255
    return out


@action
def stain(x, rng, count=1, strength=0.3, size_ratio=0.3):
    """Soft stains that darken the paper and leave the ink, darker at their rim."""
    y, c = np.mgrid[: x.shape[0], : x.shape[1]]
    gain = np.ones(x.shape)
    for _ in range(count):
        radius = max(2.0, size_ratio * min(x.shape) * rng.uniform(0.5, 1))
        far = np.hypot(y - rng.uniform(0, x.shape[0]), c - rng.uniform(0, x.shape[1])) / radius
        gain *= 1 - strength * np.where(far < 1, 0.4 + 0.6 * far**4, 0.0)
    return x * gain


@action
def border_shadow(x, rng, border="left", distance_ratio=0.1, intensity=0.5):
    """A shade that fades inwards from one border over that share of the page."""
    turns = {"top": 0, "right": 1, "bottom": 2, "left": 3}[border]
    page = np.rot90(x, turns)
    deep = max(1, round(distance_ratio * page.shape[0]))
    shade = 1 - intensity * np.clip(1 - np.arange(page.shape[0]) / deep, 0, 1)
    return np.rot90(page * shade[:, None], -turns)


@action
def ink_decay(x, rng, level=3, density=0.01, threshold=128.0):
    """Round spots at random ink pixels in which the ink pales; more and larger with the level, from 1 to 10."""
    ink = np.argwhere(x < threshold)
    n = min(len(ink), round(len(ink) * density * level))
    if not n:
        return x
    y, c = np.mgrid[: x.shape[0], : x.shape[1]]
    out = x.copy()
    for i, j in ink[np.sort(rng.choice(len(ink), n, replace=False))].tolist():
        r = rng.uniform(0.5, 0.5 + level / 4)
        spot = (y - i) ** 2 + (c - j) ** 2 <= r * r
        out[spot] += (255 - out[spot]) * rng.uniform(0.3, 0.9)
    return out


@action
def paper_grain(x, rng, alpha=1.0, grain=0.04, creases=0):
    """The page multiplied with a sheet that has grain and straight creases."""
    sheet = 1 + grain * rng.standard_normal(x.shape)
    y, c = np.mgrid[: x.shape[0], : x.shape[1]]
    for _ in range(creases):
        turn = rng.uniform(0, np.pi)
        far = np.abs((y - rng.uniform(0, x.shape[0])) * np.cos(turn) + (c - rng.uniform(0, x.shape[1])) * np.sin(turn))
        sheet -= 0.15 * np.clip(1 - far / 2, 0, 1)
    return x * (1 - alpha + alpha * np.clip(sheet, 0, 1))


def applied(x: np.ndarray, chain: Chain, seed: int) -> np.ndarray:
    """The image after the chain, rounded to bytes after each effect."""
    rng, first = np.random.default_rng(seed), x.astype(float)
    x = first
    for name, options in chain:
        if name not in ACTIONS:
            raise ValueError(f"no effect {name!r}")
        state = {ORIGINAL: first, CURRENT: x}
        given = dict(options)
        if name in ("overlay", "overlay_weighted", "show_through"):
            given.setdefault("background", ORIGINAL)
        given = {k: state.get(v, v) if isinstance(v, str) else v for k, v in given.items()}
        x = np.clip(np.rint(ACTIONS[name](x, rng, **given)), 0, 255)
    return x


def chained(chain: Chain) -> Callable[[Column, Column, Column], Column]:
    """A column function of (grey bytes, width, seed). A null or empty image gives itself."""
    chain = [(n, dict(o)) for n, o in chain]

    def run(image: pd.Series, width: pd.Series, seed: pd.Series) -> pd.Series:
        return pd.Series([b if not b else applied(np.frombuffer(b, np.uint8).reshape(-1, int(w)), chain, int(s)).astype(np.uint8).tobytes() for b, w, s in zip(image, width, seed, strict=True)], dtype=object)

    return F.pandas_udf(run, BinaryType())


def frame_size(data: bytes | None) -> tuple[int, int] | None:
    """(width, height) that a JPEG's frame header gives, without decoding; None where there is no such header."""
    data = data or b""
    if data[:2] != b"\xff\xd8":
        return None
    at = 2
    while at + 9 <= len(data) and data[at] == 0xFF:
        mark = data[at + 1]
        if mark == 0xFF or mark == 0x01 or 0xD0 <= mark <= 0xD8:  # fill bytes and marks without a body
            at += 1 if mark == 0xFF else 2
            continue
        if 0xC0 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC):
            height, width = struct.unpack(">HH", data[at + 5 : at + 9])
            return width, height
        at += 2 + struct.unpack(">H", data[at + 2 : at + 4])[0]
    return None


def jpeg_size(content: Column) -> Column:
    """struct(width, height) of JPEG bytes, null where they aren't a JPEG's."""

    def run(content: pd.Series) -> pd.DataFrame:
        found = [frame_size(b) or (None, None) for b in content]
        return pd.DataFrame({"width": pd.array([w for w, _ in found], "Int64"), "height": pd.array([h for _, h in found], "Int64")})

    got = F.pandas_udf(run, "width bigint, height bigint")(content)
    return F.when(got["width"].isNotNull(), got)
