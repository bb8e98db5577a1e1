"""Frames with known particles: dark outlines on a bright field, blurred, shaded and noisy as told."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from skiagram.kernel.outlines import Polygon, covered
from skiagram.sources.images import block_mean  # noqa: F401  (frames may be made smaller)

DARK, BRIGHT, FINE = 15.0, 200.0, 8


class Disc(NamedTuple):
    kind: str
    cx: float
    cy: float
    a: float
    b: float
    angle: float = 0.0
    blur: float = 0.0


def outline(d: Disc) -> np.ndarray:
    t = np.arange(128) * 2 * np.pi / 128
    if d.kind == "ellipse":
        x, y = d.a * np.cos(t), d.b * np.sin(t)
    elif d.kind == "rect":
        x, y = np.array([-d.a, d.a, d.a, -d.a]), np.array([-d.b, -d.b, d.b, d.b])
    elif d.kind == "blob":
        wave = 1 + 0.15 * np.cos(3 * t) + 0.08 * np.sin(5 * t)
        x, y = d.a * wave * np.cos(t), d.b * wave * np.sin(t)
    else:
        raise ValueError(f"unknown kind {d.kind!r}")
    c, s = np.cos(d.angle), np.sin(d.angle)
    return np.column_stack([d.cx + c * x - s * y, d.cy + s * x + c * y])


def blurred(a: np.ndarray, sigma: float) -> np.ndarray:
    reach = int(4 * sigma + 0.5)
    w = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    w /= w.sum()
    for axis in (0, 1):
        wide = np.pad(a, [(reach, reach) if k == axis else (0, 0) for k in (0, 1)], mode="symmetric")
        a = sum(f * wide.take(range(i, i + a.shape[axis]), axis) for i, f in enumerate(w))
    return a


def large_frame(side: int, per_row: int, n: int, noise: float = 2.0, seed: int = 0) -> np.ndarray:
    """A square frame with n particles on a grid, each drawn in a window of its own."""
    rng = np.random.default_rng(seed)
    out, cell = np.full((side, side), BRIGHT), side // per_row
    for k in range(n):
        y, x = (cell * v for v in divmod(k, per_row))
        d = Disc("blob" if k % 2 else "ellipse", cell / 2, cell / 2, *rng.uniform(cell * 0.08, cell * 0.28, 2), rng.uniform(0, 3))
        out[y : y + cell, x : x + cell] = frame(cell, cell, [d])
    return np.clip(out + rng.normal(0, noise, out.shape), 0, 255).astype(np.uint8)


def frame(rows: int, cols: int, discs: list[Disc], gradient: float = 0.0, noise: float = 0.0, seed: int = 0) -> np.ndarray:
    out = np.full((rows, cols), BRIGHT)
    for d in discs:
        cover = covered(Polygon((outline(d) + 0.5) * FINE - 0.5, []), (rows, cols), FINE)
        layer = BRIGHT + (DARK - BRIGHT) * cover
        out = np.minimum(out, blurred(layer, d.blur) if d.blur > 0 else layer)
    out = out * (1 - gradient * np.arange(cols) / cols)
    if noise > 0:
        out = out + np.random.default_rng(seed).normal(0, noise, out.shape)
    return np.clip(out, 0, 255).astype(np.uint8)
