"""Wadell's roundness by computational geometry: circles fitted to the corners of an outline, over the inscribed circle.

After Zheng and Hryciw (2015): the outline is smoothed and reduced to key points from which it strays little; runs of convex key
points are covered by circles, each over the longest stretch whose circle stays inside the outline; circles smaller than the
inscribed one are corners, and roundness is their mean radius over the inscribed one.
"""

from __future__ import annotations

import math
from operator import sub

import numpy as np

# Fixed values of the published method.
STRAYING = 0.3  # pixels between the outline and its key points
STAYS_INSIDE = 0.98  # share of a circle's radius that its centre must keep from the outline
STIFFNESS = 0.001  # weight of bending, beside that of stretching, which is the smoothing asked for


def smoothed(points: np.ndarray, stretch: float) -> np.ndarray:
    """The closed curve of least energy near evenly spaced points: distance to them plus stretching plus bending."""
    n = len(points)
    w = 2 - 2 * np.cos(2 * math.pi * np.arange(n) / n)
    z = np.fft.ifft(np.fft.fft(points[:, 0] + 1j * points[:, 1]) / (1 + stretch * w + STIFFNESS * w * w))
    return np.column_stack([z.real, z.imag])


def key_points(points: np.ndarray, straying: float = STRAYING) -> np.ndarray:
    """Places of the points whose polygon strays no farther from the others than told, by halving at the farthest one."""
    n = len(points)
    first = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmax())
    ring = np.roll(points, -first, axis=0)
    ring = np.concatenate([ring, ring[:1]])
    far = int(((ring - ring[0]) ** 2).sum(axis=1).argmax())
    keep, open_ = [0], [(0, far), (far, n)]
    x, y = np.ascontiguousarray(ring.T)
    corners = ring.tolist()
    while open_:
        a, b = open_.pop()
        keep.append(b)
        if b - a < 2:
            continue
        (ax, ay), (bx, by) = corners[a], corners[b]
        u, v, size = x[a + 1 : b] - ax, y[a + 1 : b] - ay, math.hypot(bx - ax, by - ay)
        gap = np.abs(u * (by - ay) - v * (bx - ax)) / size if size > 0 else np.hypot(u, v)
        k = int(gap.argmax())
        if gap[k] > straying:
            open_ += [(a, a + 1 + k), (a + 1 + k, b)]
    return (np.unique(keep)[:-1] + first) % n


class Arcs:
    """Circles fitted to stretches of a closed row of points, by running sums."""

    def __init__(self, points: np.ndarray) -> None:
        self.x, self.y = np.ascontiguousarray(points.T)
        self.shift = points.mean(axis=0).tolist()
        x, y = np.concatenate([points, points]).T - np.array(self.shift)[:, None]
        s = x * x + y * y
        self.sums = [[0.0] * 9, *np.cumsum([x * x, x * y, y * y, x, y, np.ones(len(x)), x * s, y * s, s], axis=1).T.tolist()]

    def circle(self, a: int, b: int) -> tuple[float, float, float] | None:
        """Centre and radius of the circle nearest to points a to b (inclusive, b may go once round)."""
        xx, xy, yy, x, y, n, xs, ys, s = map(sub, self.sums[b + 1], self.sums[a])
        # least squares of x*x + y*y = 2 p x + 2 q y + r
        uxx, uxy, uyy, ux, uy = xx - x * x / n, xy - x * y / n, yy - y * y / n, xs - x * s / n, ys - y * s / n
        whole = uxx * uyy - uxy * uxy
        if whole <= 1e-12 * max(uxx * uyy, 1e-300):
            return None
        p, q = (ux * uyy - uy * uxy) / whole / 2, (uy * uxx - ux * uxy) / whole / 2
        return p + self.shift[0], q + self.shift[1], math.sqrt(max((s - 2 * p * x - 2 * q * y) / n + p * p + q * q, 0.0))

    def inside(self, a: int, b: int) -> float | None:
        """Radius of that circle if it stays inside the outline."""
        found = self.circle(a, b)
        if found is None:
            return None
        px, py, r = found
        near = math.sqrt(float(((self.x - px) ** 2 + (self.y - py) ** 2).min()))
        return r if near >= STAYS_INSIDE * r else None


def corner_radii(points: np.ndarray, most: float) -> list[float]:
    """Radii of the circles over the convex runs of a counterclockwise outline that are no larger than ``most``."""
    n = len(points)
    keys = key_points(points)
    m = len(keys)
    if m < 3:
        return []
    p = points[keys]
    before, after = p - np.roll(p, 1, axis=0), np.roll(p, -1, axis=0) - p
    convex = before[:, 0] * after[:, 1] - before[:, 1] * after[:, 0] > 0
    arcs, radii = Arcs(points), []
    start = 0 if convex.all() else int(np.argmin(convex))  # a run doesn't begin in the middle of another
    at = [int(keys[(start + k) % m]) for k in range(m + 1)]
    at = np.cumsum([at[0], *((b - a) % n or n for a, b in zip(at, at[1:], strict=False))]).tolist()
    bends = [bool(convex[(start + k) % m]) for k in range(m)] + [bool(convex.all())]
    i, covered = 0, -1
    while i < m:
        if not bends[i]:
            i += 1
            continue
        end = i
        while end < m and bends[end + 1]:
            end += 1
        # the longest stretch from i on, of three key points at least, whose circle stays inside
        low, high, radius = i + 1, end, None
        while low < high:
            middle = (low + high + 1) // 2
            if at[middle] - at[i] < n and (r := arcs.inside(at[i], at[middle])) is not None:
                low, radius = middle, r
            else:
                high = middle - 1
        if radius is None and i > covered and (found := arcs.circle((at[i] - 2) % n, (at[i] - 2) % n + 4)) is not None:
            radius = found[2]  # a corner too sharp to have three key points: the circle near its tip
            low = i
        if radius is not None and radius <= 1.02 * most:
            radii.append(min(radius, most))
        if radius is not None:
            covered = low
        i = max(low, i + 1) if radius is not None else i + 1
    return radii
