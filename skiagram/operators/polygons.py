"""Kernel measures over tables of arrays (rings of vertices, small images), in Arrow batches without a shuffle.

As nested array expressions these would be evaluated again for every element that uses them; NumPy does each row once, on views
of the batch's own buffers, and the results of a batch are put together as columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from skiagram.config import Flatfield, Threshold

#: A column for each field of the result, all of one length.
Columns = Sequence[np.ndarray | Sequence]


def per_row(rows: DataFrame, key: str, arrays: Sequence[str], measure: Callable[..., Columns | None], shape: StructType) -> DataFrame:
    """Rows that ``measure`` gives for the arrays of each row, with its key.  A row with a null array, or without result, gives none."""
    whole = StructType([rows.schema[key], *shape.fields])
    arrow = to_arrow_schema(whole)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = [b.column(k + 1) for k in range(len(arrays))]
            ends = [x.offsets.to_numpy() for x in lists]
            values = [x.values.to_numpy(zero_copy_only=False) for x in lists]
            there = np.logical_and.reduce([x.is_valid().to_numpy(zero_copy_only=False) for x in lists])
            source, found = [], []
            for i in np.flatnonzero(there).tolist():
                got = measure(*(v[e[i] : e[i + 1]] for v, e in zip(values, ends, strict=True)))
                if got is not None and len(got[0]):
                    source.append((i, len(got[0])))
                    found.append(got)
            if found:
                at = np.repeat(*np.array(source).T)
                columns = [pa.array(np.concatenate(c)).cast(f.type) for c, f in zip(zip(*found, strict=True), list(arrow)[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), *columns], schema=arrow)

    return rows.select(key, *arrays).mapInArrow(work, whole)


def per_ring(rings: DataFrame, key: str, measure: Callable[[np.ndarray], Columns | None], shape: StructType) -> DataFrame:
    """``per_row`` for rings in columns xs and ys; a ring of under three vertices gives no row."""

    def both(xs: np.ndarray, ys: np.ndarray) -> Columns | None:
        return measure(np.column_stack([xs, ys]).astype(float)) if len(xs) == len(ys) >= 3 else None

    return per_row(rings, key, ("xs", "ys"), both, shape)


def per_tile(tiles: DataFrame, key: str, side: int, measure: Callable[[np.ndarray], Columns | None], shape: StructType) -> DataFrame:
    """``per_row`` for square images in a column pixels, in row order; other sizes give no row."""
    return per_row(tiles, key, ("pixels",), lambda p: measure(p.astype(float).reshape(side, side)) if len(p) == side * side else None, shape)


def one(**values) -> Columns:
    """A single row."""
    return [np.array([v]) for v in values.values()]


def pixels_of(image: np.ndarray) -> Columns:
    """A row for each pixel: its number and value."""
    return [np.arange(image.size), image.astype(float).ravel()]


# ----------------------------------------------------------------------------------------------------------------- rings


def resampled(n: int) -> Callable[[np.ndarray], Columns]:
    def measure(ring: np.ndarray) -> Columns:
        from skiagram.kernel import shapes

        return [np.arange(n), *shapes.resampled(ring, n).T]

    return measure


def harmonic_power(order: int) -> Callable[[np.ndarray], Columns]:
    """Summed power of the closed ring's harmonics, not normalised, and where 90 and 99.9 % of it are reached."""

    def measure(ring: np.ndarray) -> Columns:
        from skiagram.kernel import shapes

        run = np.cumsum((shapes.harmonics(np.vstack([ring, ring[:1]]), order) ** 2).sum(axis=(1, 2)))
        return one(power=run[-1], cum_90=(run < 0.9 * run[-1]).sum() + 1, cum_999=(run < 0.999 * run[-1]).sum() + 1)

    return measure


def turning_entropy(bins: int) -> Callable[[np.ndarray], Columns]:
    """Entropy of curvatures, differences taken all the way round, without smoothing."""

    def measure(ring: np.ndarray) -> Columns:
        from skiagram.kernel import shapes

        return one(entropy=shapes.histogram_entropy(shapes.curvature(np.take(ring, range(-3, len(ring) + 3), axis=0, mode="wrap"))[3:-3], bins))

    return measure


def arc(ring: np.ndarray) -> Columns:
    """Length of the ring up to the end of each side."""
    from skiagram.kernel import shapes

    return [np.arange(len(ring)), shapes.arc_length(ring)[1:]]


def geometry(ring: np.ndarray) -> Columns:
    from skiagram.kernel import outlines

    x, y = outlines.ring_centroid(ring)
    return one(area=outlines.signed_area(ring), length=outlines.ring_length(ring), x=x, y=y)


def measures(um_per_px: float, keys: Sequence[str]) -> Callable[[np.ndarray], Columns]:
    """Measures of the polygon that a ring encloses."""

    def measure(ring: np.ndarray) -> Columns:
        from skiagram.kernel import outlines, shapes

        got = shapes.polygon_measures(outlines.Polygon(ring, []), um_per_px)
        return one(**{k: got[k] for k in keys})

    return measure


def raster_area(side: int) -> Callable[[np.ndarray], Columns]:
    """How many pixel centres of a square image lie inside."""

    def measure(ring: np.ndarray) -> Columns:
        from skiagram.kernel import outlines

        return one(n=int(outlines.rasterised(outlines.Polygon(ring, []), (side, side)).sum()))

    return measure


def written(ring: np.ndarray) -> Columns:
    """Vertices and area of a ring that was written as text and read again."""
    from skiagram.kernel import outlines

    p = outlines.from_wkt(outlines.to_wkt(outlines.Polygon(ring, [])))
    return one(n=len(p.exterior), area=outlines.area(p))


def mended(ring: np.ndarray) -> Columns | None:
    """Vertices and area of what repair leaves of a ring."""
    from skiagram.kernel import outlines

    p = outlines.repaired(outlines.Polygon(ring, []))
    return None if p is None else one(n=len(p.exterior), area=outlines.area(p))


# ----------------------------------------------------------------------------------------------------------------- tiles


def staircase(image: np.ndarray) -> np.ndarray:
    """A connected mask whose columns are as high as the first row tells."""
    high = np.clip(np.floor(image[0] * 4) - 1, 1, len(image))
    return np.arange(len(image))[:, None] < high


def corrected(image: np.ndarray) -> np.ndarray:
    """The image over its median, at full precision."""
    return image / np.median(image)


def flat(image: np.ndarray) -> Columns:
    from skiagram.kernel import pixels

    return pixels_of(pixels.flat(image, np.ones(image.shape), Flatfield(method="blank"))[0])


def closing(k: int) -> Callable[[np.ndarray], Columns]:
    def measure(image: np.ndarray) -> Columns:
        from skiagram.kernel import pixels

        return pixels_of(pixels.background_field(image, k))

    return measure


def threshold(cfg: Threshold, least_px: int) -> Callable[[np.ndarray], Columns]:
    """Level, pixels below it, and those of them on the edge of the image."""

    def measure(image: np.ndarray) -> Columns:
        from skiagram.kernel import pixels

        p = corrected(image)
        level = pixels.level(p, cfg, least_px)
        on = p < level
        return one(level=level, n=on.sum(), border=on.sum() - on[1:-1, 1:-1].sum())

    return measure


def parts(least: int) -> Callable[[np.ndarray], Columns]:
    """Components of dark pixels of at least ``least``: how many, the largest, all their pixels."""

    def measure(image: np.ndarray) -> Columns:
        from skiagram.kernel import pixels

        labels, n = pixels.large_components(corrected(image) < 1, least)
        size = np.bincount(labels.ravel(), minlength=2)[1:]
        return one(n=n, largest=size.max(), pixels=size.sum())

    return measure


def filled(image: np.ndarray) -> Columns:
    """Dark pixels, and those with holes filled."""
    from skiagram.kernel import pixels

    mask = corrected(image) < 1
    return one(n=mask.sum(), filled=pixels.without_holes(mask).sum())


def gradient(image: np.ndarray) -> Columns:
    from skiagram.kernel import pixels

    return pixels_of(pixels.sobel(image))


def between(image: np.ndarray) -> Columns:
    """Values a quarter pixel right of and half a pixel below each pixel."""
    from skiagram.kernel import pixels

    y, x = np.indices(image.shape).astype(float)
    return pixels_of(pixels.bilinear(image, x + 0.25, y + 0.5))


def depth(image: np.ndarray) -> Columns:
    from skiagram.kernel import sharpness

    return [np.arange(image.size), sharpness.depths(staircase(image)).ravel()]


def moments(image: np.ndarray) -> Columns:
    from skiagram.kernel import shapes

    return one(**shapes.ellipse(staircase(image)))


def perimeters(image: np.ndarray) -> Columns:
    from skiagram.kernel import shapes

    mask = staircase(image)
    return one(crofton=shapes.crofton(mask), chain=shapes.chain_perimeter(mask))


def edge_metrics(image: np.ndarray) -> Columns:
    """Metrics of the staircase as a particle without polygon in the image."""
    from skiagram.kernel import sharpness

    mask = staircase(image)
    m = sharpness.metrics(image, mask.astype(int), 1, (0, 0, int(mask.any(axis=1).sum()), len(image)), None)
    return one(**{k: m[k] for k in ("contrast", "edge_gradient", "edge_gradient_norm", "ecd_px")})


def reaches(grey: float) -> Callable[[np.ndarray], Columns]:
    """Where the running sum of each row reaches a grey value."""

    def measure(image: np.ndarray) -> Columns:
        from skiagram.kernel import sharpness

        at = np.arange(image.shape[1], dtype=float)
        return [np.arange(len(image)), sharpness.reached(np.cumsum(image, axis=1), at, grey)]

    return measure
