"""One frame: its particles with all measures, metrics and outlines."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from skiagram.config import Config
from skiagram.kernel import outlines, pixels, shapes, sharpness
from skiagram.kernel.outlines import Polygon


class Detection(NamedTuple):
    label: int
    polygon: Polygon | None
    box: tuple[int, int, int, int]
    centroid: tuple[float, float]


def detections(corrected: np.ndarray, cfg: Config) -> tuple[np.ndarray, list[Detection]]:
    """Label image and particles in the order of their first pixels."""
    level = pixels.level(corrected, cfg.threshold, cfg.detect.min_area_px)
    mask = corrected < level
    labels, n = pixels.large_components(pixels.without_holes(mask) if cfg.detect.fill_holes else mask, cfg.detect.min_area_px)
    if n == 0:
        return labels, []
    made = outlines.by_label(outlines.rings(corrected, level), labels)
    r, c = np.nonzero(labels)
    own = labels[r, c]
    order = np.argsort(own, kind="stable")
    r, c, cut = r[order], c[order], np.concatenate([[0], np.cumsum(np.bincount(own, minlength=n + 1)[1:])])
    out = []
    for k in range(n):
        rr, cc = r[cut[k] : cut[k + 1]], c[cut[k] : cut[k + 1]]
        out.append(Detection(k + 1, made.get(k + 1), (int(rr.min()), int(cc.min()), int(rr.max()) + 1, int(cc.max()) + 1), (float(cc.mean()), float(rr.mean()))))
    return labels, out


def particle(d: Detection, raw: np.ndarray, labels: np.ndarray, um_per_px: float, cfg: Config) -> dict:
    """All measures of a particle; those that its polygon can't give are NaN."""
    m, nan = cfg.measure, float("nan")
    row = {"label": d.label, "centroid_x": d.centroid[0], "centroid_y": d.centroid[1], "um_per_px": um_per_px}
    corners = mask = None
    if d.polygon is not None:
        corners, mask = shapes.hull(d.polygon.exterior), shapes.largest_component(shapes.mask_of(d.polygon))
    row |= shapes.polygon_measures(d.polygon, um_per_px, corners, mask)
    efd, cum90, round_, sphere, entropy = np.full((m.efd_order, 4), nan), nan, nan, nan, nan
    if d.polygon is not None:
        efd, cum90 = shapes.fourier(d.polygon, m.efd_order, m.efd_resample_n)
        round_, sphere = shapes.wadell(d.polygon, m.wadell_smoothing, corners, mask)
        entropy = shapes.curvature_entropy(d.polygon, m.curvature_resample_n, m.curvature_smoothing, m.curvature_bins)
    row |= {f"efd_{h + 1}_{n}": float(efd[h, i]) for h in range(m.efd_order) for i, n in enumerate("abcd")}
    row |= {"fourier_power_cum_90": cum90, "wadell_roundness": round_, "wadell_sphericity": sphere}
    row |= {"curvature_entropy": entropy, "curvature_smoothing": m.curvature_smoothing}
    r0, c0, r1, c1 = d.box
    row["perimeter_crofton_px"] = shapes.crofton(labels[r0:r1, c0:c1] == d.label)
    return row | sharpness.metrics(raw, labels, d.label, d.box, d.polygon)


def particles(raw: np.ndarray, blank: np.ndarray | None, um_per_px: float, cfg: Config) -> tuple[list[dict], list[str | None], str]:
    """Rows and outlines (WKT, none without a polygon) of a frame's particles, and the flat-field method."""
    corrected, method = pixels.flat(raw, blank, cfg.flatfield)
    labels, found = detections(corrected, cfg)
    rows = [particle(d, raw, labels, um_per_px, cfg) for d in found]
    return rows, [None if d.polygon is None else outlines.to_wkt(d.polygon) for d in found], method
