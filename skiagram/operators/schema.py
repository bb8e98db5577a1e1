"""Schemas of the tables that a detect run keeps."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, StringType, StructField, StructType

from skiagram.functions.gate import FLAGS
from skiagram.kernel.shapes import POLYGON_KEYS

TEXT, LONG, REAL, BOOL = StringType(), LongType(), DoubleType(), BooleanType()
METRICS = ("edge_width_px", "edge_gradient", "edge_gradient_norm", "contrast", "ecd_px", "qc_aspect_ratio", "qc_solidity")


def of(**fields) -> StructType:
    return StructType([StructField(n, t) for n, t in fields.items()])


def measured(efd_order: int) -> StructType:
    """What the frame kernel gives for one particle."""
    efd = [f"efd_{h}_{c}" for h in range(1, efd_order + 1) for c in "abcd"]
    reals = ("centroid_x", "centroid_y", "um_per_px", *POLYGON_KEYS, *efd, "fourier_power_cum_90", "wadell_roundness", "wadell_sphericity")
    reals += ("curvature_entropy", "curvature_smoothing", "perimeter_crofton_px", *METRICS)
    return of(label=LONG, **dict.fromkeys(reals, REAL), touches_border=BOOL, has_polygon=BOOL)


def grains(efd_order: int) -> StructType:
    """Canonical order: identity, measures, metrics, flags, the gate."""
    head = of(grain_uid=TEXT, frame_id=TEXT, frame_path=TEXT, sample_id=TEXT, camera=TEXT, run=TEXT)
    inner = measured(efd_order).fields
    stamp = of(wadell_smoothing=REAL, pipeline_version=TEXT, config_hash=TEXT)
    return StructType([*head.fields, *inner[:4], *stamp.fields, *inner[4:], *of(**dict.fromkeys((*FLAGS, "qc_pass"), BOOL)).fields])


CONTOURS = of(grain_uid=TEXT, wkt=TEXT, um_per_px=REAL)
KEYED_CONTOURS = of(frame_id=TEXT, sample_id=TEXT, camera=TEXT, grain_uid=TEXT, wkt=TEXT, um_per_px=REAL)
MANIFEST = of(frame_id=TEXT, frame_path=TEXT, fingerprint=TEXT, status=TEXT, n_objects=LONG, seconds=REAL, flatfield_method=TEXT, config_hash=TEXT)
ERRORS = of(frame_id=TEXT, frame_path=TEXT, traceback=TEXT)
LABELS = of(grain_uid=TEXT, label=LONG, label_name=TEXT, qc_status=TEXT, flags=TEXT, ecd_px=REAL, sample_id=TEXT, camera=TEXT, frame_id=TEXT, labeled_at=TEXT)


def results(efd_order: int) -> StructType:
    """One row a frame: identity, outcome, and its particles nested with their outlines."""
    inner = StructType([*measured(efd_order).fields, StructField("wkt", TEXT)])
    head = of(frame_id=TEXT, frame_path=TEXT, sample_id=TEXT, camera=TEXT, run=TEXT, fingerprint=TEXT)
    return StructType([*head.fields, *of(status=TEXT, n_objects=LONG, seconds=REAL, flatfield_method=TEXT, traceback=TEXT, particles=ArrayType(inner)).fields])
