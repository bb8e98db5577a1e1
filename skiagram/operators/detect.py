"""Frames to particles: one Arrow pass over paths; pixels never leave the worker, which holds one frame at a time.

A frame that fails gives a row with its traceback, never a failed run.  Flags and the gate are column expressions on top.
"""

from __future__ import annotations

import time
import traceback
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

import skiagram
from skiagram.config import Config, config_hash
from skiagram.functions.gate import flagged
from skiagram.operators import schema

INPUT = ("frame_id", "frame_path", "sample_id", "camera", "run", "fingerprint", "blank_path")


def processed(row: dict, cfg: Config) -> dict:
    """A frame's result; whatever it raises becomes its error."""
    from skiagram.kernel.frame import particles
    from skiagram.sources.frames import read_blank, read_image

    began = time.perf_counter()
    blank_path = row.pop("blank_path")
    out = row | {"status": "error", "n_objects": 0, "flatfield_method": "", "traceback": None, "particles": []}
    try:
        raw = read_image(row["frame_path"])
        use_blank = blank_path is not None and cfg.flatfield.method != "morphological"
        rows, outlines, method = particles(raw, read_blank(blank_path) if use_blank else None, cfg.um_per_px(row["camera"]), cfg)
        found = [r | {"wkt": w} for r, w in zip(rows, outlines, strict=True)]
        out |= {"status": "ok" if found else "empty", "n_objects": len(found), "flatfield_method": method, "particles": found}
    except Exception:
        out["traceback"] = traceback.format_exc()
    return out | {"seconds": time.perf_counter() - began}


def spread(rows: DataFrame, key: str, per_task: int = 64) -> DataFrame:
    """Rows that are small but dear, dealt out by key to tasks of about per_task rows, and to every core when there are few.

    The number of partitions is given: adaptive execution would put millions of paths, being few bytes, into one task.
    """
    n = rows.count()
    return rows.repartition(max(1, min(n, max(2 * rows.sparkSession.sparkContext.defaultParallelism, -(-n // per_task)))), key)


def results(frames: DataFrame, cfg: Config) -> DataFrame:
    """One row a frame.  Frames are spread by id: a frame costs about a second, so its path is worth a shuffle."""
    shape = schema.results(cfg.measure.efd_order)
    arrow = to_arrow_schema(shape)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_pylist([processed(row, cfg)], schema=arrow)

    return spread(frames.select(*INPUT), "frame_id").mapInArrow(work, shape)


def grains(found: DataFrame, cfg: Config) -> DataFrame:
    """One row a particle with flags and gate, in canonical order."""
    names = [f.name for f in schema.measured(cfg.measure.efd_order).fields]
    head = ["frame_id", "frame_path", "sample_id", "camera", "run"]
    rows = found.select(*head, F.explode("particles").alias("p")).select(*head, *[F.col(f"p.{n}").alias(n) for n in names])
    rows = rows.withColumns(
        {
            "grain_uid": F.concat_ws(":", "frame_id", F.col("label").cast("string")),
            "wadell_smoothing": F.lit(float(cfg.measure.wadell_smoothing)),
            "pipeline_version": F.lit(skiagram.__version__),
            "config_hash": F.lit(config_hash(cfg)),
        }
    )
    return flagged(rows, cfg.qc).select(*schema.grains(cfg.measure.efd_order).names)


def contours(found: DataFrame) -> DataFrame:
    """Outlines of particles that have one, with the keys of their folders."""
    rows = found.select("frame_id", "sample_id", "camera", F.explode("particles").alias("p")).filter("p.wkt is not null")
    uid = F.concat_ws(":", "frame_id", F.col("p.label").cast("string"))
    return rows.select("frame_id", "sample_id", "camera", uid.alias("grain_uid"), F.col("p.wkt").alias("wkt"), F.col("p.um_per_px").alias("um_per_px"))


def manifest(found: DataFrame, cfg: Config) -> DataFrame:
    """Seconds are stored as 0, so that the same frames give the same table."""
    rows = found.withColumns({"seconds": F.lit(0.0), "config_hash": F.lit(config_hash(cfg))})
    return rows.select(*schema.MANIFEST.names)


def errors(found: DataFrame) -> DataFrame:
    return found.filter("status = 'error'").select(*schema.ERRORS.names)


DRAWN = ("area_px", "perimeter_um", "perimeter_crofton_px", "major_axis_um", "minor_axis_um", "feret_max_um", "feret_min_um", "solidity", "circularity", "wadell_sphericity", "edge_width_px", "contrast", "touches_border", "has_polygon")


def drawn(keys: DataFrame, cfg: Config) -> DataFrame:
    """A synthetic frame a key, drawn, stored as BMP, read and measured in one pass: one ellipse each, of a size and place that
    follow the key; its half axes a and b, and what was measured."""
    kinds = {f.name: f.dataType for f in schema.measured(cfg.measure.efd_order).fields}
    shape = schema.of(key=schema.LONG, n_objects=schema.LONG, a=schema.REAL, b=schema.REAL, **{n: kinds[n] for n in DRAWN})
    arrow = to_arrow_schema(shape)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from skiagram.kernel import frame, synthetic
        from skiagram.sources.images import decode, encode_bmp

        for batch in batches:
            rows = []
            for key in batch.column(0).to_pylist():
                a = 8.0 + key % 9
                b = a * (1 - (key % 4) / 8)
                image = synthetic.frame(64, 64, [synthetic.Disc("ellipse", 28 + key % 7, 30 + key % 5, a, b, key % 3)])
                got = frame.particles(decode(encode_bmp(image)), None, 1.0, cfg)[0]
                rows.append({"key": key, "n_objects": len(got), "a": a, "b": b} | ({n: got[0][n] for n in DRAWN} if got else {}))
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return spread(keys.select(keys.columns[0]), keys.columns[0], per_task=512).mapInArrow(work, shape)  # small frames: some 5 s a task
