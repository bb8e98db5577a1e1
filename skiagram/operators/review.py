"""Data behind figures and labelling: focus points, sheet tiles, overlays, illumination, label scores."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skiagram.config import Config
from skiagram.functions import gate
from skiagram.functions.gate import nan_to_null
from skiagram.functions.identity import stem
from skiagram.operators.detect import spread

LEAST_HALF_PX, LABELLED_MOST = 20, 50


def focus_scatter(grains: DataFrame) -> DataFrame:
    return grains.select("grain_uid", "sample_id", "camera", "edge_gradient_norm", "contrast", "flag_defocus")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def resolved_frames(frames: DataFrame, listing: DataFrame) -> DataFrame:
    """frame_path and where it lies now: as stored, else the first file of its name; frames without a file are left out."""
    at = F.regexp_replace("frame_path", "^file:/*", "/")
    files = listing.select(F.col("frame_path").alias("path"), at.alias("_at"), base_name(F.col("frame_path")).alias("_name"))
    wanted = frames.select("frame_path", at.alias("_stored"), base_name(F.col("frame_path")).alias("_name"))
    best = F.min_by("path", F.struct((F.col("_at") != F.col("_stored")).cast("int"), F.size(F.split("path", "/")), F.col("path")))
    return wanted.join(files, "_name").groupBy("frame_path").agg(best.alias("path"))


def crop_half(ecd_um: str = "ecd_um", scale: str = "um_per_px") -> Column:
    """Half width of a crop in pixels: the diameter, at least 20; 20 where the size or the scale can't be told."""
    px = F.when((F.col(scale) > 0) & gate.finite(F.col(ecd_um)), F.col(ecd_um) / F.nullif(F.col(scale), F.lit(0.0)))
    return F.greatest(F.coalesce(px, F.lit(0.0)), F.lit(float(LEAST_HALF_PX)))


def label_frames(frames: DataFrame, folder: DataFrame) -> DataFrame:
    """frame_id and path for the labelling tool: a file of a given folder's listing that is named by the id, else as stored."""
    there = folder.groupBy(stem(F.col("frame_path")).alias("frame_id")).agg(F.min("frame_path").alias("_there"))
    return frames.join(there, "frame_id", "left").select("frame_id", F.coalesce("_there", "frame_path").alias("path"))


def tiles(pages: DataFrame, resolved: DataFrame, columns: int = 6) -> DataFrame:
    """Where each tile goes on its sheet, what it crops and its caption.

    Crops end at the image's edges, at its far ones if the rows tell its size (frame_rows, frame_cols); a row without a centre,
    or whose crop would be empty, has null bounds.
    """
    size = nan_to_null(F.col("ecd_um"))
    k = (F.col("position") - 1) % 24
    half = crop_half()
    keep = [c for c in ("flag", "page", "position") if c in pages.columns]
    bounds = {}
    for axis, size_of in (("x", "frame_cols"), ("y", "frame_rows")):
        centre = nan_to_null(F.col(f"centroid_{axis}"))
        end = centre + half
        bounds[f"{axis}0"] = F.greatest(centre - half, F.lit(0.0)).cast("int")
        bounds[f"{axis}1"] = (F.least(end, F.col(size_of)) if size_of in pages.columns else end).cast("int")
    some = (bounds["x1"] > bounds["x0"]) & (bounds["y1"] > bounds["y0"]) & F.col("centroid_x").isNotNull() & F.col("centroid_y").isNotNull()
    return pages.join(resolved, "frame_path").select(
        "grain_uid",
        "path",
        *keep,
        F.floor(k / columns).cast("int").alias("tile_row"),
        (k % columns).cast("int").alias("tile_column"),
        *[F.when(some, bounds[b]).alias(b) for b in ("x0", "y0", "x1", "y1")],
        F.concat("grain_uid", F.coalesce(F.concat(F.lit("\n"), F.bround(size).cast("long").cast("string"), F.lit("µm")), F.lit(""))).alias("caption"),
    )


def sheets(placed: DataFrame, out: str, columns: int = 6, cell: int = 96) -> DataFrame:
    """Draws contact sheets, a PNG a flag and page, from ``tiles`` that tell them; a row a sheet.

    A page has two dozen tiles at most, so it is drawn by one task, which reads the frames that its tiles are cut from.  A tile
    without bounds or whose frame can't be read stays empty.
    """
    flag = F.coalesce(F.col("flag"), F.lit("accepted")) if "flag" in placed.columns else F.lit("accepted")
    rows = placed.select(flag.alias("flag"), "page", "position", "tile_row", "tile_column", "path", "x0", "y0", "x1", "y1", "caption")

    def draw(page: pa.Table) -> pa.Table:
        from skiagram.sources.frames import read_image
        from skiagram.sources.images import encode_png

        tiles = page.sort_by("position").to_pylist()
        sheet = np.full(((max(t["tile_row"] for t in tiles) + 1) * cell, columns * cell), 255, np.uint8)
        frames: dict[str, np.ndarray | None] = {}
        shown = 0
        for t in tiles:
            if t["path"] not in frames:
                try:
                    frames[t["path"]] = read_image(t["path"])
                except Exception:
                    frames[t["path"]] = None
            image = frames[t["path"]]
            crop = None if image is None or t["x0"] is None else image[t["y0"] : t["y1"], t["x0"] : t["x1"]]
            if crop is not None and crop.size:
                size = cell - 4
                most = max(crop.shape)
                r, c = ((np.arange(max(1, n * size // most)) * most // size).clip(0, n - 1) for n in crop.shape)
                top, left = t["tile_row"] * cell + 2, t["tile_column"] * cell + 2
                sheet[top : top + len(r), left : left + len(c)] = crop[np.ix_(r, c)]
                shown += 1
        first = tiles[0]
        path = os.path.join(out, f"{first['flag']}_{first['page']:03d}.png")
        store(path, encode_png(sheet, "; ".join(t["caption"].replace("\n", " ") for t in tiles)))
        return pa.table({"flag": [first["flag"]], "page": pa.array([first["page"]], pa.int32()), "png": [path], "n_tiles": [len(tiles)], "n_shown": [shown]})

    return rows.groupBy("flag", "page").applyInArrow(draw, "flag string, page int, png string, n_tiles long, n_shown long")


def illumination(resolved: DataFrame, cfg: Config, step: int = 16) -> DataFrame:
    """Background of the first frame that is there, one row a point of a grid."""
    from skiagram.kernel.pixels import background_field
    from skiagram.sources.frames import read_image

    def field(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                got = background_field(read_image(path), cfg.flatfield.morph_kernel_px)[::step, ::step]
                y, x = np.indices(got.shape) * step
                yield pa.RecordBatch.from_pydict({"path": [path] * got.size, "x": x.ravel().astype(np.int64), "y": y.ravel().astype(np.int64), "field": got.ravel().astype(float)})

    return resolved.orderBy("frame_path").limit(1).select("path").mapInArrow(field, "path string, x long, y long, field double")


def with_contours(grains: DataFrame, contours: DataFrame) -> DataFrame:
    """Grains with their outline, null where there is none.  Both are joined by frame and uid, so tables that lie in the same buckets
    of frame_id are joined where they are."""
    return grains.join(contours.select("frame_id", "grain_uid", "wkt"), ["frame_id", "grain_uid"], "left")


def outlined(grains: DataFrame, contours: DataFrame, listing: DataFrame, labels: bool | None = None) -> DataFrame:
    """One row a frame: its path, counts, whether labels are drawn, and its outlines by stored verdict."""
    at = resolved_frames(grains.select("frame_path").distinct(), listing)
    by_id = listing.groupBy(stem(F.col("frame_path")).alias("frame_id")).agg(F.min("frame_path").alias("other_path"))
    rows = with_contours(grains, contours)
    one = F.struct(F.substring_index("grain_uid", ":", -1).alias("label"), "qc_pass", "centroid_x", "centroid_y", "wkt")
    per = rows.groupBy("frame_id", "frame_path").agg(F.sort_array(F.collect_list(one)).alias("outlines"), F.count_if("qc_pass").alias("n_accepted"), F.count_if(~F.col("qc_pass")).alias("n_rejected"))
    shown = F.lit(labels) if labels is not None else F.size("outlines") <= LABELLED_MOST
    placed = per.join(at, "frame_path", "left").join(by_id, "frame_id", "left").withColumn("path", F.coalesce("path", "other_path")).drop("other_path")
    return placed.withColumn("draw_labels", shown)


ACCEPTED, REJECTED, UNOUTLINED = (0, 255, 0), (255, 0, 0), (255, 165, 0)
#: Digits on 3 x 5 pixels, a row in three bits.
DIGITS = {"0": (7, 5, 5, 5, 7), "1": (2, 6, 2, 2, 7), "2": (7, 1, 7, 4, 7), "3": (7, 1, 7, 1, 7), "4": (5, 5, 7, 1, 1), "5": (7, 4, 7, 1, 7), "6": (7, 4, 7, 5, 7), "7": (7, 1, 2, 2, 2), "8": (7, 5, 7, 5, 7), "9": (7, 5, 7, 1, 7)}


def painted(image: np.ndarray, outlines: list[dict], thick: int) -> np.ndarray:
    """Accepted outlines in green, then rejected ones in red; text that is no polygon is passed over."""
    from skiagram.kernel.outlines import from_wkt, rasterised
    from skiagram.kernel.pixels import grown, shrunk

    out = np.repeat(image[:, :, None], 3, axis=2)
    for accepted, colour in ((True, ACCEPTED), (False, REJECTED)):
        edge = np.zeros(image.shape, bool)
        for o in outlines:
            if bool(o["qc_pass"]) == accepted and (p := from_wkt(o["wkt"])) is not None:
                low, high = np.floor(p.exterior.min(axis=0)).astype(int) - 2, np.ceil(p.exterior.max(axis=0)).astype(int) + 3
                x0, y0 = np.maximum(low, 0)
                part = edge[y0 : max(high[1], 0), x0 : max(high[0], 0)]
                m = rasterised(p, part.shape, x0, y0)
                part |= m & ~shrunk(m, 1)
        out[grown(edge, thick)] = colour
    return out


def annotated(small: np.ndarray, outlines: list[dict], factor: int, labels: bool, zoom: int = 2) -> np.ndarray:
    """The smaller image with crosses on particles without an outline and, if told, labels at the centres."""
    out = small.copy()

    def dot(x: int, y: int, colour: tuple[int, int, int], size: int = 1) -> None:
        out[max(y, 0) : max(y + size, 0), max(x, 0) : max(x + size, 0)] = colour

    for o in outlines:
        if o["centroid_x"] is None or o["centroid_y"] is None or not np.isfinite((o["centroid_x"], o["centroid_y"])).all():
            continue
        x, y = round(o["centroid_x"] / factor), round(o["centroid_y"] / factor)
        if not o["wkt"]:
            for k in range(-4, 5):
                dot(x + k, y + k, UNOUTLINED)
                dot(x + k, y - k, UNOUTLINED)
        for place, digit in enumerate(str(o["label"]) if labels else ""):
            for row, bits in enumerate(DIGITS.get(digit, ())):
                for column in range(3):
                    if bits >> 2 - column & 1:
                        dot(x + zoom * (4 * place + column), y + zoom * row, ACCEPTED if o["qc_pass"] else REJECTED, zoom)
    return out


def overlays(drawn: DataFrame, out: str, factor: int = 1) -> DataFrame:
    """Writes a PNG a frame, titled with its counts, into a folder that all workers share; never fails for a frame."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from skiagram.sources.frames import read_image
        from skiagram.sources.images import encode_png, smoothed_smaller

        for b in batches:
            for r in b.to_pylist():
                path, error = os.path.join(out, f"{r['frame_id']}_overlay.png"), None
                try:
                    small = smoothed_smaller(painted(read_image(r["path"]), r["outlines"], max(1, factor // 2)), factor)
                    title = f"{r['frame_id']}  (accepted={r['n_accepted']}, rejected={r['n_rejected']})"
                    store(path, encode_png(annotated(small, r["outlines"], factor, r["draw_labels"]), title))
                except Exception as e:
                    path, error = None, f"{type(e).__name__}: {e}"
                yield pa.RecordBatch.from_pylist([{"frame_id": r["frame_id"], "png": path, "error": error}], schema=pa.schema([("frame_id", pa.string()), ("png", pa.string()), ("error", pa.string())]))

    return spread(drawn, "frame_id").mapInArrow(draw, "frame_id string, png string, error string")


def store(path: str, data: bytes) -> None:
    """A file is written beside its place and then put there, so a task that runs again does no harm."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    partial = f"{path}.{os.getpid()}"
    with open(partial, "wb") as f:
        f.write(data)
    os.replace(partial, path)


def shrunk_frames(listing: DataFrame, out: str, factor: int) -> DataFrame:
    """Block means of every frame as BMP or, where it was one, PNG, under its name."""

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from skiagram.sources.frames import read_image
        from skiagram.sources.images import block_mean, encode_bmp, encode_png

        for b in batches:
            for path in b.column(0).to_pylist():
                small = block_mean(read_image(path), factor)
                target = os.path.join(out, os.path.basename(path))
                store(target, encode_png(small) if path.lower().endswith(".png") else encode_bmp(small))
                yield pa.RecordBatch.from_pydict({"path": [target], "rows": [small.shape[0]], "cols": [small.shape[1]]})

    return spread(listing.select("frame_path"), "frame_path").mapInArrow(shrink, "path string, rows long, cols long")


def with_predictions(grains: DataFrame, cfg: Config) -> DataFrame:
    return grains.withColumns({"flags": gate.active_flags(), "qc_status": gate.predicted_status(cfg.qc.disqualifying_flags)})


def first_unlabelled(order: DataFrame, labels: DataFrame) -> int:
    """Position of the first row without a label; 0 if all have one.  ``order`` has grain_uid and position."""
    left = order.join(labels.select("grain_uid"), "grain_uid", "left_anti").agg(F.min("position")).first()[0]
    return int(left or 0)


def progress(order: DataFrame, labels: DataFrame) -> DataFrame:
    """One row: the first row of the order without a label (the first of all if every one has one), how many have one, and all."""
    rows = order.join(labels.select("grain_uid").distinct().withColumn("_has", F.lit(True)), "grain_uid", "left")
    first = F.struct(F.coalesce("_has", F.lit(False)), F.col("position"))
    at = rows.agg(F.min_by(F.struct("grain_uid", "position"), first).alias("at"), F.count("_has").alias("n_labelled"), F.count("*").alias("n_total"))
    return at.select("at.grain_uid", "at.position", "n_labelled", "n_total")


def neighbours(order: DataFrame) -> DataFrame:
    """Previous and next row of each row of a labelling order, itself at the ends.  The order is a bounded sample."""
    w = Window.partitionBy(F.lit(0)).orderBy("position")
    return order.withColumns({"previous_uid": F.coalesce(F.lag("grain_uid").over(w), "grain_uid"), "next_uid": F.coalesce(F.lead("grain_uid").over(w), "grain_uid")})


def label_scores(labels: DataFrame, grains: DataFrame) -> DataFrame:
    """How hand labels and the gate agree."""
    return labels.select("grain_uid", "label_name").join(grains.select("grain_uid", "qc_pass"), "grain_uid").groupBy("label_name", "qc_pass").agg(F.count("*").alias("n"))
