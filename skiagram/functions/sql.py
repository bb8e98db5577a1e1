"""The gate, size classes, frame names and outlines as SQL functions of a session, and a run's tables as views.

All are SQL bodies that Spark puts into the query in place of the call, so a query by name is planned as one by expression: nothing is
interpreted row by row and no Python runs.  Names are given with a prefix, ``grain_`` by default; what they replace is of this session
only.  A body is computed anew wherever the query has it, so bodies on paths match as few patterns as they can.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from skiagram.config import FLAGS, Config
from skiagram.functions import gate
from skiagram.functions.identity import java_regex

PREFIX = "grain_"
STEM = r"^(?:[^/]*/)*+([^/]*[^/\n\r\u0085\u2028\u2029](?=\.[^./]*\z)|[^/]*)"


def text(s: str) -> str:
    """A string as an SQL literal that keeps backslashes."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def bodies(cfg: Config) -> dict[str, tuple[str, str, str]]:
    """Of each function its parameters, what it returns and its body."""
    qc = cfg.qc
    more = lambda x, limit: f"coalesce(NOT isnan({x}) AND {x} > {limit!r}D, false)"
    less = lambda x, limit: f"coalesce(NOT isnan({x}) AND {x} < {limit!r}D, false)"
    edge, contrast, sliver, largest, least, solid = map(float, (qc.defocus_edge_width_px, qc.defocus_contrast_min, qc.sliver_aspect_ratio, qc.sliver_max_ecd_px, qc.min_ecd_px, qc.agglomerate_solidity_max))
    flags = {
        "flag_defocus": f"{more('edge_width_px', edge)} OR {less('contrast', contrast)}",
        "flag_border": "coalesce(touches_border, false)",
        "flag_too_small": less("ecd_px", least),
        "flag_sliver": f"{more('qc_aspect_ratio', sliver)} AND coalesce(NOT isnan(ecd_px) AND ecd_px <= {largest!r}D, false)",
        "flag_possible_agglomerate": less("qc_solidity", solid),
        "flag_no_polygon": "coalesce(NOT has_polygon, false)",
    }
    named = ", ".join(f"{text(f)}, {flags[f]}" for f in FLAGS)
    metrics = "edge_width_px DOUBLE, contrast DOUBLE, touches_border BOOLEAN, ecd_px DOUBLE, qc_aspect_ratio DOUBLE, qc_solidity DOUBLE, has_polygon BOOLEAN"
    kind = "STRUCT<" + ", ".join(f"{f}: BOOLEAN" for f in FLAGS) + ">"
    barred = [f for f in qc.disqualifying_flags if f in FLAGS]
    classes = list(zip(gate.ECD_EDGES[1:-1], gate.bin_labels()[1:], strict=True))
    index = " + ".join(f"CAST(x >= {e!r}D AS INT)" for e, _ in classes)
    labels = ", ".join(map(text, gate.bin_labels()))
    # what comes after the last slash, without an ending after a character (a line's end is none)
    stem = f"regexp_extract(path, {text(STEM)}, 1)"
    pattern, groups = java_regex(cfg.filename.sample_regex)
    picked = lambda name: f"regexp_extract({stem}, {text(pattern)}, {groups[name]})"
    part = lambda name: f"nullif({picked(name)}, '')" if name in groups else "CAST(NULL AS STRING)"
    codes = ", ".join(f"{text(k)}, {text(v)}" for k, v in cfg.filename.camera_map.items() if k)
    cameras = f"try_element_at(map({codes}), {picked('cam')})" if codes and "cam" in groups else "CAST(NULL AS STRING)"
    blank = f"{stem} RLIKE {text(cfg.filename.blank_regex)}"
    # an empty text is no number
    number = f"WHEN NOT {blank} THEN try_cast(regexp_extract({stem}, '(\\\\d+)$', 1) AS BIGINT)"
    if "frame" in groups:
        matched = f"{stem} RLIKE {text(pattern)}"
        number = f"WHEN {matched} THEN try_cast({picked('frame')} AS BIGINT) {number}"
        blank = f"CASE WHEN {matched} THEN {picked('frame')} = '' ELSE {blank} END"
    point = lambda k: f"try_cast(split(trim(p.point), '\\\\s+')[{k}] AS DOUBLE)"
    rings = "split(nullif(regexp_extract(wkt, '^\\\\s*POLYGON\\\\s*\\\\(\\\\s*\\\\((.*)\\\\)\\\\s*\\\\)\\\\s*$', 1), ''), '\\\\)\\\\s*,\\\\s*\\\\(')"
    real = lambda point, k: f"try_cast(get({point}, {k}) AS DOUBLE)"
    side = f"named_struct('ring', ring, 'k', k, 'x', {real('here', 0)}, 'y', {real('here', 1)}, 'nx', {real('get(at, k + 1)', 0)}, 'ny', {real('get(at, k + 1)', 1)})"
    points = "transform(split(body, ','), point -> split(trim(point), '\\\\s+'))"
    return {
        "flags": (metrics, kind, f"named_struct({named})"),
        "accepted": (f"flags {kind}", "BOOLEAN", "NOT (" + " OR ".join(f"coalesce(flags.{f}, false)" for f in barred) + ")" if barred else "true"),
        "active_flags": (f"flags {kind}", "STRING", "concat_ws(',', " + ", ".join(f"CASE WHEN flags.{f} THEN {text(f)} END" for f in FLAGS) + ")"),
        "size_index": ("x DOUBLE", "INT", f"CASE WHEN NOT isnan(x) AND x >= {gate.ECD_EDGES[0]!r}D AND x < double('inf') THEN {index} END"),
        "size_class": ("x DOUBLE", "STRING", f"CASE WHEN NOT isnan(x) AND x >= {gate.ECD_EDGES[0]!r}D AND x < double('inf') THEN array({labels})[{index}] END"),
        "stem": ("path STRING", "STRING", stem),
        "sample": ("path STRING", "STRING", part("sample")),
        "run": ("path STRING", "STRING", part("run")),
        "camera": ("path STRING", "STRING", cameras),
        "is_blank": ("path STRING", "BOOLEAN", blank),
        "frame_index": ("path STRING", "BIGINT", f"CASE {number} END"),
        "vertices": (
            "wkt STRING",
            "TABLE (ring INT, k INT, x DOUBLE, y DOUBLE)",
            f"SELECT r.ring, p.k, {point(0)}, {point(1)} FROM posexplode({rings}) AS r(ring, body), LATERAL posexplode(split(r.body, ',')) AS p(k, point)",
        ),
        "edges": (
            "wkt STRING",
            "ARRAY<STRUCT<ring: INT, k: INT, x: DOUBLE, y: DOUBLE, nx: DOUBLE, ny: DOUBLE>>",
            f"flatten(flatten(transform({rings}, (body, ring) -> transform(array({points}), at -> transform(slice(at, 1, size(at) - 1), (here, k) -> {side})))))",
        ),
    }


def register(spark: SparkSession, cfg: Config | None = None, prefix: str = PREFIX) -> list[str]:
    """Makes the functions known to the session, by the thresholds and names of a configuration:

    flags(edge_width_px, contrast, touches_border, ecd_px, qc_aspect_ratio, qc_solidity, has_polygon), a struct of the six flags;
    accepted(flags), active_flags(flags); size_index(ecd_um), size_class(ecd_um); stem, sample, run, camera, is_blank and frame_index of
    a frame's path; and the table function vertices(wkt), to be joined LATERAL: ring (0 the outline, others its holes), k, x and y, the
    first vertex again at the end as in the text; no rows for null and for what is no polygon.  Spark joins such a table
    with its distinct texts; edges(wkt) is an array instead, to be named in a subquery and opened by inline: ring, k, x and y of each vertex but the last, and
    those of the one after it as nx and ny.
    """
    made = []
    for name, (parameters, returns, body) in bodies(cfg or Config()).items():
        made.append(f"{prefix}{name}")
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {made[-1]}({parameters}) RETURNS {returns} RETURN {body}")
    return made


def register_run(spark: SparkSession, run: str, cfg: Config, prefix: str = "") -> list[str]:
    """Views of a run's tables: grains, contours, manifest and errors; a run without a table has an empty view of it."""
    from skiagram.operators import schema
    from skiagram.sources import tables

    shapes = {"grains": schema.grains(cfg.measure.efd_order), "contours": schema.KEYED_CONTOURS, "manifest": schema.MANIFEST, "errors": schema.ERRORS}
    for name, shape in shapes.items():
        tables.read_table(spark, f"{run}/{name}", cfg.output.format, shape).createOrReplaceTempView(f"{prefix}{name}")
    return [f"{prefix}{name}" for name in shapes]
