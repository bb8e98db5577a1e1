"""Named queries over the adapters, each with the same query in DuckDB's SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skiagram.config import Config, load_config
from skiagram.functions import gate, identity, rings, sql
from skiagram.operators import aggregate, detect, polygons, ranks, resume, review, sampling, schema
from skiagram.plans import adapters as A
from skiagram.sources import colocated, feather, tables

QUERIES: dict = {}
SQL: dict[str, str] = {}

G, FR, RG = A.GRAINS_SQL, A.GRAINS_SQL + "," + A.FRAMES_SQL, A.RINGS_SQL


def query(text: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if text:
            SQL[f.__name__] = text
        return f

    return add


def rounded(df: DataFrame, places: int = 4) -> DataFrame:
    return df.select(*[F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


FLAG_COUNTS = ", ".join(f"count(*) FILTER (WHERE {f}) AS n_{f}" for f in gate.FLAGS)
PCT = ", ".join(f"round(quantile_cont({x}, {q}) FILTER (WHERE qc_pass), 8) AS {x}_d{int(q * 100)}" for x in ("ecd_um", "feret_min_um") for q in (0.1, 0.5, 0.9))
SHAPES = ", ".join(f"round(avg({x}) FILTER (WHERE qc_pass), 8) AS {x}_mean, round(stddev_samp({x}) FILTER (WHERE qc_pass), 8) AS {x}_sd" for x in ("aspect_ratio", "solidity", "circularity"))
COUNTS = "count(*) AS n_total, count(*) FILTER (WHERE qc_pass) AS n_accepted, count(*) FILTER (WHERE NOT qc_pass) AS n_rejected"
BIN = "CASE " + " ".join(f"WHEN ecd_um >= {a} AND ecd_um < {b} THEN {k}" for k, (a, b) in enumerate(zip(gate.ECD_EDGES, (*gate.ECD_EDGES[1:-1], "'inf'::DOUBLE"), strict=False))) + " END"
LABEL = "CASE bin_index " + " ".join(f"WHEN {k} THEN '{n}'" for k, n in enumerate(gate.bin_labels())) + " END"


ACTIVE_SQL = "concat_ws(',', " + ", ".join(f"CASE WHEN {f} THEN '{f}' END" for f in gate.FLAGS) + ")"


@query(f"WITH {G} SELECT sample_id, camera, {COUNTS}, {FLAG_COUNTS}, {PCT}, {SHAPES} FROM grains GROUP BY ALL")
def summary_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(aggregate.summary(A.grains(spark, sf_dir)), 8)


@query(f"WITH {G} SELECT sample_id, camera, {COUNTS}, {FLAG_COUNTS}, {PCT}, {SHAPES} FROM grains GROUP BY ALL")
def summary_by_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As a table too large for maps of values has it: percentiles from range-partitioned ranks."""
    return rounded(aggregate.summary(A.grains(spark, sf_dir), small=False), 8)


@query(f"WITH {G} SELECT grain_uid, sample_id, CAST(row_number() OVER (PARTITION BY sample_id ORDER BY ecd_um, grain_uid) - 1 AS BIGINT) AS place FROM grains")
def places_in_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places in few and large groups, without a task that sees one whole."""
    return ranks.placed(A.grains(spark, sf_dir).select("grain_uid", "sample_id", "ecd_um"), ["sample_id"], ["ecd_um", "grain_uid"], small=False).drop("ecd_um")


SIX = {"convexity": "qc_solidity", "extent": "CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE contrast END", "eccentricity": "CASE WHEN l_orderkey % 5 = 0 THEN 'nan'::DOUBLE ELSE edge_width_px / 10 END", "wadell_roundness": "ecd_px / 60", "wadell_sphericity": "(1 + circularity) / 2", "curvature_entropy": "ln(1 + ecd_px)"}
SIX_SQL = ", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in SIX.items())
SIX_SHAPES = ", ".join(f"round(avg({n}) FILTER (WHERE qc_pass AND NOT isnan({n})), 8) AS {n}_mean, round(stddev_samp({n}) FILTER (WHERE qc_pass AND NOT isnan({n})), 8) AS {n}_sd" for n in SIX)


@query(f"WITH {G}, six AS (SELECT sample_id, camera, qc_pass, {SIX_SQL} FROM grains) SELECT sample_id, camera, count(*) AS n_total, {SIX_SHAPES} FROM six GROUP BY ALL")
def summary_of_other_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six shape columns that the benchmark's grains lack, with nulls and NaN among them, which don't count."""
    given = {n: F.expr(e.replace("'nan'::DOUBLE", "double('nan')")).cast("double") for n, e in SIX.items()}
    g = A.grains(spark, sf_dir).withColumns(given).select("sample_id", "camera", "frame_id", "qc_pass", *SIX)
    return rounded(aggregate.summary(g).drop("n_accepted", "n_rejected"), 8)


@query(f"WITH {G}, b AS (SELECT *, CAST({BIN} AS INTEGER) AS bin_index FROM grains) SELECT sample_id, camera, frame_id, bin_index, CAST(grouping_id(sample_id, camera, frame_id, bin_index) AS BIGINT) AS level, {COUNTS}, {FLAG_COUNTS}, {PCT}, {SHAPES} FROM b GROUP BY GROUPING SETS ((sample_id, camera), (sample_id, camera, frame_id), (sample_id, camera, bin_index)) HAVING NOT (grouping_id(sample_id, camera, frame_id, bin_index) = 2 AND bin_index IS NULL)")
def summaries_in_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By sample, by frame and by size class in one scan and one shuffle; the percentiles of a large table apart."""
    g = A.grains(spark, sf_dir)
    return rounded(aggregate.levels(g, ranks.is_small(g)), 8)


METRICS_SQL = "edge_width_px, contrast, touches_border, ecd_px, qc_aspect_ratio, qc_solidity, has_polygon"


@query(f"WITH {G} SELECT sample_id, camera, {COUNTS}, {FLAG_COUNTS}, {PCT}, {SHAPES} FROM grains GROUP BY ALL")
def summary_by_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary as one SQL text over functions and a view of the session, from the metrics alone."""
    sql.register(spark)
    bare = A.grains(spark, sf_dir).drop(*gate.FLAGS, "qc_pass")
    kept = ", ".join(f"percentile({x}, array(0.1, 0.5, 0.9)) FILTER (WHERE qc_pass) AS {x}_p" for x in aggregate.PERCENT)
    shapes = ", ".join(f"avg({x}) FILTER (WHERE qc_pass) AS {x}_mean, stddev_samp({x}) FILTER (WHERE qc_pass) AS {x}_sd" for x in ("aspect_ratio", "solidity", "circularity"))
    counts = ", ".join(f"count_if(flags.{f}) AS n_{f}" for f in gate.FLAGS)
    made = spark.sql(
        f"""WITH flagged AS (SELECT *, grain_flags({METRICS_SQL}) AS flags FROM {{bare}}),
        gated AS (SELECT *, grain_accepted(flags) AS qc_pass FROM flagged),
        grouped AS (SELECT sample_id, camera, count(*) AS n_total, count_if(qc_pass) AS n_accepted, count_if(NOT qc_pass) AS n_rejected, {counts}, {kept}, {shapes} FROM gated GROUP BY sample_id, camera)
        SELECT * EXCEPT (ecd_um_p, feret_min_um_p), {", ".join(f"{x}_p[{k}] AS {x}_d{d}" for x in aggregate.PERCENT for k, d in enumerate((10, 50, 90)))} FROM grouped""",
        bare=bare,
    )
    return rounded(made, 8)


@query(f"WITH {G}, b AS (SELECT *, CAST({BIN} AS INTEGER) AS bin_index FROM grains) SELECT sample_id AS sample, camera, {LABEL} AS size_class, bin_index AS size_index, {ACTIVE_SQL} AS flags, max(CAST(right(frame_id, 7) AS BIGINT)) AS last_frame, count(*) AS n FROM b GROUP BY ALL")
def classes_by_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identity from paths, size classes and active flags by SQL functions."""
    sql.register(spark)
    g = A.grains(spark, sf_dir).select(F.concat(F.lit("data/"), "frame_id", F.lit(".bmp")).alias("path"), "ecd_um", *METRICS_SQL.split(", "))
    return spark.sql(f"SELECT grain_sample(path) AS sample, grain_camera(path) AS camera, grain_size_class(ecd_um) AS size_class, grain_size_index(ecd_um) AS size_index, grain_active_flags(grain_flags({METRICS_SQL})) AS flags, max(grain_frame_index(path)) AS last_frame, count(*) AS n FROM {{g}} WHERE NOT grain_is_blank(path) GROUP BY ALL", g=g)


@query(f"WITH {G} SELECT sample_id, camera, frame_id, {COUNTS}, {FLAG_COUNTS}, {PCT}, {SHAPES} FROM grains GROUP BY ALL")
def per_frame_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(aggregate.per_frame(A.grains(spark, sf_dir)), 8)


@query(f"WITH {G}, b AS (SELECT *, CAST({BIN} AS INTEGER) AS bin_index FROM grains) SELECT sample_id, camera, {LABEL} AS ecd_bin, bin_index, count(*) AS n_total, count(*) FILTER (WHERE NOT qc_pass) AS n_rejected, round(count(*) FILTER (WHERE NOT qc_pass) / count(*), 4) AS rejection_rate FROM b WHERE bin_index IS NOT NULL GROUP BY ALL")
def rejection_by_ecd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(aggregate.rejection_by_ecd(A.grains(spark, sf_dir)))


@query(f"WITH {G}, b AS (SELECT *, CAST({BIN} AS INTEGER) AS bin_index FROM grains) SELECT {LABEL} AS ecd_bin, bin_index, count(*) AS n_total, round(avg(CAST(NOT qc_pass AS INTEGER)), 4) AS rejection_rate FROM b WHERE bin_index IS NOT NULL GROUP BY ALL")
def rejection_by_ecd_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(aggregate.rejection_by_ecd_global(A.grains(spark, sf_dir)))


UID_COLUMNS = ["grain_uid", "sample_id", "camera", "frame_id", "ecd_um", "contrast"]


@query(f"WITH {G} SELECT grain_uid, sample_id, camera, frame_id, round(ecd_um, 4) AS ecd_um, round(contrast, 4) AS contrast FROM grains WHERE qc_pass")
def accepted_grains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(aggregate.accepted(A.grains(spark, sf_dir)).select(*UID_COLUMNS))


def _regate(spark: SparkSession, sf_dir: str, flags: list[str]) -> DataFrame:
    cfg = load_config(overlay={"qc": {"disqualifying_flags": flags}})
    return gate.regated(A.grains(spark, sf_dir), cfg.qc).groupBy("sample_id", "camera").agg(F.count("*").alias("n_total"), F.count_if("qc_pass").alias("n_accepted"))


@query(f"WITH {G} SELECT sample_id, camera, count(*) AS n_total, count(*) AS n_accepted FROM grains GROUP BY ALL")
def regate_none(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _regate(spark, sf_dir, [])


@query(f"WITH {G} SELECT sample_id, camera, count(*) AS n_total, count(*) FILTER (WHERE qc_pass AND NOT flag_possible_agglomerate) AS n_accepted FROM grains GROUP BY ALL")
def regate_with_agglomerate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _regate(spark, sf_dir, list(gate.FLAGS))


@query(f"WITH {G} " + " UNION ALL ".join(f"SELECT sample_id, camera, '{f}' AS flag, count(*) FILTER (WHERE {f}) AS n_set FROM grains GROUP BY ALL" for f in gate.FLAGS))
def flag_counts_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.flag_counts(A.grains(spark, sf_dir))


@query(f"WITH {G}, n AS (SELECT sample_id, CASE WHEN l_partkey % 7 = 0 THEN 'nan'::DOUBLE ELSE edge_width_px END AS e, contrast FROM grains) SELECT sample_id, count(*) AS n_total, count(*) FILTER (WHERE (NOT isnan(e) AND e > 5.25) OR contrast < 0.70) AS n_defocus FROM n GROUP BY ALL")
def flags_with_nan_edge_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = A.grains(spark, sf_dir).withColumn("edge_width_px", F.when(F.col("l_partkey") % 7 == 0, float("nan")).otherwise(F.col("edge_width_px")))
    return gate.flagged(g, Config().qc).groupBy("sample_id").agg(F.count("*").alias("n_total"), F.count_if("flag_defocus").alias("n_defocus"))


ACTIVE = "concat_ws(',', " + ", ".join(f"CASE WHEN {f} THEN '{f}' END" for f in gate.FLAGS) + ")"


@query(f"WITH {G} SELECT grain_uid, {ACTIVE} AS flags, CASE WHEN qc_pass THEN 'accept' ELSE 'reject' END AS status FROM grains")
def active_flags_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.grains(spark, sf_dir).select("grain_uid", gate.active_flags().alias("flags"), gate.predicted_status(Config().qc.disqualifying_flags).alias("status"))


@query(f"WITH {FR} SELECT frame_path, frame_id AS stem, regexp_extract(frame_id, '^(.+?)_([bz])_([0-9]+)$', 1) AS sample_id, CAST(NULL AS VARCHAR) AS run, camera, CAST(regexp_extract(frame_id, '([0-9]+)$', 1) AS BIGINT) AS frame_index, false AS is_blank FROM frames")
def parse_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.parsed(A.frames(spark, sf_dir).select("frame_path"), Config()).select("frame_path", "stem", "sample_id", "run", "camera", "frame_index", "is_blank")


RUN_REGEX = r"(?P<sample>[^_]+)_(?P<run>[^_]+)_(?P<cam>[bz])_(?:(?P<frame>\d+)|back)$"


@query(f"WITH {FR} SELECT frame_path, split_part(frame_id, '_', 1) AS sample_id, split_part(frame_id, '_', 2) AS run, camera, CAST(split_part(frame_id, '_', 4) AS BIGINT) AS frame_index FROM frames")
def parse_identity_run_scoped(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = load_config(overlay={"filename": {"sample_regex": RUN_REGEX}})
    return identity.parsed(A.frames(spark, sf_dir).select("frame_path"), cfg).select("frame_path", "sample_id", "run", "camera", "frame_index")


@query(f"WITH {FR} SELECT frame_path, 'S9' AS sample_id, 'zoom' AS camera, CAST(right(frame_id, 7) AS BIGINT) AS frame_index FROM frames")
def parse_identity_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.parsed(A.frames(spark, sf_dir).select("frame_path"), Config(), sample_id="S9", camera="zoom").select("frame_path", "sample_id", "camera", "frame_index")


def _with_blanks(frames: DataFrame, has_blank: Column | None = None) -> DataFrame:
    """Paths of frames and of the blank of their sample and camera, in one pass."""
    blank = F.concat(F.lit("data/"), "sample_id", F.when(F.col("camera") == "basic", "_b").otherwise("_z"), F.lit("_back.bmp"))
    blank = blank if has_blank is None else F.when(has_blank, blank)
    return frames.select(F.explode(F.array_compact(F.array("frame_path", blank))).alias("frame_path")).distinct()


BLANKS_SQL = "blanks AS (SELECT sample_id, camera, 'data/' || sample_id || '_' || CASE camera WHEN 'basic' THEN 'b' ELSE 'z' END || '_back.bmp' AS blank_path FROM (SELECT DISTINCT sample_id, camera FROM frames WHERE sample_id <> 'P_N'))"


@query(f"WITH {FR}, {BLANKS_SQL} SELECT frame_path, sample_id, camera, blank_path FROM frames LEFT JOIN blanks USING (sample_id, camera)")
def pair_blanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.with_blanks(identity.parsed(_with_blanks(A.frames(spark, sf_dir), F.col("sample_id") != "P_N"), Config())).select("frame_path", "sample_id", "camera", "blank_path")


@query(f"WITH {FR}, b AS (SELECT split_part(sample_id, '_', 2) AS run, camera, max('data/' || sample_id || '_' || CASE camera WHEN 'basic' THEN 'b' ELSE 'z' END || '_back.bmp') AS blank_path FROM frames GROUP BY ALL) SELECT frame_path, 'P' AS sample_id, run, camera, blank_path FROM (SELECT *, split_part(sample_id, '_', 2) AS run FROM frames) LEFT JOIN b USING (run, camera)")
def pair_blanks_run_scoped(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = load_config(overlay={"filename": {"sample_regex": RUN_REGEX}})
    return identity.with_blanks(identity.parsed(_with_blanks(A.frames(spark, sf_dir)), cfg)).select("frame_path", "sample_id", "run", "camera", "blank_path")


PRINT = "size || ':' || mtime"
MANIFEST_SQL = f"manifest AS (SELECT frame_id, CASE WHEN mtime % 5 = 0 THEN 'old' ELSE {PRINT} END AS fingerprint, CASE WHEN mtime % 11 = 0 THEN 'error' WHEN mtime % 7 = 0 THEN 'empty' ELSE 'ok' END AS status, size % 13 AS n_objects FROM frames WHERE mtime % 3 <> 0)"


def _manifest(frames: DataFrame) -> DataFrame:
    m = F.col("mtime")
    return frames.filter(m % 3 != 0).select("frame_id", F.when(m % 5 == 0, "old").otherwise(F.col("fingerprint")).alias("fingerprint"), F.when(m % 11 == 0, "error").when(m % 7 == 0, "empty").otherwise("ok").alias("status"), (F.col("size") % 13).alias("n_objects"))


def _listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct frames as a table of their own, as a run has them: made once, however often a query reads them."""
    folder = tables.shared_folder(spark)
    A.frames(spark, sf_dir).write.parquet(folder)
    return spark.read.parquet(folder)


def _printed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listed(spark, sf_dir).withColumn("fingerprint", identity.fingerprint(F.col("size"), F.col("mtime")))


@query(f"WITH {FR}, {MANIFEST_SQL} SELECT frame_id, {PRINT} AS fingerprint FROM frames f WHERE NOT EXISTS (SELECT 1 FROM manifest m WHERE m.frame_id = f.frame_id AND m.fingerprint = {PRINT})")
def resume_todo(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _printed(spark, sf_dir)
    return resume.todo(f, _manifest(f)).select("frame_id", "fingerprint")


@query(f"WITH {FR}, {MANIFEST_SQL}, todo AS (SELECT frame_id, {PRINT} AS fingerprint, 'ok' AS status, CAST(1 AS BIGINT) AS n_objects FROM frames f WHERE NOT EXISTS (SELECT 1 FROM manifest m WHERE m.frame_id = f.frame_id AND m.fingerprint = {PRINT})) SELECT * FROM todo UNION ALL SELECT m.* FROM manifest m JOIN frames f ON m.frame_id = f.frame_id AND m.fingerprint = {PRINT}")
def resume_carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _printed(spark, sf_dir)
    old = _manifest(f)
    new = resume.todo(f, old).select("frame_id", "fingerprint", F.lit("ok").alias("status"), F.lit(1).cast("long").alias("n_objects"))
    return resume.carried(f, old, new)


@query(f"WITH {FR} SELECT DISTINCT camera FROM frames WHERE camera <> 'basic'")
def uncalibrated_cameras(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resume.uncalibrated(A.frames(spark, sf_dir), load_config(overlay={"calibration": {"um_per_px": {"basic": 5.0}}}))


@query(f"WITH {FR}, {MANIFEST_SQL} SELECT status, count(*) AS n_frames, CAST(sum(n_objects) AS BIGINT) AS n_objects FROM manifest GROUP BY ALL")
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resume.run_counters(_manifest(_printed(spark, sf_dir)))


@query(f"WITH {G} SELECT grain_uid, frame_id, (row_number() OVER (PARTITION BY frame_id ORDER BY ecd_px, grain_uid) - 0.5::DOUBLE) / count(*) OVER (PARTITION BY frame_id) AS rank_ecd FROM grains")
def quantile_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.quantile_ranked(A.grains(spark, sf_dir).select("grain_uid", "frame_id", "ecd_px"), "ecd_px", "grain_uid", "frame_id", name="rank_ecd", small=True).drop("ecd_px")


CONTOURS_SQL = "contours AS (SELECT grain_uid, frame_id, 'POLYGON ' || label AS wkt FROM grains WHERE has_polygon)"


def _contours(g: DataFrame) -> DataFrame:
    return g.filter("has_polygon").select("grain_uid", "frame_id", F.concat(F.lit("POLYGON "), F.col("label").cast("string")).alias("wkt"))


@query(f"WITH {G}, {CONTOURS_SQL} SELECT g.grain_uid, c.wkt FROM grains g LEFT JOIN contours c USING (grain_uid)")
def grains_with_contours(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = A.grains(spark, sf_dir)
    return review.with_contours(g, _contours(g)).select("grain_uid", "wkt")


@query(f"WITH {G}, {CONTOURS_SQL} SELECT g.grain_uid, c.wkt FROM grains g LEFT JOIN contours c USING (grain_uid)")
def grains_with_contours_colocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over tables that lie in the same buckets: read and joined without a shuffle."""
    g, folder, n = A.grains(spark, sf_dir).select("grain_uid", "frame_id"), tables.shared_folder(spark), 8
    c = _contours(A.grains(spark, sf_dir))
    stored = [colocated.read(spark, colocated.write(t, f"{folder}/{name}", n), t.schema, n) for name, t in (("grains", g), ("contours", c))]
    return review.with_contours(*stored).select("grain_uid", "wkt")


@query(f"WITH {G}, {CONTOURS_SQL} SELECT grain_uid, frame_id FROM contours WHERE frame_id IN (SELECT frame_id FROM grains GROUP BY frame_id HAVING count(*) FILTER (WHERE qc_pass) > 20)")
def contours_of_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = A.grains(spark, sf_dir)
    busy = aggregate.per_frame(g).filter("n_accepted > 20").select("frame_id")
    return resume.of_frames(_contours(g), busy).select("grain_uid", "frame_id")


@query(f"WITH {G} SELECT 'quality ' || l.quality AS label_name, g.qc_pass, count(*) AS n FROM grains g JOIN labels l ON g.l_orderkey = l.doc_id GROUP BY ALL")
def label_crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = A.grains(spark, sf_dir)
    given = spark.read.parquet(f"{sf_dir}/labels.parquet").select(F.col("doc_id").alias("l_orderkey"), F.concat(F.lit("quality "), F.col("quality").cast("string")).alias("label_name"))
    return review.label_scores(g.select("grain_uid", "l_orderkey").join(given, "l_orderkey"), g)


PLACES = "listing AS (SELECT 'z/' || frame_id || '.bmp' AS path, 2 AS deep FROM frames WHERE mtime % 3 <> 0 UNION ALL SELECT 'a/' || frame_id || '.bmp', 2 FROM frames WHERE mtime % 2 = 0 UNION ALL SELECT 'data/' || frame_id || '.bmp', 1 FROM frames WHERE mtime % 5 = 0)"


def _places(f: DataFrame) -> DataFrame:
    """Files of frames in up to three folders: where the frames were and elsewhere."""
    at = lambda d: F.concat(F.lit(f"{d}/"), "frame_id", F.lit(".bmp")).alias("frame_path")
    return f.filter("mtime % 3 <> 0").select(at("z")).unionByName(f.filter("mtime % 2 = 0").select(at("a"))).unionByName(f.filter("mtime % 5 = 0").select(at("data")))


@query(f"WITH {FR}, {PLACES} SELECT f.frame_path, arg_min(l.path, (CAST(l.path <> f.frame_path AS INTEGER), l.path)) AS path FROM frames f JOIN listing l ON split_part(l.path, '/', 2) = f.frame_id || '.bmp' GROUP BY f.frame_path")
def first_match_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _listed(spark, sf_dir)
    return review.resolved_frames(f.select("frame_path"), _places(f))


@query(f"WITH {FR}, {PLACES} SELECT f.frame_id, coalesce(min(l.path) FILTER (WHERE l.path LIKE 'a/%'), f.frame_path) AS path FROM frames f LEFT JOIN listing l ON split_part(l.path, '/', 2) = f.frame_id || '.bmp' GROUP BY f.frame_id, f.frame_path")
def label_tool_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _listed(spark, sf_dir)
    return review.label_frames(f.select("frame_id", "frame_path"), _places(f).filter("frame_path like 'a/%'"))


@query(f"WITH {G}, {CONTOURS_SQL} SELECT frame_id, count(*) FILTER (WHERE qc_pass) AS n_accepted, count(*) FILTER (WHERE NOT qc_pass) AS n_rejected, count(*) <= 50 AS draw_labels, count(c.wkt) AS n_outlines, 'data/' || frame_id || '.bmp' AS path FROM grains LEFT JOIN contours c USING (grain_uid, frame_id) GROUP BY frame_id")
def overlay_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = A.grains(spark, sf_dir).withColumns({"frame_path": F.concat(F.lit("data/"), "frame_id", F.lit(".bmp")), "centroid_x": F.lit(1.0), "centroid_y": F.lit(2.0)})
    drawn = review.outlined(g, _contours(g), g.select("frame_path").distinct())
    return drawn.select("frame_id", "n_accepted", "n_rejected", "draw_labels", F.size(F.filter("outlines", lambda o: o["wkt"].isNotNull())).cast("long").alias("n_outlines"), "path")


HALF = "greatest(ecd_um / 4, 20)"


@query(f"WITH {G}, t AS (SELECT *, l_partkey % 3000 AS cx, l_orderkey % 2100 AS cy, {HALF} AS half, row_number() OVER (PARTITION BY frame_id ORDER BY grain_uid) - 1 AS i FROM grains), w AS (SELECT *, greatest(cx - half, 0) AS a, greatest(cy - half, 0) AS b, least(cx + half, 2048) AS d, least(cy + half, 2048) AS e FROM t) SELECT grain_uid, CAST(i % 24 // 6 AS INTEGER) AS tile_row, CAST(i % 24 % 6 AS INTEGER) AS tile_column, grain_uid || chr(10) || CAST(round_even(ecd_um, 0) AS BIGINT) || 'µm' AS caption, 'data/' || frame_id || '.bmp' AS path, CASE WHEN trunc(d) > trunc(a) AND trunc(e) > trunc(b) THEN CAST(trunc(a) AS INTEGER) END AS x0, CASE WHEN trunc(d) > trunc(a) AND trunc(e) > trunc(b) THEN CAST(trunc(b) AS INTEGER) END AS y0, CASE WHEN trunc(d) > trunc(a) AND trunc(e) > trunc(b) THEN CAST(trunc(d) AS INTEGER) END AS x1, CASE WHEN trunc(d) > trunc(a) AND trunc(e) > trunc(b) THEN CAST(trunc(e) AS INTEGER) END AS y1 FROM w")
def sheet_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    more = {"frame_path": F.concat(F.lit("data/"), "frame_id", F.lit(".bmp")), "um_per_px": F.lit(4.0), "centroid_x": (F.col("l_partkey") % 3000).cast("double"), "centroid_y": (F.col("l_orderkey") % 2100).cast("double")}
    g = A.grains(spark, sf_dir).withColumns(more | {"frame_rows": F.lit(2048), "frame_cols": F.lit(2048)})
    at = review.resolved_frames(g.select("frame_path").distinct(), g.select("frame_path").distinct())
    return review.tiles(sampling.paged(g, "grain_uid", "frame_id", small=True), at).select("grain_uid", "tile_row", "tile_column", "caption", "path", "x0", "y0", "x1", "y1")


@query(f"WITH {G} SELECT grain_uid, sample_id, camera, CASE WHEN qc_pass THEN 'accept' ELSE 'reject' END AS qc_status, {ACTIVE} AS flags FROM grains WHERE frame_id IN (SELECT frame_id FROM grains GROUP BY frame_id ORDER BY frame_id LIMIT 5)")
def predictions_of_first_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = A.grains(spark, sf_dir)
    return review.with_predictions(resume.of_frames(g, aggregate.frame_hint(g)), Config()).select("grain_uid", "sample_id", "camera", "qc_status", "flags")


@query(f"WITH {G} SELECT DISTINCT frame_id FROM grains ORDER BY frame_id LIMIT 5")
def frame_hint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report feature: the first five frame ids of a run."""
    return aggregate.frame_hint(A.grains(spark, sf_dir))


@query(f"WITH {FR} SELECT frame_id, CAST(row_number() OVER (PARTITION BY sample_id ORDER BY camera, CAST(right(frame_id, 7) AS BIGINT), frame_id) AS INTEGER) AS place FROM frames")
def frames_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = identity.parsed(A.frames(spark, sf_dir).select("frame_path"), Config())
    return f.select(F.col("stem").alias("frame_id"), F.row_number().over(Window.partitionBy("sample_id").orderBy(*identity.frame_order())).alias("place"))


@query("SELECT 'f' || l_orderkey || ':' || l_linenumber AS grain_uid, CAST(l_linenumber AS VARCHAR) AS suffix, count(*) AS n FROM lineitem GROUP BY ALL")
def uid_and_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    uid = identity.grain_uid(F.concat(F.lit("f"), F.col("l_orderkey").cast("string")), F.col("l_linenumber"))
    return rows.select(uid.alias("grain_uid")).select("grain_uid", identity.uid_suffix(F.col("grain_uid")).alias("suffix")).groupBy("grain_uid", "suffix").agg(F.count("*").alias("n"))


@query("SELECT s.s_suppkey AS grain_uid, coalesce(p.s_suppkey, s.s_suppkey) AS previous_uid, coalesce(n.s_suppkey, s.s_suppkey) AS next_uid FROM (SELECT 's' || s_suppkey AS s_suppkey, s_suppkey AS k FROM supplier) s LEFT JOIN (SELECT 's' || s_suppkey AS s_suppkey, s_suppkey AS k FROM supplier) p ON p.k = s.k - 1 LEFT JOIN (SELECT 's' || s_suppkey AS s_suppkey, s_suppkey AS k FROM supplier) n ON n.k = s.k + 1")
def labelling_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("grain_uid"), F.col("s_suppkey").alias("position"))
    return review.neighbours(order).select("grain_uid", "previous_uid", "next_uid")


@query("SELECT 's' || s_suppkey AS grain_uid, CAST(s_suppkey AS BIGINT) AS position, (SELECT count(*) FROM supplier WHERE s_suppkey % 3 = 0 OR s_suppkey < 7) AS n_labelled, (SELECT count(*) FROM supplier) AS n_total FROM supplier WHERE s_suppkey = (SELECT min(s_suppkey) FROM supplier WHERE NOT (s_suppkey % 3 = 0 OR s_suppkey < 7))")
def labelling_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("grain_uid"), F.col("s_suppkey").cast("long").alias("position"))
    return review.progress(order, order.filter("position % 3 = 0 or position < 7"))


@query(f"WITH {FR}, {MANIFEST_SQL} SELECT frame_id, arg_max(fingerprint, n) AS fingerprint, arg_max(n_objects, n) AS n_objects FROM (SELECT frame_id, fingerprint, n_objects, 1 AS n FROM manifest UNION ALL SELECT frame_id, 'later', CAST(99 AS BIGINT), 2 FROM manifest WHERE n_objects > 4) GROUP BY frame_id")
def latest_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = _manifest(_printed(spark, sf_dir)).select("frame_id", "fingerprint", "n_objects", F.lit(1).alias("n"))
    later = old.filter("n_objects > 4").select("frame_id", F.lit("later").alias("fingerprint"), F.lit(99).cast("long").alias("n_objects"), F.lit(2).alias("n"))
    return resume.latest(old.unionByName(later), "frame_id", "n").select("frame_id", "fingerprint", "n_objects")


@query(f"WITH {FR}, {MANIFEST_SQL} SELECT frame_id, fingerprint, status, n_objects FROM manifest WHERE n_objects NOT IN (3, 5) UNION ALL SELECT frame_id, 'new', 'ok', CAST(1 AS BIGINT) FROM frames WHERE size % 13 = 3")
def upserted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Touched frames lose their rows and get their new ones, if they have any."""
    f = _printed(spark, sf_dir)
    new = f.filter("size % 13 = 3").select("frame_id", F.lit("new").alias("fingerprint"), F.lit("ok").alias("status"), F.lit(1).cast("long").alias("n_objects"))
    return resume.upserted(_manifest(f), new, f.filter("size % 13 in (3, 5)"))


NESTED = ("ecd_um", "contrast", "ecd_px", "edge_width_px", "qc_aspect_ratio", "qc_solidity", "touches_border", "has_polygon")


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grains as the frame pass leaves them: nested by frame, without flags, a line number telling them apart within an order."""
    g = A.grains(spark, sf_dir).withColumn("frame_id", F.concat_ws("/", "frame_id", F.col("l_orderkey") % 7)).withColumn("label", F.row_number().over(Window.partitionBy("frame_id").orderBy("l_orderkey", "label", "l_partkey")))
    inner = [f for f in schema.results(Config().measure.efd_order)["particles"].dataType.elementType.fields]
    made = {n: F.col(n) for n in NESTED} | {"label": F.col("label"), "um_per_px": F.lit(2.0), "wkt": F.when(F.col("has_polygon"), F.concat(F.lit("POLYGON "), F.col("label").cast("string")))}
    one = F.struct(*[made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in inner])
    return g.groupBy("frame_id", "sample_id", "camera").agg(F.collect_list(one).alias("particles")).withColumns({"frame_path": F.col("frame_id"), "run": F.lit(None).cast("string"), "status": F.when(F.size("particles") % 3 == 0, "error").otherwise("ok"), "fingerprint": F.lit("p"), "n_objects": F.size("particles").cast("long"), "flatfield_method": F.lit("blank"), "traceback": F.lit("t")})


WHERE = "frame_id || '/' || (l_orderkey % 7)"
MANY = f"numbered AS (SELECT * REPLACE ({WHERE} AS frame_id, row_number() OVER (PARTITION BY {WHERE} ORDER BY l_orderkey, label, l_partkey) AS label) FROM grains)"
FLAG_LIST = ", ".join(gate.FLAGS)


@query(f"WITH {G}, {MANY} SELECT frame_id || ':' || label AS grain_uid, sample_id, camera, round(ecd_um, 4) AS ecd_um, {FLAG_LIST}, qc_pass FROM numbered")
def results_to_grains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(detect.grains(_results(spark, sf_dir), Config()).select("grain_uid", "sample_id", "camera", "ecd_um", *gate.FLAGS, "qc_pass"))


@query(f"WITH {G}, {MANY} SELECT frame_id || ':' || label AS grain_uid, 'POLYGON ' || label AS wkt, 2.0::DOUBLE AS um_per_px FROM numbered WHERE has_polygon")
def results_to_contours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect.contours(_results(spark, sf_dir)).select("grain_uid", "wkt", "um_per_px")


@query(f"WITH {G}, {MANY} SELECT frame_id, CASE WHEN count(*) % 3 = 0 THEN 'error' ELSE 'ok' END AS status, count(*) AS n_objects, 0.0::DOUBLE AS seconds FROM numbered GROUP BY ALL")
def results_to_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect.manifest(_results(spark, sf_dir), Config()).select("frame_id", "status", "n_objects", "seconds")


@query(f"WITH {G}, {MANY} SELECT frame_id, 't' AS traceback FROM numbered GROUP BY ALL HAVING count(*) % 3 = 0")
def results_to_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect.errors(_results(spark, sf_dir)).select("frame_id", "traceback")


KEPT_COLUMNS = ["grain_uid", "frame_id", "sample_id", "camera", "label", "ecd_um", "edge_width_px", *gate.FLAGS, "qc_pass"]


def _stored(spark: SparkSession, sf_dir: str, fmt: str, keys: list[str]) -> DataFrame:
    """Grains written as a table of a format and read again."""
    g = A.grains(spark, sf_dir).select(*KEPT_COLUMNS)
    path = tables.write_partitioned(g, f"{tables.working_folder(spark)}/grains", fmt, keys)
    return rounded(tables.read_table(spark, path, fmt, g.schema).select(*KEPT_COLUMNS))


STORED_SQL = f"WITH {G} SELECT grain_uid, frame_id, sample_id, camera, label, round(ecd_um, 4) AS ecd_um, round(edge_width_px, 4) AS edge_width_px, {FLAG_LIST}, qc_pass FROM grains"


@query(STORED_SQL)
def stored_as_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "csv", [])


@query(STORED_SQL)
def stored_as_partitioned_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In folders by key, with the keys inside the files too."""
    return _stored(spark, sf_dir, "csv", ["sample_id", "camera"])


@query(STORED_SQL)
def stored_as_discovered_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As text columns, of which those that hold True and False alone become booleans."""
    g = A.grains(spark, sf_dir).select(*KEPT_COLUMNS)
    path = tables.write_table(g, f"{tables.working_folder(spark)}/grains", "csv")
    found = tables.with_booleans(spark.read.option("header", "true").csv(path))
    flags = [c for c, t in found.dtypes if t == "boolean"]
    return rounded(found.select(*[F.col(c) if c in flags else F.col(c).cast(g.schema[c].dataType).alias(c) for c in KEPT_COLUMNS]))


@query(STORED_SQL)
def stored_as_feather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "feather", ["sample_id", "camera"])


@query(f"WITH {G} SELECT grain_uid, round(ecd_um, 4) AS ecd_um, label FROM grains WHERE camera = 'zoom' AND ecd_um > 1500 AND label IN (1, 3)")
def feather_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four of eighteen columns of a feather table in folders; where the session pushes filters, rows and folders are left out on reading."""
    g = A.grains(spark, sf_dir).select(*KEPT_COLUMNS, "contrast", "qc_solidity", "circularity", "feret_min_um")
    path = tables.write_partitioned(g, f"{tables.working_folder(spark)}/grains", "feather", ["sample_id", "camera"])
    some = StructType([g.schema[c] for c in ("grain_uid", "camera", "ecd_um", "label")])
    return rounded(feather.read(spark, path, some).filter("camera = 'zoom' and ecd_um > 1500 and label in (1, 3)").drop("camera"))


@query(STORED_SQL)
def stored_as_partitioned_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "parquet", ["sample_id", "camera"])


@query(f"WITH {G} SELECT grain_uid, sample_id, camera, round(contrast, 4) AS contrast, flag_defocus FROM grains")
def focus_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = A.grains(spark, sf_dir).withColumn("edge_gradient_norm", F.lit(1.0))
    return rounded(review.focus_scatter(g).drop("edge_gradient_norm"))


@query(f"WITH {G}, e AS (SELECT list_distinct(quantile_cont(ecd_um, [0.2, 0.4, 0.6, 0.8])) AS e FROM grains WHERE qc_pass), s AS (SELECT grain_uid, frame_id, CAST(len(list_filter(e, lambda x: x < ecd_um)) AS INTEGER) AS stratum FROM grains, e WHERE qc_pass), p AS (SELECT *, row_number() OVER (PARTITION BY frame_id, stratum ORDER BY grain_uid) AS position FROM s) SELECT grain_uid, frame_id, stratum, CAST(position AS INTEGER) AS position, CAST(floor((position - 1) / 24) + 1 AS INTEGER) AS page FROM p")
def stratified_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = sampling.strata(aggregate.accepted(A.grains(spark, sf_dir)), "ecd_um").select("grain_uid", "frame_id", "stratum")
    return sampling.paged(cut, "grain_uid", "frame_id", "stratum", small=True)


@query(f"WITH {G}, a AS (SELECT grain_uid, ecd_um FROM grains WHERE qc_pass), e AS (SELECT list_distinct(quantile_cont(ecd_um, [0.2, 0.4, 0.6, 0.8])) AS e FROM a), s AS (SELECT len(list_filter(e, lambda x: x < ecd_um)) AS stratum, count(*) AS n FROM a, e GROUP BY ALL) SELECT CAST(stratum AS INTEGER) AS stratum, least(n, 96 // (SELECT count(*) FROM s)) AS n_drawn FROM s")
def stratified_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A contact sheet of more accepted grains than its 96 tiles: as many of each stratum."""
    a = aggregate.accepted(A.grains(spark, sf_dir)).select("grain_uid", "ecd_um")
    drawn = sampling.stratified(a, "ecd_um", 96, "grain_uid", seed=5).select("grain_uid")
    cut = sampling.strata(a, "ecd_um")
    return cut.join(drawn.distinct(), "grain_uid", "left_semi").groupBy("stratum").agg(F.count("*").alias("n_drawn"))


AXES, DESIGN = ["ecd_um", "contrast", "ecd_px"], sampling.hypercube_points(12, 3, 7)
DESIGN_SQL = ", ".join(f"({k}, {', '.join(f'{x!r}::DOUBLE' for x in map(float, p))})" for k, p in enumerate(DESIGN))
AXES_SQL = ", ".join(f"(row_number() OVER (ORDER BY {x}, grain_uid) - 0.5::DOUBLE) / count(*) OVER () AS r{d}" for d, x in enumerate(AXES))
FAR = " + ".join(f"(r{d} - p{d}) * (r{d} - p{d})" for d in range(len(AXES)))


@query(f"WITH RECURSIVE {G.strip()}, ranked AS MATERIALIZED (SELECT grain_uid, {AXES_SQL} FROM grains), design(i, p0, p1, p2) AS (VALUES {DESIGN_SQL}), taken AS (SELECT -1 AS i, []::VARCHAR[] AS uids UNION ALL SELECT t.i + 1, list_append(t.uids, (SELECT arg_min(grain_uid, ({FAR}, grain_uid)) FROM ranked, design d WHERE d.i = t.i + 1 AND NOT list_contains(t.uids, grain_uid))) FROM taken t WHERE t.i < {len(DESIGN) - 1}) SELECT unnest(uids) AS grain_uid FROM taken WHERE i = {len(DESIGN) - 1}")
def hypercube_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dozen grains spread over the quantiles of three measures, each the nearest to its point that the points before have left."""
    return sampling.hypercube_sample(A.grains(spark, sf_dir), AXES, len(DESIGN), 7).select("grain_uid")


@query(f"WITH {G}, u AS (" + " UNION ALL ".join(f"SELECT grain_uid, '{f}' AS flag FROM grains WHERE {f} AND NOT qc_pass" for f in gate.FLAGS) + ") SELECT grain_uid, flag, CAST(row_number() OVER (PARTITION BY flag ORDER BY grain_uid) AS INTEGER) AS position, CAST(floor((row_number() OVER (PARTITION BY flag ORDER BY grain_uid) - 1) / 24) + 1 AS INTEGER) AS page FROM u")
def rejected_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.rejected_pages(A.grains(spark, sf_dir), list(gate.FLAGS))


@query(f"WITH {RG} SELECT vec_id, round(abs(sum(x * ny - nx * y)) / 2, 4) AS area_px, round(sum(sqrt((nx - x) * (nx - x) + (ny - y) * (ny - y))), 4) AS perimeter_px, round(2 * sqrt(abs(sum(x * ny - nx * y)) / 2 / pi()), 4) AS ecd_px FROM edges GROUP BY vec_id")
def polygon_area_perimeter_ecd(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = F.col("xs"), F.col("ys")
    a = rings.area(x, y)
    return rounded(A.rings(spark, sf_dir).select("vec_id", a.alias("area_px"), rings.perimeter(x, y).alias("perimeter_px"), rings.ecd(a).alias("ecd_px")))


@query(f"WITH {RG} SELECT vec_id, count(*) AS n_vertices, round(abs(sum(x * ny - nx * y)) / 2, 4) AS area_px, round(sum(sqrt((nx - x) * (nx - x) + (ny - y) * (ny - y))), 4) AS perimeter_px, round(min(x), 4) AS x0, round(min(y), 4) AS y0, round(max(x), 4) AS x1, round(max(y), 4) AS y1 FROM edges GROUP BY vec_id")
def outlines_by_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vertices, area, length and bounds of outlines stored as text, by the array of their edges: no join or window, so edges are summed
    where they are made."""
    sql.register(spark)
    point = F.zip_with("xs", "ys", lambda x, y: F.concat_ws(" ", x.cast("string"), y.cast("string")))
    outlines = A.rings(spark, sf_dir).repartition("vec_id").select("vec_id", F.concat(F.lit("POLYGON (("), F.array_join(F.concat(point, F.slice(point, 1, 1)), ", "), F.lit("))")).alias("wkt"))
    made = spark.sql(
        """SELECT vec_id, count(*) AS n_vertices, abs(sum(x * ny - nx * y)) / 2 AS area_px, sum(sqrt((nx - x) * (nx - x) + (ny - y) * (ny - y))) AS perimeter_px, min(x) AS x0, min(y) AS y0, max(x) AS x1, max(y) AS y1 FROM (SELECT vec_id, grain_edges(wkt) AS edges FROM {outlines}) LATERAL VIEW OUTER inline(edges) e WHERE nx IS NOT NULL GROUP BY vec_id""",
        outlines=outlines,
    )
    return rounded(made)


@query(f"WITH {RG} SELECT vec_id, round(4 * pi() * (abs(sum(x * ny - nx * y)) / 2) / pow(sum(sqrt((nx - x) * (nx - x) + (ny - y) * (ny - y))), 2), 4) AS circularity FROM edges GROUP BY vec_id")
def polygon_circularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = F.col("xs"), F.col("ys")
    return rounded(A.rings(spark, sf_dir).select("vec_id", rings.circularity(rings.area(x, y), rings.perimeter(x, y)).alias("circularity")))


@query(f"WITH {RG} SELECT vec_id, greatest(CAST(floor(min(y)) AS BIGINT) - 2, 0) AS r0, greatest(CAST(floor(min(x)) AS BIGINT) - 2, 0) AS c0, least(CAST(ceil(max(y)) AS BIGINT) + 2, 120) AS r1, least(CAST(ceil(max(x)) AS BIGINT) + 2, 120) AS c1 FROM points GROUP BY vec_id")
def polygon_bbox_crop(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = rings.crop_box(F.col("xs"), F.col("ys"), 2, F.lit(120).cast("long"), F.lit(120).cast("long"))
    return A.rings(spark, sf_dir).select("vec_id", *[c.cast("long").alias(n) for n, c in box.items()])


@query(f"WITH {RG} SELECT a.vec_id, round(max(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))), 4) AS feret_max_px FROM points a JOIN points b ON a.vec_id = b.vec_id GROUP BY a.vec_id")
def feret_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(polygons.per_ring(A.rings(spark, sf_dir), "vec_id", polygons.measures(1.0, ["feret_max_um"]), schema.of(feret_max_px=schema.REAL)))


ARC = "sums AS (SELECT *, sqrt((nx - x) * (nx - x) + (ny - y) * (ny - y)) AS s, coalesce(sum(sqrt((nx - x) * (nx - x) + (ny - y) * (ny - y))) OVER (PARTITION BY vec_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS t FROM edges), arc AS (SELECT *, sum(s) OVER (PARTITION BY vec_id) AS whole FROM sums)"


@query(f"WITH {RG}, {ARC}, w AS (SELECT DISTINCT vec_id, i, whole * i / 48.0::DOUBLE AS want FROM arc, range(48) r(i)), p AS (SELECT w.vec_id, i, x + (want - t) / s * (nx - x) AS x, y + (want - t) / s * (ny - y) AS y, row_number() OVER (PARTITION BY w.vec_id, i ORDER BY k DESC) AS rn FROM w JOIN arc a ON w.vec_id = a.vec_id AND a.t <= w.want) SELECT vec_id, i, round(x, 4) AS x, round(y, 4) AS y FROM p WHERE rn = 1")
def boundary_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(polygons.per_ring(A.rings(spark, sf_dir), "vec_id", polygons.resampled(48), schema.of(i=schema.LONG, x=schema.REAL, y=schema.REAL)))


@query(f"WITH {RG}, {ARC}, h AS (SELECT vec_id, h, whole / (2 * pi() * pi() * h * h) * sum((nx - x) / s * (cos(2 * pi() * h * (t + s) / whole) - cos(2 * pi() * h * t / whole))) AS a, whole / (2 * pi() * pi() * h * h) * sum((nx - x) / s * (sin(2 * pi() * h * (t + s) / whole) - sin(2 * pi() * h * t / whole))) AS b, whole / (2 * pi() * pi() * h * h) * sum((ny - y) / s * (cos(2 * pi() * h * (t + s) / whole) - cos(2 * pi() * h * t / whole))) AS c, whole / (2 * pi() * pi() * h * h) * sum((ny - y) / s * (sin(2 * pi() * h * (t + s) / whole) - sin(2 * pi() * h * t / whole))) AS d FROM arc, range(1, 16) r(h) GROUP BY vec_id, h, whole), p AS (SELECT vec_id, h, a * a + b * b + c * c + d * d AS power FROM h), q AS (SELECT *, sum(power) OVER (PARTITION BY vec_id ORDER BY h) AS run, sum(power) OVER (PARTITION BY vec_id) AS whole FROM p) SELECT vec_id, round(max(whole), 2) AS power, CAST(count(*) FILTER (WHERE run < 0.9 * whole) + 1 AS BIGINT) AS cum_90, CAST(count(*) FILTER (WHERE run < 0.999 * whole) + 1 AS BIGINT) AS cum_999 FROM q GROUP BY vec_id")
def efd_power_cum90(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(polygons.per_ring(A.rings(spark, sf_dir), "vec_id", polygons.harmonic_power(15), schema.of(power=schema.REAL, cum_90=schema.LONG, cum_999=schema.LONG)), 2)


NEXT = "(PARTITION BY vec_id ORDER BY k)"
CENTRAL = "coalesce(lead({v}) OVER w, first_value({v}) OVER w) - coalesce(lag({v}) OVER w, last_value({v}) OVER (PARTITION BY vec_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"


@query(f"WITH {RG}, d1 AS (SELECT vec_id, k, ({CENTRAL.format(v='x')}) / 2 AS dx, ({CENTRAL.format(v='y')}) / 2 AS dy FROM points WINDOW w AS {NEXT}), d2 AS (SELECT *, ({CENTRAL.format(v='dx')}) / 2 AS ddx, ({CENTRAL.format(v='dy')}) / 2 AS ddy FROM d1 WINDOW w AS {NEXT}), c AS (SELECT vec_id, (dx * ddy - dy * ddx) / pow(dx * dx + dy * dy, 1.5) AS v FROM d2), b AS (SELECT vec_id, least(CAST(floor((v - min(v) OVER p) / (max(v) OVER p - min(v) OVER p) * 32) AS INTEGER), 31) AS bin FROM c WINDOW p AS (PARTITION BY vec_id)), n AS (SELECT vec_id, bin, count(*) / 64.0::DOUBLE AS share FROM b GROUP BY ALL) SELECT vec_id, round(-sum(share * ln(share)) / ln(32), 4) AS entropy FROM n GROUP BY vec_id")
def curvature_entropy_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(polygons.per_ring(A.rings(spark, sf_dir), "vec_id", polygons.turning_entropy(32), schema.of(entropy=schema.REAL)))


@query(f"WITH {RG}, pairs AS (SELECT a.vec_id, a.k AS i, b.k AS j, a.x AS ax, a.y AS ay, (b.x - a.x) / sqrt(pow(b.x - a.x, 2) + pow(b.y - a.y, 2)) AS ex, (b.y - a.y) / sqrt(pow(b.x - a.x, 2) + pow(b.y - a.y, 2)) AS ey FROM points a JOIN points b ON a.vec_id = b.vec_id AND a.k <> b.k), o AS (SELECT p.vec_id, i, j, min(ex * (c.y - ay) - ey * (c.x - ax)) AS low, max(ex * (c.y - ay) - ey * (c.x - ax)) AS high FROM pairs p JOIN points c ON p.vec_id = c.vec_id GROUP BY ALL) SELECT vec_id, round(min(high), 4) AS feret_min_px FROM o WHERE low >= -1e-9 GROUP BY vec_id")
def feret_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(polygons.per_ring(A.rings(spark, sf_dir), "vec_id", polygons.measures(1.0, ["feret_min_um"]), schema.of(feret_min_px=schema.REAL)))


RIGHT = {
    "area": "abs(area_px / (pi() * a * b) - 1) < 0.02",
    "perimeter": "abs(perimeter_um / (pi() * (a + b) * (1 + 3 * pow((a - b) / (a + b), 2) / (10 + sqrt(4 - 3 * pow((a - b) / (a + b), 2))))) - 1) < 0.02",
    "crofton": "abs(perimeter_crofton_px / perimeter_um - 1) < 0.08",
    "axes": "abs(major_axis_um / (2 * a) - 1) < 0.03 and abs(minor_axis_um / (2 * b) - 1) < 0.04",
    "feret": "abs(feret_max_um / (2 * a) - 1) < 0.02 and abs(feret_min_um / (2 * b) - 1) < 0.03",
    "shape": "solidity > 0.97 and abs(circularity / (4 * pi() * area_px / pow(perimeter_um, 2)) - 1) < 1e-9",
    "sphericity": "abs(wadell_sphericity / (b / a) - 1) < 0.04",
    "sharp": "edge_width_px < 3 and contrast > 0.85",
}


@query("SELECT CAST(s_suppkey AS BIGINT) AS key, CAST(1 AS BIGINT) AS n_objects, true AS has_polygon, false AS touches_border, " + ", ".join(f"true AS {n}_right" for n in RIGHT) + " FROM supplier")
def detect_synthetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frame kernel over a frame a supplier, an ellipse whose size and place follow the key: whether its measures are those of
    the ellipse, within a few hundredths."""
    rows = detect.drawn(spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey"), Config())
    return rows.select("key", "n_objects", "has_polygon", "touches_border", *[F.expr(test).alias(f"{n}_right") for n, test in RIGHT.items()])
