import pytest

from skiagram.config import Config, config_hash, load_config
from skiagram.functions import gate, identity

NAN = float("nan")


def test_nan_never_flags(spark):
    rows = spark.createDataFrame([(NAN, 0.9, 50.0, 1.0, 1.0, False, True), (9.0, NAN, NAN, NAN, NAN, False, True)], "edge_width_px double, contrast double, ecd_px double, qc_aspect_ratio double, qc_solidity double, touches_border boolean, has_polygon boolean")
    got = [tuple(r) for r in gate.flagged(rows, Config().qc).select("flag_defocus", "flag_too_small", "flag_sliver", "qc_pass").collect()]
    assert got == [(False, False, False, True), (True, False, False, False)]


def test_gate_of_no_flags_and_of_unknown_flags(spark):
    rows = spark.createDataFrame([(True,)], "flag_border boolean")
    assert rows.select(gate.gate(rows, [])).first()[0]
    with pytest.raises(KeyError):
        gate.gate(rows, ["nothing"])


def test_bins_are_half_open(spark):
    rows = spark.createDataFrame([(x,) for x in (-1.0, 0.0, 62.5, 4000.0, float("inf"), NAN, None)], "x double")
    assert [r[0] for r in rows.select(gate.ecd_bin(rows.x)).collect()] == [None, "0-62.5", "62.5-125", "4000+", None, None, None]


def test_config_is_strict_and_hashed():
    assert len(config_hash(Config())) == 12
    with pytest.raises(ValueError):
        load_config(overlay={"qc": {"nothing": 1}})
    with pytest.raises(KeyError):
        Config().um_per_px("basic")


@pytest.mark.parametrize(("name", "options", "want"), [
    ("P_01_cs_003_b_0004258.bmp", {}, ("P_01_cs_003", "basic", 4258, False)),
    ("P_17_cs_002_z_back.bmp", {}, ("P_17_cs_002", "zoom", None, True)),
    ("S1_b_0000001.bmp", {"sample_id": "P_9"}, ("P_9", "basic", 1, False)),
    ("0000042.png", {"sample_id": "P1", "camera": "basic"}, ("P1", "basic", 42, False)),
    ("back.png", {"sample_id": "P1", "camera": "basic"}, ("P1", "basic", None, True)),
    ("0000042.png", {"sample_id": "P1"}, None),
    ("notes.txt", {}, None),
])
def test_identity(spark, name, options, want):
    got = identity.parsed(spark.createDataFrame([(f"d/{name}",)], "frame_path string"), Config(), **options)
    rows = [tuple(r) for r in got.select("sample_id", "camera", "frame_index", "is_blank").collect()]
    assert rows == ([want] if want else [])
