"""Run configuration: strict sections, defaults, overlays by deep merge, a hash for every row."""

from __future__ import annotations

import hashlib
import json
from pathlib import Path
from typing import Literal

import yaml
from pydantic import BaseModel, ConfigDict, Field, field_validator

#: Quality flags in the order in which they are listed everywhere.
FLAGS = ("flag_defocus", "flag_border", "flag_too_small", "flag_sliver", "flag_possible_agglomerate", "flag_no_polygon")


class Section(BaseModel):
    model_config = ConfigDict(extra="forbid")


class Calibration(Section):
    um_per_px: dict[str, float | None] = Field(default_factory=lambda: {"basic": None, "zoom": None})

    def known(self) -> dict[str, float]:
        """Scales of the cameras that are calibrated."""
        return {camera: scale for camera, scale in self.um_per_px.items() if scale is not None}


class Filename(Section):
    sample_regex: str = r"(?P<sample>.+?)_(?P<cam>[bz])_(?:(?P<frame>\d+)|back)$"
    camera_map: dict[str, str] = Field(default_factory=lambda: {"b": "basic", "z": "zoom"})
    blank_regex: str = r"(?i)(?:^|[_-])back$"


class Flatfield(Section):
    method: Literal["auto", "blank", "morphological"] = "auto"
    morph_kernel_px: int = 201


class Threshold(Section):
    method: Literal["half_max", "otsu"] = "half_max"
    half_max_fraction: float = 0.5
    core_percentile: float = 5
    min_object_depth: float = 0.40


class Detect(Section):
    min_area_px: int = 25
    fill_holes: bool = True


class Measure(Section):
    efd_order: int = 15
    efd_resample_n: int = 256
    wadell_smoothing: float = 1.0
    curvature_resample_n: int = 256
    curvature_smoothing: float = 2.0
    curvature_bins: int = 32


class Qc(Section):
    min_ecd_px: float = 10
    defocus_edge_width_px: float = 5.25
    defocus_contrast_min: float = 0.70
    sliver_aspect_ratio: float = 3.0
    sliver_max_ecd_px: float = 40
    agglomerate_solidity_max: float = 0.90
    disqualifying_flags: list[str] = Field(default_factory=lambda: [f for f in FLAGS if f != "flag_possible_agglomerate"])

    @field_validator("disqualifying_flags")
    @classmethod
    def _flags(cls, names: list[str]) -> list[str]:
        """Flag columns are named flag_...; which of them a table has is seen when it is gated."""
        if bad := [n for n in names if not n.startswith("flag_")]:
            raise ValueError(f"not names of flag columns: {bad}; known ones are {list(FLAGS)}")
        return names


class Output(Section):
    format: Literal["parquet", "csv", "feather"] = "csv"
    save_contours: bool = True
    partition: bool = True


class Runtime(Section):
    n_jobs: int = -1


class LabelClass(Section):
    key: str
    value: int
    name: str


class Groundtruth(Section):
    classes: list[LabelClass] = Field(default_factory=lambda: [LabelClass(key=str(v), value=v, name=n) for v, n in enumerate(("exclude", "include", "special"))])
    lhs_axes: list[str] = Field(default_factory=lambda: ["ecd_px", "edge_width_px", "contrast", "qc_aspect_ratio", "qc_solidity"])
    reserved: dict[str, int] = Field(default_factory=lambda: {"border": 2, "no_polygon": 1})
    crop_pad_px: int = 24
    mask_alpha: float = 0.35
    show_predicted_status: bool = False


class Config(Section):
    calibration: Calibration = Field(default_factory=Calibration)
    filename: Filename = Field(default_factory=Filename)
    flatfield: Flatfield = Field(default_factory=Flatfield)
    threshold: Threshold = Field(default_factory=Threshold)
    detect: Detect = Field(default_factory=Detect)
    measure: Measure = Field(default_factory=Measure)
    qc: Qc = Field(default_factory=Qc)
    output: Output = Field(default_factory=Output)
    runtime: Runtime = Field(default_factory=Runtime)
    groundtruth: Groundtruth = Field(default_factory=Groundtruth)

    def um_per_px(self, camera: str) -> float:
        """The camera's scale; one that isn't calibrated is an error."""
        try:
            return self.calibration.known()[camera]
        except KeyError:
            raise KeyError(f"no calibration for camera {camera!r}: set calibration.um_per_px") from None


def layered(*layers: dict) -> dict:
    """One mapping of several: for each key the last layer that has it counts, mappings above each other being layered in turn."""
    out = {}
    for key in dict.fromkeys(k for layer in layers for k in layer):
        values = [layer[key] for layer in layers if key in layer]
        plain = [k for k, v in enumerate(values) if not isinstance(v, dict)]
        maps = values[plain[-1] + 1 :] if plain else values
        out[key] = layered(*maps) if maps else values[-1]
    return out


def load_config(path: str | Path | None = None, overlay: dict | None = None) -> Config:
    """The defaults, a YAML file over them if there is one, and an overlay over both."""
    told = yaml.safe_load(Path(path).read_text()) if path is not None else None
    return Config.model_validate(layered(Config().model_dump(), told or {}, overlay or {}))


def config_hash(cfg: Config) -> str:
    """Twelve hexadecimal digits that name a configuration."""
    whole = json.dumps(cfg.model_dump(mode="json"), sort_keys=True).encode()
    return hashlib.sha256(whole).hexdigest()[:12]
