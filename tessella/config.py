"""Options of the two pipelines, checked when they are made."""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import asdict, dataclass, field

from . import dims


def parse_class_thresholds(text: str) -> dict[int, float]:
    """``"01=0.30;08=0,40"``: classes 0 to 12, shares in (0, 1]; a decimal comma will do."""
    out: dict[int, float] = {}
    for part in filter(None, (x.strip() for x in (text or "").split(";"))):
        m = re.fullmatch(r"(\d{1,2})\s*=\s*([0-9.,]+)", part)
        if not m:
            raise ValueError(f"not class=share: {part!r}")
        cls, share = int(m[1]), float(m[2].replace(",", "."))
        if cls > 12 or not 0 < share <= 1:
            raise ValueError(f"class 0 to 12 and a share in (0, 1] are needed: {part!r}")
        out[cls] = share
    return out


def parse_hydro_symbols(text: str) -> tuple[str, ...]:
    out = tuple(x.strip() for x in text.split(";") if x.strip())
    if not out:
        raise ValueError("one symbol is needed at least")
    return out


def effective_thresholds(other: float = 0.25, water: float | None = None, bare: float | None = None, zero_clutter: float | None = None, per_class: dict[int, float] | None = None) -> dict[int, float]:
    """Shares by class: a class' own, else water's or bare land's, else zero clutter's, else the default."""
    base = {0: water, 12: bare}
    out = {}
    for c in range(13):
        options = [(per_class or {}).get(c)]
        if c in base:
            options += [base[c], zero_clutter, dims.CLASS_THRESHOLDS[c]]
        out[c] = next(x for x in [*options, other] if x is not None)
        if not 0 < out[c] <= 1:
            raise ValueError(f"share of class {c} must be in (0, 1]")
    return out


def fingerprint(config) -> str:
    """A key for prepared tables and checkpoints: other options or inputs give another one."""
    return hashlib.sha256(json.dumps(asdict(config), sort_keys=True, default=str).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class LandCoverConfig:
    tiles: tuple[str, ...] = dims.TILES
    supersample: int = 8
    block_size: int = 512
    other_threshold: float = 0.25
    water_threshold: float | None = None
    bare_threshold: float | None = None
    zero_clutter_threshold: float | None = None
    class_thresholds: dict[int, float] = field(default_factory=dict)
    hydro_symbols: tuple[str, ...] = dims.HYDRO_SYMBOLS
    p70: float | None = dims.FOREST_P70  # None: computed from the stands
    arcsec: float = 1.0
    urban_radius_m: float = 45.0
    urban_arcsec: float = 0.25
    urban_supersample: int = 8
    lo_density: float = 0.0725
    tall_density: float = 0.1375
    tall_height: float = 17.0
    dense_density: float = 0.27
    dense_height: float = 11.0
    kernel_mode: str = "weighted"
    kernel_quadrature: int = 64
    qa: bool = True
    preview: bool = True

    def __post_init__(self):
        checks = {
            "supersample must be 2, 4 or 8": self.supersample in (2, 4, 8),
            "block_size must be 32 at least": self.block_size >= 32,
            "urban_radius_m must be above 0": self.urban_radius_m > 0,
            "kernel_mode must be weighted or binary": self.kernel_mode in ("weighted", "binary"),
            "kernel_quadrature must be 8 at least": self.kernel_quadrature >= 8,
            "urban_arcsec must be above 0": self.urban_arcsec > 0,
            "urban_supersample must be 1 at least": self.urban_supersample >= 1,
            "densities must be in [0, 1]": all(0 <= x <= 1 for x in (self.lo_density, self.tall_density, self.dense_density)),
            "heights must not be negative": min(self.tall_height, self.dense_height) >= 0,
            "p70 must be above 0": self.p70 is None or self.p70 > 0,
            "a tile is needed": bool(self.tiles),
        }
        if bad := [k for k, ok in checks.items() if not ok]:
            raise ValueError("; ".join(bad))
        sample_factor(self.arcsec, self.urban_arcsec)
        self.thresholds  # noqa: B018

    @property
    def thresholds(self) -> dict[int, float]:
        return effective_thresholds(self.other_threshold, self.water_threshold, self.bare_threshold, self.zero_clutter_threshold, self.class_thresholds)


def sample_factor(target_arcsec: float, analysis_arcsec: float) -> int:
    """How many analysis cells a target cell has along a side; it must be whole."""
    factor = round(target_arcsec / analysis_arcsec)
    if factor < 1 or abs(factor * analysis_arcsec - target_arcsec) > 1e-9:
        raise ValueError("the target resolution must be a whole multiple of the analysis resolution")
    return factor


def pixels_per_degree(arcsec: float, exact: bool = False) -> int:
    """Cells along a degree, rounded half to even; ``exact`` refuses a rounding."""
    if arcsec <= 0:
        raise ValueError("arcsec must be above 0")
    n = round(3600 / arcsec)
    if n < 1 or exact and abs(n * arcsec - 3600) > 1e-6:
        raise ValueError(f"{arcsec} arc seconds don't divide a degree")
    return n


@dataclass(frozen=True)
class ElevationConfig:
    tiles: tuple[str, ...] = ("N45E014",)
    stage: str = "all"
    arcsec: float = 1 / 9
    exact_arcsec: bool = False
    allow_finer: bool = False
    resolution_label: str | None = None
    interpolation: str = "bilinear"
    service_url: str = ""
    chunk_cols: int = 12
    chunk_rows: int = 12
    timeout_s: float = 900
    retries: int = 5
    stripe_rows: int = 256
    compare_samples: int = 50_000
    split_grid: int = 4
    split_samples: int = 4096
    overwrite: bool = False

    def __post_init__(self):
        checks = {
            "stage must be build, qa, compare, split, split-qa or all": self.stage in ("build", "qa", "compare", "split", "split-qa", "all"),
            "interpolation must be bilinear, nearest, cubic or majority": self.interpolation in ("bilinear", "nearest", "cubic", "majority"),
            "chunk_cols, chunk_rows, retries, stripe_rows and split_grid must be 1 at least": min(self.chunk_cols, self.chunk_rows, self.retries, self.stripe_rows, self.split_grid) >= 1,
            "timeout_s must be above 0": self.timeout_s > 0,
            "samples must be 1 at least": min(self.compare_samples, self.split_samples) >= 1,
            "resolutions finer than 1/9 arc second need allow_finer": self.allow_finer or self.arcsec >= 1 / 9 - 1e-12,
            "a tile is needed": bool(self.tiles),
        }
        if bad := [k for k, ok in checks.items() if not ok]:
            raise ValueError("; ".join(bad))
        pixels_per_degree(self.arcsec, self.exact_arcsec)

    @property
    def pixels(self) -> int:
        return pixels_per_degree(self.arcsec)

    @property
    def label(self) -> str:
        return self.resolution_label or resolution_label(3600 / self.pixels)


def resolution_label(arcsec: float) -> str:
    inverse = 1 / arcsec
    if abs(inverse - round(inverse)) < 1e-10:
        return f"1over{round(inverse)}"
    return f"{arcsec:g}arcsec".replace(".", "p")


def split_name(label: str, n: int) -> str:
    return f"{label}_SPLIT_{n}x{n}"
