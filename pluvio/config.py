"""Job parameters. The defaults are fixed values of the product being matched."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timedelta

# Names of the trailing windows a job may ask for.
TRAILING_WINDOWS = {
    "1h": timedelta(hours=1),
    "3h": timedelta(hours=3),
    "4h": timedelta(hours=4),
    "6h": timedelta(hours=6),
    "12h": timedelta(hours=12),
    "1d": timedelta(days=1),
    "2d": timedelta(days=2),
    "7d": timedelta(days=7),
    "14d": timedelta(days=14),
    "30d": timedelta(days=30),
}

# Rows a sliding classifier needs before its first usable prediction.
CLASSIFIER_WARMUP = 327


@dataclass(frozen=True)
class FieldNames:
    """Telemetry field names; the first name of a pair wins over the second."""

    # Fixed values.
    rx: tuple[str, str] = ("PrijimanaUroven", "Signal")
    tx: tuple[str, str] = ("VysilaciVykon", "Vysilany_Vykon")
    temperature: str = "Teplota"


@dataclass(frozen=True)
class TimeAxis:
    step: int = 10  # minutes
    output_step: int = 10
    start: datetime | None = None
    end: datetime | None = None


@dataclass(frozen=True)
class Links:
    min_length: float = 0.5  # km
    max_length: float = 100.0
    exclude: bool = True


@dataclass(frozen=True)
class WetDry:
    method: str = "rolling"  # rolling | given (a `wet` column is already there)
    rolling_values: int = 10
    deviation: float = 0.8
    centered: bool = False
    baseline_samples: int = 5
    ignore_dry_links: bool = False
    classifier: bool = False
    # Rows of a channel that one task walks; None walks a channel in one task, in pieces that begin where it is dry.
    block_rows: int | None = None


@dataclass(frozen=True)
class WetAntenna:
    method: str = "pastorek"  # pastorek | leijnse | schleiss | none
    schleiss_max: float = 2.2
    schleiss_tau: float = 15.0  # minutes
    # The product being matched passes the step in hours next to tau in minutes; set True to do so too.
    schleiss_step_in_hours: bool = False
    pastorek_max: float = 2.2
    pastorek_zeta: float = 0.55
    pastorek_d: float = 0.1


@dataclass(frozen=True)
class Temperature:
    filtered: bool = False
    compensated: bool = False
    threshold: float = 0.7
    reference: float = 21.0

    @property
    def needed(self) -> bool:
        return self.filtered or self.compensated


@dataclass(frozen=True)
class Interp:
    mercator: bool = True
    nx: int | None = 598
    ny: int | None = 378
    step_m: float = 1000.0
    res_deg: float = 0.025
    power: float = 2.0
    near: int = 12
    dist_m: float = 20000.0
    dist_deg: float = 0.4
    dry_as_missing: bool = False
    tile: int = 32  # cells per tile edge

    @property
    def max_distance(self) -> float:
        return self.dist_m if self.mercator else self.dist_deg


@dataclass(frozen=True)
class Limits:
    x_min: float = 11.267
    x_max: float = 19.624
    y_min: float = 48.047
    y_max: float = 51.458


@dataclass(frozen=True)
class Score:
    min_rain: float = 0.1
    method: str = "coverage"  # mean | p90 | p95 | coverage | coverage_strength
    reference: float = 20.0
    threshold: float = 0.0
    min_if_any: float = 0.001
    coverage_gamma: float = 0.3
    strength_gamma: float = 1.0


@dataclass(frozen=True)
class HourSum:
    enabled: bool = False
    window_minutes: int = 60
    write_series: bool = False


@dataclass(frozen=True)
class Output:
    frames: bool = True
    flags: bool = True
    intensities: bool = False
    crop: bool = True


@dataclass(frozen=True)
class Settings:
    time: TimeAxis = field(default_factory=TimeAxis)
    fields: FieldNames = field(default_factory=FieldNames)
    links: Links = field(default_factory=Links)
    wet_dry: WetDry = field(default_factory=WetDry)
    waa: WetAntenna = field(default_factory=WetAntenna)
    temperature: Temperature = field(default_factory=Temperature)
    interp: Interp = field(default_factory=Interp)
    limits: Limits = field(default_factory=Limits)
    score: Score = field(default_factory=Score)
    hour_sum: HourSum = field(default_factory=HourSum)
    output: Output = field(default_factory=Output)
    warm_up: bool = True
    # Rows scanned on either side of the range beyond the warm-up. Gap filling and held baselines may look further than the
    # warm-up; with a margin as long as their longest reach, a range has the values of the whole history.
    margin: int = 0

    def warmup_rows(self) -> int:
        """Rows before the requested start that rolling operators look back on."""
        if not self.warm_up:
            return 0
        rows = max(self.wet_dry.rolling_values, self.wet_dry.baseline_samples)
        if self.wet_dry.classifier:
            rows = max(rows, CLASSIFIER_WARMUP)
        if self.hour_sum.enabled:
            rows = max(rows, round(self.hour_sum.window_minutes / self.time.output_step) - 1)
        return rows

    def scan_range(self) -> tuple[datetime, datetime]:
        """[start, end) of the telemetry scan: warm-up and margin added, both ends floored to the step."""
        start = self.time.start - timedelta(minutes=(self.warmup_rows() + self.margin) * self.time.step)
        end = self.time.end + timedelta(minutes=self.margin * self.time.step)
        return floor_step(start, self.time.step), floor_step(end, self.time.step)


def floor_step(moment: datetime, step: int) -> datetime:
    """Floor within the hour, as the telemetry scan of the matched product does."""
    return moment - timedelta(
        minutes=moment.minute % step, seconds=moment.second, microseconds=moment.microsecond
    )


def trailing_range(now: datetime, window: str, step: int) -> tuple[datetime, datetime]:
    return floor_step(now - TRAILING_WINDOWS[window], step), floor_step(now, step)
