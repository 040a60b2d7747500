"""Pipeline specification: which columns play which role.

Every operator takes column names as parameters; ``PipelineSpec`` bundles
them so one run (ingest -> clean -> features -> stats -> train -> evaluate)
is described by a single value. ``ACCIDENTS`` is the layout of the incident
table the engine was first built for.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the incident layout's published column names,
# thresholds and hyper-parameters for identical results).
# ---------------------------------------------------------------------------
ACCIDENT_COLUMNS = (
    "Severity", "Start_Time", "Start_Lat", "Start_Lng",
    "Distance(mi)", "Temperature(F)", "Humidity(%)",
    "Pressure(in)", "Visibility(mi)", "Wind_Speed(mph)",
    "Weather_Condition", "Sunrise_Sunset",
)
ACCIDENT_MEASURES = (
    "Start_Lat", "Start_Lng", "Distance(mi)", "Temperature(F)",
    "Humidity(%)", "Pressure(in)", "Visibility(mi)", "Wind_Speed(mph)",
)
ACCIDENT_CATEGORIES = ("Weather_Condition", "Sunrise_Sunset")
ACCIDENT_FEATURES = ACCIDENT_MEASURES + ("Hour", "Month", "Weekday")
ACCIDENT_HISTOGRAM_FEATURES = (
    "Distance(mi)", "Temperature(F)", "Humidity(%)", "Visibility(mi)", "Wind_Speed(mph)",
)
ACCIDENT_DESCRIBE_COLUMNS = ("Severity", "Temperature(F)", "Visibility(mi)", "Distance(mi)")
STATS_EXCLUDED = ("ID", "Severity", "label")
SEVERE_THRESHOLD = 3
CLASS_THRESHOLD = 0.5
TRAIN_FRACTION = 0.8
SPLIT_SEED = 42
LR_MAX_ITER = 50
LR_REG_PARAM = 0.01
LR_ELASTIC_NET = 0.0
HISTOGRAM_BINS = 30
QUANTILE_RELATIVE_ERROR = 0.01
CLASS_CAPTIONS = ("minor (severity 1-2)", "severe (severity 3-4)")
# Category map of the single-record form scorer (unknown values read 0.0).
FORM_CATEGORY_MAP = {
    "Weather_Condition": {"Clear": 0, "Cloudy": 1, "Rain": 2, "Snow": 3, "Fog": 4, "Thunderstorm": 5},
    "Sunrise_Sunset": {"Day": 0, "Night": 1},
}


def accident_schema() -> T.StructType:
    """Explicit schema for the raw incident CSV (no inference pass)."""
    fields = [T.StructField("Severity", T.IntegerType()),
              T.StructField("Start_Time", T.StringType())]
    fields += [T.StructField(c, T.DoubleType()) for c in ACCIDENT_MEASURES]
    fields += [T.StructField(c, T.StringType()) for c in ACCIDENT_CATEGORIES]
    return T.StructType(fields)


@dataclass(frozen=True)
class PipelineSpec:
    """Column roles and parameters for one end-to-end run."""

    target: str = "Severity"
    severe_threshold: int = SEVERE_THRESHOLD
    label: str = "label"
    time_col: str | None = "Start_Time"
    keep_columns: tuple[str, ...] = ACCIDENT_COLUMNS
    measures: tuple[str, ...] = ACCIDENT_MEASURES
    categories: tuple[str, ...] = ACCIDENT_CATEGORIES
    features: tuple[str, ...] = ACCIDENT_FEATURES
    histogram_features: tuple[str, ...] = ACCIDENT_HISTOGRAM_FEATURES
    boxplot_feature: str | None = "Distance(mi)"
    describe_columns: tuple[str, ...] = ACCIDENT_DESCRIBE_COLUMNS
    split_key: tuple[str, ...] | None = None   # None: hash of all kept columns
    train_fraction: float = TRAIN_FRACTION
    seed: int = SPLIT_SEED
    max_iter: int = LR_MAX_ITER
    reg_param: float = LR_REG_PARAM
    elastic_net: float = LR_ELASTIC_NET
    class_threshold: float = CLASS_THRESHOLD
    bins: int = HISTOGRAM_BINS
    # quartiles of the descriptive report: "approx" (sketch, relative error
    # 0.01, one scan - as the original report) or "exact" (two scans)
    quantiles: str = "approx"
    extra: dict = field(default_factory=dict)

    def with_(self, **kw) -> "PipelineSpec":
        return replace(self, **kw)


ACCIDENTS = PipelineSpec()
