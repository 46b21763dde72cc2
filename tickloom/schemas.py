"""Column lists and Spark schemas of ticks, features, predictions, request logs and offsets."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# The raw ticker message: prices arrive as strings.
RAW_TICK = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("price", T.StringType()),
    T.StructField("time", T.StringType()),
    T.StructField("best_bid", T.StringType()),
    T.StructField("best_ask", T.StringType()),
    T.StructField("volume_24h", T.StringType()),
    T.StructField("ingestion_timestamp", T.StringType()),
    T.StructField("replay", T.BooleanType()),
    T.StructField("replay_index", T.LongType()),
])

# The 13 model features in their published order.
FEATURES = [
    "price", "bid", "ask",
    "return_10s", "return_30s", "return_60s",
    "volatility_30s", "volatility_60s", "volatility_120s",
    "spread",
    "intensity_30s", "intensity_60s", "intensity_120s",
]
LABEL = "volatility_spike"

FEATURE_ROW = T.StructType(
    [T.StructField("symbol", T.StringType()), T.StructField("seq", T.LongType()),
     T.StructField("ts", T.TimestampType())]
    + [T.StructField(c, T.DoubleType()) for c in FEATURES]
)

RUN_LOG = T.StructType([
    T.StructField("run_name", T.StringType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
])


@dataclass(frozen=True)
class FeatureWindows:
    """Window lengths in seconds by output column, and the size of the tick buffer they look into (None: no limit)."""

    returns: dict[str, int] = field(
        default_factory=lambda: {"return_10s": 10, "return_30s": 30, "return_60s": 60}
    )
    volatility: dict[str, int] = field(
        default_factory=lambda: {"volatility_30s": 30, "volatility_60s": 60, "volatility_120s": 120}
    )
    intensity: dict[str, int] = field(
        default_factory=lambda: {"intensity_30s": 30, "intensity_60s": 60, "intensity_120s": 120}
    )
    buffer_size: int | None = 500

    def scaled(self, factor: int, buffer_size: int | None = None) -> FeatureWindows:
        """The same columns over windows ``factor`` times as long, for sparse data."""
        return FeatureWindows(
            {k: v * factor for k, v in self.returns.items()},
            {k: v * factor for k, v in self.volatility.items()},
            {k: v * factor for k, v in self.intensity.items()},
            buffer_size or self.buffer_size,
        )
