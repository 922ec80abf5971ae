"""Options of the engine: fixed values of the data model and tunable parameters."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# They decide results and must stay exactly as they are.
# ---------------------------------------------------------------------------
CURRENCY_RATES_TO_GBP = {"$": 0.75, "€": 0.87, "£": 1.0, "unknown": 1.0}
LOCATIONS = ["London", "Glasgow", "Birmingham", "Liverpool", "Cardiff", "Leeds", "Manchester"]
DEVICES = ["iPhone 13", "Samsung Galaxy S10", "Pixel 6", "Nokia 3310", "Xiaomi Mi 11", "Huawei P30"]
TRANSACTION_TYPES = [
    "withdrawal", "deposit", "cashout", "purchase", "transfer", "top-up", "debit", "refund",
]
DEVICE_BRANDS = {
    "iPhone 13": "iPhone",
    "Samsung Galaxy S10": "Samsung",
    "Pixel 6": "Pixel",
    "Nokia 3310": "Nokia",
    "Xiaomi Mi 11": "Xiaomi",
    "Huawei P30": "Huawei",
    "None": "unknown",
}
TRANSACTION_GROUPS = {
    "cash": ["withdrawal", "cashout", "debit"],
    "digital": ["transfer", "top-up", "purchase"],
    "account": ["deposit", "refund"],
}
REGION_CURRENCIES = {
    "GBP": ["london", "glasgow", "birmingham", "liverpool", "cardiff", "leeds", "manchester"],
    "USD": ["new york", "los angeles", "chicago", "houston", "phoenix", "philadelphia"],
    "EUR": ["paris", "berlin", "madrid", "rome", "amsterdam", "brussels"],
}
AMOUNT_PATTERN = r"([£$€]?)(\d+\.?\d*)"
MALFORMED_MARKER = "MALFORMED_LOG"
UNUSUAL_AMOUNT = 1_000_000
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class ScaleLimits:
    """Sizes that switch an operator to its distributed way of working.

    ``broadcast_rows``: a lookup table is broadcast only when it is measured to
    hold at most this many rows. ``quantile_values``: exact quantiles aggregate
    in one task only up to this many distinct values. ``rows_per_task``: a key
    holding more rows than this (and more than its fair share) is split.
    ``most_rows``: a key holding more rows than this is split however large the
    table and its fair share are.
    """

    broadcast_rows: int = 500_000
    quantile_values: int = 1_000_000
    rows_per_task: int = 2_000_000
    most_rows: int = 20_000_000


@dataclass(frozen=True)
class EnsembleWeights:
    rule_weight: float = 0.3
    isolation_weight: float = 0.25
    autoencoder_weight: float = 0.25
    clustering_weight: float = 0.2

    NAMES = ("rule_weight", "isolation_weight", "autoencoder_weight", "clustering_weight")

    @classmethod
    def normalised(cls, weights: dict[str, float]) -> "EnsembleWeights":
        """Check that every weight is present and scale them to sum to one."""
        missing = [n for n in cls.NAMES if n not in weights]
        if missing:
            raise ValueError(f"missing weights: {', '.join(missing)}")
        total = sum(weights.values())
        if total <= 0:
            raise ValueError("the weights must have a positive sum")
        return cls(**{n: weights[n] / total for n in cls.NAMES})


@dataclass(frozen=True)
class HashParams:
    """Approximate neighbour search: ``trees`` and ``probes`` buy recall; ``leaf_rows`` bounds a bucket; ``sample_rows`` bounds what fits the planes; ``leaf_rows`` doubles until a measured ``recall`` is reached (0: it stays)."""

    trees: int = 10
    probes: int = 2
    leaf_rows: int = 512
    sample_rows: int = 20_000
    seed: int = 42
    recall: float = 0.0


@dataclass(frozen=True)
class Options:
    velocity_window_hours: int = 24
    location_risk_threshold: float = 0.1
    random_seed: int = 42
    trees: int = 100
    subsample: int = 256
    dbscan_eps: float = 0.5
    dbscan_min_samples: int = 5
    lof_neighbours: int = 20
    oneclass_nu: float = 0.1
    #: Neighbours of LOF and DBSCAN: exact without, in hashed buckets with these.
    hashing: HashParams | None = None
    anomaly_threshold: float = 0.7
    top_n: int = 100
    validation_sample: int = 50
    ensemble: EnsembleWeights = field(default_factory=EnsembleWeights)
    limits: ScaleLimits = field(default_factory=ScaleLimits)

    def with_(self, **changes) -> "Options":
        return replace(self, **changes)


DEFAULTS = Options()
