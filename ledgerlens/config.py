"""Parameters of the feature set.

One frozen object is handed to every operator, so a job can change bins, column
groups or maps without touching code.
"""

from __future__ import annotations

from dataclasses import dataclass, field


def _columns(prefix: str, first: int, last: int) -> tuple[str, ...]:
    return tuple(f"{prefix}{i}" for i in range(first, last + 1))


# They decide output columns and codes, so they are stated as they are.
AMOUNT_EDGES = (0, 50, 100, 200, 500, 1000, 5000, 10_000)
TIME_OF_DAY_EDGES = (-1, 6, 12, 18, 24)
CARD_COLUMNS = ("card1", "card2", "card3", "card4", "card5", "card6")
EMAIL_COLUMNS = ("P_emaildomain", "R_emaildomain")
FREQUENCY_COLUMNS = (
    "card1", "card2", "card3", "card4", "card5", "card6",
    "addr1", "addr2", "P_emaildomain", "R_emaildomain",
    "ProductCD", "DeviceType", "DeviceInfo",
)
AMOUNT_STAT_COLUMNS = ("card1", "card2", "addr1")
UID_COLUMNS = ("uid1", "uid2", "uid3", "uid4")
NORMALISED_FREQUENCY_COLUMNS = (
    "uid1", "uid2", "uid3", "uid4", "card1", "card2", "addr1",
    "P_emaildomain", "DeviceType", "DeviceInfo",
)
EMAIL_VENDORS = {
    "gmail": "google", "yahoo": "yahoo", "hotmail": "microsoft", "outlook": "microsoft",
    "live": "microsoft", "msn": "microsoft", "icloud": "apple", "aol": "aol",
}
TWO_PART_SUFFIXES = ("co.uk", "gov.uk", "ac.uk", "co.jp", "com.au", "net.au")
# First and last V column of each correlated block; V138 and later only count in the totals.
V_BLOCKS = {
    "v1": (1, 11), "v2": (12, 26), "v3": (27, 34), "v4": (35, 52),
    "v5": (53, 74), "v6": (75, 94), "v7": (95, 137),
}
NUMERIC_ID_COLUMNS = tuple(f"id_{i:02d}" for i in range(1, 12))
ID_FLAGS = {
    "id_12_isFound": ("id_12", "Found"),
    "id_15_isNew": ("id_15", "New"),
    "id_15_isFound": ("id_15", "Found"),
    "id_16_isFound": ("id_16", "Found"),
    "id_28_isNew": ("id_28", "New"),
    "id_28_isFound": ("id_28", "Found"),
    "id_29_isFound": ("id_29", "Found"),
    "id_36_isT": ("id_36", "T"),
    "id_37_isT": ("id_37", "T"),
    "id_38_isT": ("id_38", "T"),
}
NULL_TOKENS = ("", "null", "nan")
LATENCY_BUCKETS = (0.1, 0.25, 0.5, 1.0, 2.0, 5.0, 10.0)
BATCH_SIZE_BUCKETS = (1, 5, 10, 25, 50, 100, 250, 500, 1000)


@dataclass(frozen=True)
class FeatureConfig:
    id_col: str = "TransactionID"
    time_col: str = "TransactionDT"
    amount_col: str = "TransactionAmt"
    target_col: str = "isFraud"
    amount_edges: tuple = AMOUNT_EDGES
    time_of_day_edges: tuple = TIME_OF_DAY_EDGES
    card_cols: tuple = CARD_COLUMNS
    email_cols: tuple = EMAIL_COLUMNS
    frequency_cols: tuple = FREQUENCY_COLUMNS
    amount_stat_cols: tuple = AMOUNT_STAT_COLUMNS
    uid_cols: tuple = UID_COLUMNS
    normalised_frequency_cols: tuple = NORMALISED_FREQUENCY_COLUMNS
    email_vendors: dict = field(default_factory=lambda: dict(EMAIL_VENDORS))
    two_part_suffixes: tuple = TWO_PART_SUFFIXES
    v_blocks: dict = field(
        default_factory=lambda: {k: _columns("V", *span) for k, span in V_BLOCKS.items()}
    )
    numeric_id_cols: tuple = NUMERIC_ID_COLUMNS
    id_flags: dict = field(default_factory=lambda: dict(ID_FLAGS))
    micro_amount: float = 10.0
    spike_ratio: float = 5.0
    rolling_rows: int = 5
    velocity_seconds: int = 3600
    first_gap: int = 999_999
    folds: int = 5
    fill_value: float = -999.0
    unknown_code: float = -1.0
    pca_variance: float = 0.96
    test_size: float = 0.2
    seed: int = 6
    positive_weight: float = 27.0


DEFAULT = FeatureConfig()
