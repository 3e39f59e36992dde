"""SQL surface: every feature set as a temporary view."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..config import DEFAULT, FeatureConfig
from ..operators.skew import DEFAULT_POLICY, SkewPolicy
from . import features as G


def _with_uids(df: DataFrame, cfg: FeatureConfig) -> DataFrame:
    return G.uid_features(G.email_scalars(G.card_texts(G.with_card_id(df, cfg), cfg), cfg), cfg)


FEATURE_SETS = {
    "amount": lambda df, cfg, p: G.transaction_amount_features(df, cfg, p),
    "time": lambda df, cfg, p: G.time_features(df, cfg, p),
    "card": lambda df, cfg, p: G.card_features(df, cfg, p),
    "email": lambda df, cfg, p: G.email_features(df, cfg, p),
    "device": lambda df, cfg, p: G.device_features(df, cfg),
    "address": lambda df, cfg, p: G.address_features(df, cfg),
    "v": lambda df, cfg, p: G.v_features(df, cfg),
    "aggregation": lambda df, cfg, p: G.aggregation_features(df, cfg, p),
    "id": lambda df, cfg, p: G.id_features(df, cfg),
    "uid": lambda df, cfg, p: _with_uids(df, cfg),
    "uid_aggregation": lambda df, cfg, p: G.uid_aggregations(_with_uids(df, cfg), cfg, p),
    "frequency": lambda df, cfg, p: G.enhanced_frequency_features(_with_uids(df, cfg), cfg, p),
    "velocity": lambda df, cfg, p: G.uid_velocity(_with_uids(df, cfg), cfg=cfg, policy=p),
    "all": lambda df, cfg, p: G.feature_chain(df, cfg, p),
}


def register_features(
    df: DataFrame, sets=None, prefix: str = "txn_", cfg: FeatureConfig = DEFAULT, policy: SkewPolicy = DEFAULT_POLICY
) -> dict[str, str]:
    """Create `<prefix><set>_features` views; returns set name to view name."""
    created = {}
    for name in sets or FEATURE_SETS:
        view = f"{prefix}{name}_features"
        FEATURE_SETS[name](df, cfg, policy).createOrReplaceTempView(view)
        created[name] = view
    return created
