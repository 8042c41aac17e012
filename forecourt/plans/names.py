"""Table names of one pipeline."""

from dataclasses import dataclass


@dataclass(frozen=True)
class Tables:
    """Every table of the pipeline, in one schema of the catalog."""

    database: str = "default"

    def __getattr__(self, short):
        if short not in _TABLES:
            raise AttributeError(short)
        return f"{self.database}.{_TABLES[short]}"


# Table names.
_TABLES = {
    "listings": "raw_listings",
    "quarantine": "raw_listings_quarantine",
    "index": "market_price_features",
    "latest_index": "market_price_features_online",
    "changes": "raw_listings_changes",
    "predictions": "predictions",
    "baseline": "drift_baseline",
    "performance": "model_performance_history",
    "drift": "feature_drift_history",
}
