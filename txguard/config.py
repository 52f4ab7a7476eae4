"""Settings of a scoring run. Endpoints and secrets always come from the caller."""

from dataclasses import dataclass

from txguard import constants as C


@dataclass(frozen=True)
class FraudConfig:
    distance_km: float = C.RULE_DISTANCE_KM
    amount: float = C.RULE_AMOUNT
    use_classifier: bool = True
    use_clusters: bool = True
    alerts: bool = True
    cluster_score: str = "distance"  # or "label": constant per cluster id
    classifier_score: str = "fraud"  # or "confidence": probability of the predicted class
    trigger: str = C.TRIGGER
    heavy_rows: int = C.HEAVY_ROWS
    broadcast_rows: int = C.BROADCAST_ROWS
