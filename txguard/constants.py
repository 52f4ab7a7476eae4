"""Values that decide results. Everything else is a parameter."""

# --- Fixed values: must not change, results depend on them -----------------------------------

EARTH_RADIUS_KM = 6371.0

# Relative rule and final status
RULE_DISTANCE_KM = 1500
RULE_AMOUNT = 500
LAST_N = 10

# Tier rule: (label, distance over, amount over), first match wins
TIERS = (
    ("HIGH_RISK", 1500, 1000),
    ("MEDIUM_RISK", 1000, 500),
)
TIER_OTHERWISE = "LOW_RISK"

# Risk level: (label, score at least), first match wins
RISK_LEVELS = (
    ("HIGH_RISK", 0.8),
    ("MEDIUM_RISK", 0.6),
    ("LOW_RISK", 0.4),
)
RISK_OTHERWISE = "NO_RISK"
RISK_UNKNOWN = "UNKNOWN"
ALERT_LEVELS = ("HIGH_RISK", "MEDIUM_RISK")

# Final status
FINAL_ML_SCORE = 0.7
FINAL_ANOMALY_SCORE = 0.8
SCORE_WITHOUT_MODEL = 0.5

# Amount and time features
HIGH_VALUE = 1000
LOW_VALUE = 10
UNUSUAL_DEVIATION = 2
WEEKEND_DAYS = (1, 7)
BUSINESS_HOURS = (9, 17)

# Models
CLASSIFIER_FEATURES = (
    "amount_log",
    "distance",
    "hour",
    "day_of_week",
    "is_weekend",
    "is_business_hours",
    "amount_deviation",
)
CLASSIFIER_TREES = 100
CLASSIFIER_DEPTH = 10
CLUSTER_FEATURES = ("amount_log", "distance", "hour")
CLUSTERS = 3
CLUSTER_ITERATIONS = 20
CLUSTER_SCORES = (0.1, 0.5, 0.9)
SEED = 42

# Stream
TRIGGER = "5 seconds"
MAX_OFFSETS_PER_TRIGGER = 10000

# Output tables
CUSTOMER_COLUMNS = (
    "ssn", "cc_num", "first", "last", "gender", "city", "state", "dob", "acct_num",
)
DROPPED_PII = ("first", "last", "job", "profile")
SCORED_PARTITIONS = ("year", "month", "final_fraud_status")

# Monitoring limits
SPIKE_INCREASE = 0.10
ERROR_RATE_LIMIT = 0.05

# --- Scale settings: never change a result -----------------------------------------------------

# A key with at least this many rows is treated apart. A frame of N rows has at most
# N / HEAVY_ROWS such keys, which is what bounds the broadcast of the heavy-key list
# (5e11 rows, i.e. about 100 TB, give at most 250,000 keys).
HEAVY_ROWS = 2_000_000
ROWS_PER_SLICE = 500_000

# A dimension is broadcast by hint only after it was counted and has at most this many rows.
BROADCAST_ROWS = 1_000_000

# Rows of a training table that MLlib reads as one partition: it keeps about a kilobyte for each while it fits a forest.
ROWS_PER_TRAINING_PARTITION = 100_000
