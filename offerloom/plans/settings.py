"""Parameters of the registered queries."""

# A run between the first and the last offer, and two runs of a snapshot table.
RUN_TS = "2000-01-01 00:00:00"
SNAPSHOT_RUNS = ("2000-01-01 00:00:00", "2000-07-01 00:00:00")
# Days of the drift windows; the first is the baseline.
DRIFT_RUNS = ("1999-01-01 00:00:00", "2000-01-01 00:00:00", "2000-07-01 00:00:00", "2001-01-01 00:00:00")
DRIFT_COLUMNS = (
    "p_accept",
    "redemptions_total",
    "redemptions_90d",
    "points_accumulated",
    "points_expiring_30d",
    "points_expired",
    "days_since_redemption",
    "days_since_credit",
    "missions_30d",
)
# What-if: thresholds moved up, one segment's budget raised.
SCENARIO_SHIFT = 0.05
SCENARIO_OVERRIDE = {"at_risk": 60000}
# Value of an acceptance per offer type.
OFFER_VALUES = {"cashback": 400.0, "bonus": 350.0, "discount": 200.0, "mission": 120.0}
# Versions of tables that are compared or merged.
EARLIER = "2001-05-01 00:00:00"
CATALOG_CUT = "1999-01-01 00:00:00"
UNKNOWN_SHIFT = 1_000_000_000
SPEND_LIMIT = 2000
AUDIT_USER = "operator"
AUDIT_ACTION = "publish_members"
RECENT = 3
# Versions that a training run registers: a small one to begin with, and the full size.
MODEL_SETTINGS = ({"rounds": 20, "depth": 4}, {})
