"""Text shaping of result tables (P18-P21): report labels and number formats.

Built-in string functions only (``replace``, ``format_number``,
``format_string``), so the formatting runs inside the JVM next to the data
instead of in a driver-side pandas step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Report label replacements in application order, the context
# features, and the one-hot name prefixes (they must equal the reference's).
LABEL_REPLACEMENTS = [
    ("ACTION_GROUP_ohe_", "Action: "),
    ("BASIC_ZONE_ohe_", "Zone: "),
    ("ZONE_RANGE_ohe_", "Range: "),
    ("SHOT_TYPE_ohe_", "Type: "),
    ("IS_CLUTCH", "Clutch Situation (Q4/OT, ≤120 s)"),
    ("SHOT_DISTANCE", "Shot Distance (ft)"),
    ("QUARTER", "Quarter"),
    ("SECS_REMAINING", "Seconds Remaining"),
    ("LOC_Y", "Court Y Coordinate"),
    ("LOC_X", "Court X Coordinate"),
    ("SHOT_VALUE", "Shot Value (2 or 3)"),
    ("IS_3PT", "Is Three-Point Attempt"),
]
CONTEXT_FEATURES = ["QUARTER", "IS_CLUTCH", "SECS_REMAINING"]
ACTION_PREFIX = "ACTION_GROUP_ohe_"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def replace_all(c, replacements=LABEL_REPLACEMENTS) -> Column:
    """Ordered literal replacements (each applies to the previous result)."""
    out = _c(c)
    for old, new in replacements:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def feature_category(c, action_prefix: str = ACTION_PREFIX,
                     context=CONTEXT_FEATURES) -> Column:
    """Action for action one-hot slots, Context for clock features, else Location."""
    return (F.when(_c(c).startswith(action_prefix), "Action")
             .when(_c(c).isin(list(context)), "Context")
             .otherwise("Location"))


def thousands(c) -> Column:
    """P20: integer with thousands separators (1,344,005)."""
    return F.format_number(_c(c), 0)


def percent_text(c, digits: int = 1) -> Column:
    """P20: ``61.6%``."""
    return F.format_string(f"%.{digits}f%%", _c(c))


def fixed(c, digits: int = 3) -> Column:
    """P20: fixed decimals."""
    return F.format_string(f"%.{digits}f", _c(c))


def signed(c, digits: int = 1) -> Column:
    """``+27.7`` / ``-2.3``."""
    return F.format_string(f"%+.{digits}f", _c(c))


def format_zone_table(t: DataFrame, key: str = "BASIC_ZONE") -> DataFrame:
    """P20 on the zone efficiency table."""
    return t.select(F.col(key).alias("Zone"),
                    thousands("attempts").alias("Attempts"),
                    percent_text("fg_pct").alias("FG %"),
                    fixed("pts_per_attempt", 3).alias("Points per attempt"))
