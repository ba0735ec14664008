"""Run parameters of the registered query catalogue.

The library functions take every threshold as an argument; this module only
collects the values the catalogue, the oracle SQL and the bench share.
"""

from __future__ import annotations

import calendar
import datetime as _dt

# Reference time of every job ("today"); never ``now()``.
AS_OF = _dt.datetime(2024, 1, 31, 0, 0, 0)
AS_OF_SQL = "TIMESTAMP '2024-01-31 00:00:00'"
AS_OF_EPOCH = 1706659200  # AS_OF in epoch seconds (UTC)

# --- fixed values of the reference (must stay equal for equal results) ---
# first-k cut of a packed list read from text
PACKED_LIST_MAX = 2000
# history: entries of yesterday's list that count
HISTORY_FIRST = 2
# first-N blocklist length
FIRST_BLOCK_N = 50
# per-seed eligible caps (kept items; observed off-by-one already applied):
#   31, or 19 when the user has >= 10 seeds; P4: 31, or 21; P3: 30 per tag
SEED_CAP_P2 = (31, 19)
SEED_CAP_P4 = (31, 21)
SEED_CAP_MANY = 10
TAG_CAP_P3 = 30
# distinct-item budget over seeds
SEED_BUDGET = 640
# P3 per-reason cap and total cap before scoring
REASON_CAP = 30
REASON_TOTAL = 360
# quota interleave clamp
QUOTA_MIN, QUOTA_MAX = 2, 5
# impression penalty divisor (exponent of the count is 0 in the reference)
IMPRESS_DECAY = 2.5
# default promoted rate per route
RATE_DEFAULT_P2, RATE_DEFAULT_P3, RATE_DEFAULT_P4 = 0.04, 0.05, 0.09
# LR score of an item without features
MISSING_ITEM_SCORE = 0.05
# offset of the item block in the weight vector
USER_WIDTH = 56
# affinity threshold and ignored style literals
AFFINITY_MIN = 0.03
AFFINITY_IGNORED = ("unknow", "null")
# monetisation boost: (money weight, click weight, factor) and head re-rank
PAY_P2 = (80.0, 0.0, 0.12)
PAY_P2_HEAD = (83.0, 0.0, 0.12)
HEAD_N = 48
PAY_P4 = (70.0, 800.0, 0.15)
# top-N per route: P2 49, P4 maxRecommendation + 1 (48 + 1), P3 maxRecommendation (64)
TOP_P2 = 49
MAX_REC_P3 = 64
TOP_P4 = 49
# blend of recall score and model score
BLEND_P2P4 = 1e-6
BLEND_P3 = 1e-3
# freshness: age limit (days) for boost A, pubTime divisor for boost B
FRESH_AGE_DAYS = 60
FRESH_RATIO_DIV = 1254.0
FRESH_RATIO_MULT = 1.5
# repeat-tag damping divisor
TAG_DAMPING = 2000.0
# play-log constant score
LOG_PLAY_SCORE = 0.05
# age limit applied by the per-user limit table
AGE_LIMIT_DAYS = 360
# stepped diversity divisor step and quota-interleave penalty divisor
DIVERSITY_STEP = 1.5
QUOTA_PENALTY = 10.0
# item age when the profile is missing (days); publish index divisor
DEFAULT_AGE_DAYS = 100
PUB_INDEX_DIV = 1000000
# log vocabulary: click and subscribe actions, impression marker, play-log filter values
CLICK_ACTION = "recommendclick"
SUBSCRIBE_ACTION = "subscribe"
IMPRESSION_MARKER = "user-playlist"
PLAY_ACTION, PLAY_TYPE, PLAY_SOURCE = "play", "song", "list"
# A/B bucket remainders that get a label suffix
BUCKET_LABELS = (0, 1, 2, 3, 4, 5)
# end of fixed values

# --- catalogue settings (our choices for the test tables) ---
ACTIVE_DAYS_P2 = 1
ACTIVE_DAYS_P3 = 2
ACTIVE_DAYS_P4 = 1
IMPRESS_WINDOW_P2 = (1, 14)
IMPRESS_WINDOW_P3 = (2, 90)
IMPRESS_WINDOW_P4 = (1, 14)
DIVISOR = 2
REMAINDER = 0
REMAINDER_2 = 1
AB_BUCKETS = 4
ITEM_WIDTH = 64  # embedding bits
WEIGHTS_LEN = USER_WIDTH + ITEM_WIDTH + 3


def epoch(ts: _dt.datetime) -> int:
    """Epoch seconds of a naive UTC datetime."""
    return calendar.timegm(ts.timetuple())


def max_impress(as_of: _dt.datetime = AS_OF) -> int:
    """Calendar-driven impression cap: 4 when day-of-month % 3 == 1, else 2."""
    return 4 if as_of.day % 3 == 1 else 2


def weight_value(i: int, mult: int = 37, mod: int = 101, shift: int = 50) -> float:
    """Closed-form model weight used by the catalogue (both engines build it)."""
    return ((i * mult) % mod - shift) / 100.0


WEIGHTS = [weight_value(i) for i in range(WEIGHTS_LEN)]
WEIGHTS_AB = [weight_value(i, 53, 97, 48) for i in range(WEIGHTS_LEN)]
