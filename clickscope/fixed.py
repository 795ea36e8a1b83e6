"""Fixed values.

These must equal the values used by the original clickstream application
so that results, exported keys and formats line up with it.
"""

# Fixed values (must equal the original application's) -----------------
AD_LOG_TOPIC = "ads_log"
TOP3_KEY_PREFIX = "top3_ads_per_day:"
CATEGORY_TOP10_TABLE = "category_top10"
CATEGORY_SESSION_TABLE = "category_top10_session_count"
NOT_A_CLICK = -1
LOG_FIELD_SEPARATOR = " "
LOG_FIELDS = 5
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DAY_FORMAT = "yyyy-MM-dd"
TOP_CATEGORIES = 10
TOP_SESSIONS = 10
TOP_ADS = 3
BLACKLIST_THRESHOLD_STORE_VARIANT = 100
BATCH_INTERVAL = "5 seconds"
# ------------------------------------------------------------------------
