"""Fixed table schemas.

Times are wall-clock values without a zone, so results do not depend on the
session time zone.
"""

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _struct(*fields):
    return StructType([StructField(name, kind, True) for name, kind in fields])


USER_VISIT_ACTION = _struct(
    ("date", DateType()),
    ("user_id", LongType()),
    ("session_id", StringType()),
    ("page_id", LongType()),
    ("action_time", TimestampNTZType()),
    ("search_keyword", StringType()),
    ("click_category_id", LongType()),
    ("click_product_id", LongType()),
    ("order_category_ids", StringType()),
    ("order_product_ids", StringType()),
    ("pay_category_ids", StringType()),
    ("pay_product_ids", StringType()),
)

USER_INFO = _struct(
    ("user_id", LongType()),
    ("username", StringType()),
    ("name", StringType()),
    ("age", IntegerType()),
    ("professional", StringType()),
    ("city", StringType()),
    ("sex", StringType()),
)

TASK = _struct(
    ("id", LongType()),
    ("name", StringType()),
    ("create_time", StringType()),
    ("start_time", StringType()),
    ("finish_time", StringType()),
    ("task_type", StringType()),
    ("task_status", StringType()),
    ("task_param", StringType()),
)

SESSION_RANDOM_EXTRACT = _struct(
    ("task_id", LongType()),
    ("session_id", StringType()),
    ("start_time", StringType()),
    ("search_keywords", StringType()),
    ("click_category_ids", StringType()),
)

SESSION_DETAIL = _struct(
    ("task_id", LongType()),
    ("user_id", LongType()),
    ("session_id", StringType()),
    ("page_id", LongType()),
    ("action_time", StringType()),
    ("search_keyword", StringType()),
    ("click_category_id", LongType()),
    ("click_product_id", LongType()),
    ("order_category_ids", StringType()),
    ("order_product_ids", StringType()),
    ("pay_category_ids", StringType()),
    ("pay_product_ids", StringType()),
)

# Band labels used in result column names.
VISIT_LABELS = ("1s_3s", "4s_6s", "7s_9s", "10s_30s", "30s_60s", "1m_3m", "3m_10m", "10m_30m", "30m")
STEP_LABELS = ("1_3", "4_6", "7_9", "10_30", "30_60", "60")

SESSION_AGGR_STAT = _struct(
    ("taskid", LongType()),
    ("session_count", LongType()),
    *((f"visit_length_{label}_ratio", DoubleType()) for label in VISIT_LABELS),
    *((f"step_length_{label}_ratio", DoubleType()) for label in STEP_LABELS),
)

TOP_CATEGORY = _struct(
    ("task_id", LongType()),
    ("category_id", LongType()),
    ("click_count", LongType()),
    ("order_count", LongType()),
    ("pay_count", LongType()),
)

TOP_SESSION = _struct(
    ("task_id", LongType()),
    ("category_id", LongType()),
    ("session_id", StringType()),
    ("click_count", LongType()),
)

PAGE_CONVERSION = _struct(
    ("task_id", LongType()),
    ("slice", StringType()),
    ("n", LongType()),
    ("rate", DoubleType()),
)
