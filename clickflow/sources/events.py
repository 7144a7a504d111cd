"""Adapter from the ``events``, ``customer`` and ``nation`` tables to this library's tables.

A session is one user's day. The clock runs 24 times slower, so that a session stays
inside one hour and visit lengths fill every band.
"""

from pyspark.sql import DataFrame, SparkSession

# Declared, so that opening a table needs no job that reads file footers.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}

# The JSON number is read once per event, in a projection of its own.
EVENT = (
    "event_id",
    "ts",
    "to_date(ts) AS date",
    "user_id",
    "event_type",
    "CAST(get_json_object(props, '$.k') AS BIGINT) AS k",
)
ACTION = (
    "date",
    "user_id",
    "concat(user_id, '_', year(date) * 10000 + month(date) * 100 + day(date)) AS session_id",
    "k % 10 AS page_id",
    """CAST(date AS TIMESTAMP_NTZ) + make_dt_interval(
         0, CAST(user_id % 24 AS INT), 0, (hour(ts) * 3600 + minute(ts) * 60 + second(ts)) div 24)
       AS action_time""",
    "if(event_type = 'view', concat('kw', k % 10), NULL) AS search_keyword",
    "if(event_type = 'click', k, NULL) AS click_category_id",
    "if(event_type = 'click', event_id % 100, NULL) AS click_product_id",
    "if(event_type = 'purchase', concat(k, ',', k * 7 % 100), NULL) AS order_category_ids",
    "if(event_type = 'purchase', string(event_id % 100), NULL) AS order_product_ids",
    "if(event_type = 'signup', string(k), NULL) AS pay_category_ids",
    "if(event_type = 'signup', string(event_id % 100), NULL) AS pay_product_ids",
    "event_id",
)
USER = (
    "c_custkey AS user_id",
    "c_name AS username",
    "c_name AS name",
    "CAST(10 + c_custkey % 50 AS INT) AS age",
    "c_mktsegment AS professional",
    "n_name AS city",
    "if(c_custkey % 2 = 0, 'male', 'female') AS sex",
)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def actions_from_events(events: DataFrame) -> DataFrame:
    """``user_visit_action`` columns plus ``event_id``, unique and in time order."""
    return events.selectExpr(*EVENT).selectExpr(*ACTION)


def users_from_customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """``user_info`` columns."""
    joined = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    return joined.selectExpr(*USER)


def load_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return actions_from_events(read(spark, sf_dir, "events"))


def load_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users_from_customers(read(spark, sf_dir, "customer"), read(spark, sf_dir, "nation"))
