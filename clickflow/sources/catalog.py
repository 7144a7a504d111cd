"""Tables by name: catalog tables, Parquet folders and temporary views."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampNTZType

from clickflow import schemas
from clickflow.functions.times import parse_time_strict
from clickflow.operators.filters import DATE_TEXT


def conform(df: DataFrame, schema: StructType, extra=()) -> DataFrame:
    """The schema's columns and types, then ``extra`` columns as they are.

    Time text with one-digit parts is accepted; date text is ISO, yyyy-MM-dd.
    """
    present = dict(df.dtypes)
    columns = []
    for field in schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, TimestampNTZType) and present[field.name] == "string":
            col = parse_time_strict(col)
        elif present[field.name] != field.dataType.simpleString():
            col = col.cast(field.dataType)
        columns.append(col.alias(field.name))
    return df.select(*columns, *extra)


def read_table(spark: SparkSession, name: str, schema: StructType, extra=()) -> DataFrame:
    return conform(spark.table(name), schema, extra)


def read_parquet(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return conform(spark.read.parquet(path), schema)


def actions_table(spark: SparkSession, name="user_visit_action", extra=()) -> DataFrame:
    """The action table, with ``extra`` columns such as a unique id for ties.

    A date column of text is kept beside its typed form as ``date_text``, on which
    ``filters.date_range`` filters too, so that its bounds reach the scan.
    """
    table = spark.table(name)
    if dict(table.dtypes).get("date") == "string":
        table = table.withColumn(DATE_TEXT, F.col("date"))
        extra = [*extra, DATE_TEXT]
    return conform(table, schemas.USER_VISIT_ACTION, extra)


def users_table(spark: SparkSession, name="user_info") -> DataFrame:
    return read_table(spark, name, schemas.USER_INFO)


def register_view(spark: SparkSession, rows, schema: StructType, name: str) -> DataFrame:
    """Temporary view ``name`` with an explicit schema over a DataFrame or a list of rows."""
    if isinstance(rows, DataFrame):
        df = conform(rows, schema)
    else:
        df = spark.createDataFrame(rows, schema)
    df.createOrReplaceTempView(name)
    return df
