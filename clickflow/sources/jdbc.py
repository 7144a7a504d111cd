"""Tables in a relational database, through Spark's JDBC source.

Connection options (``url``, ``driver``, ``user``, ``password``, ...) come from the caller.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow import schemas
from clickflow.sources.catalog import conform


def read_jdbc(spark: SparkSession, options, table=None, query=None, split=None) -> DataFrame:
    """A database table or query as a DataFrame.

    Filters and column choices made on the result are pushed to the database.
    ``split=(column, lower, upper, partitions)`` reads a table in parallel ranges.
    """
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table and query")
    reader = spark.read.format("jdbc").options(**options)
    if query is not None:
        if split is not None:
            raise ValueError("a parallel read needs a table, not a query")
        return reader.option("query", query).load()
    if split is not None:
        column, lower, upper, partitions = split
        reader = reader.options(
            partitionColumn=column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
        )
    return reader.option("dbtable", table).load()


def read_task(spark: SparkSession, options, task_id: int, table="task") -> DataFrame:
    """The row of one task; the key test runs in the database."""
    tasks = read_jdbc(spark, options, table=table).filter(F.col("id") == task_id)
    return conform(tasks, schemas.TASK)
