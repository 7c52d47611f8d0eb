"""Helpers of the core tests; the fixtures are in conftest.py."""


def order_frame(spark, rows):
    df = spark.createDataFrame(rows, "customer_id STRING, order_id STRING, order_date STRING, order_amount DOUBLE")
    return df.withColumn("order_date", df.order_date.cast("date"))


def rows(df, *order):
    """Rows as tuples, sorted by the given columns (or by everything)."""
    found = [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
    return found if order else sorted(found, key=repr)


def plan(df, mode="formatted"):
    """The physical plan as text."""
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)
