from pyspark.sql import types as T


def rows(df):
    return [tuple(r) for r in df.collect()]


def bag(df):
    """Rows as a sorted list, for comparing without order."""
    return sorted(rows(df), key=lambda r: tuple((v is not None, str(v)) for v in r))


def text_frame(spark, names, data):
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.createDataFrame(data, schema)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The plan after adaptive execution has run it."""
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]
