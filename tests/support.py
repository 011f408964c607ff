"""What several tests share."""

from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"


def instants(spark, texts, **columns):
    """A table with a time column `ts` from texts and further columns from lists."""
    names = ["ts", *columns]
    rows = list(zip(texts, *columns.values()))
    kinds = ["string", *("double" if any(isinstance(v, float) for v in c) else "bigint" for c in columns.values())]
    frame = spark.createDataFrame(rows, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))
    return frame.withColumn("ts", F.col("ts").cast("timestamp"))


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()
