from pyspark.sql import functions as F


def values(spark, inputs, build, kind="string"):
    """``build`` over one column, in input order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    rows = df.select("i", build(F.col("v")).alias("out")).orderBy("i").collect()
    return [r["out"] for r in rows]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
