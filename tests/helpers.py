def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


def numbers(spark, first, last, name="n"):
    return spark.range(first, last + 1).withColumnRenamed("id", name)
