"""Small frames for tests."""

import pandas as pd
from pyspark.sql import functions as F


def series_frame(spark, rows: pd.DataFrame, ts="ts"):
    """pandas rows to Spark with a naive timestamp and NULL instead of NaN."""
    typed = rows.astype(object).where(rows.notna(), None)
    types = {"datetime64[ns]": "timestamp_ntz", "float64": "double", "int64": "bigint", "object": "string", "bool": "boolean"}
    schema = ", ".join(f"`{c}` {types[str(rows[c].dtype)]}" for c in rows.columns)
    values = [tuple(v.to_pydatetime() if isinstance(v, pd.Timestamp) else v for v in r) for r in typed.itertuples(index=False, name=None)]
    return spark.createDataFrame(values, schema)


def sorted_pandas(df, *by):
    return df.orderBy(*by).toPandas()


def ntz(text):
    return F.lit(text).cast("timestamp_ntz")
