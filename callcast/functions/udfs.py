"""The reference's one Python UDF, as an Arrow-batched pandas UDF.

``age_group3`` (a native CASE expression) is the fast path and should be
preferred; this UDF exists for users who need the Python form.  Unlike the
row-at-a-time original it is NULL-safe (NULL age -> NULL group).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


@F.pandas_udf(StringType())
def _age_group_pandas(age: pd.Series) -> pd.Series:
    a = age.astype("float64")
    out = np.where(a < 30, "<30", np.where(a <= 60, "30-60", ">60")).astype(object)
    out[a.isna().to_numpy()] = None
    return pd.Series(out)


def age_group_udf(col: str | Column = "age") -> Column:
    from pyspark.sql import SparkSession

    from callcast.session import ship_package

    spark = SparkSession.getActiveSession()
    if spark is not None:
        ship_package(spark)
    return _age_group_pandas(F.col(col) if isinstance(col, str) else col)
