"""Which rows may have a partner: a bit map of ids of fixed size, for joins that would
otherwise move every text. Ids not in the map have no partner; few others are let through."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.llm.shipping import ship

MAP_BITS = 24


class IdMap:
    """2**MAP_BITS bits, two megabytes, whatever the number of ids."""

    def __init__(self, ids: DataFrame, column: str):
        spark = ids.sparkSession
        ship(spark)
        code = F.pmod(F.xxhash64(column), F.lit(1 << MAP_BITS))
        words = ids.filter(F.col(column).isNotNull()).select(
            F.floor(code / 32).alias("w"),
            F.expr(f"shiftleft(1L, CAST(pmod(xxhash64({column}), 32) AS INT))").alias("b"),
        ).groupBy("w").agg(F.bit_or("b").alias("b"))
        bits = np.zeros(1 << (MAP_BITS - 5), "<u4")
        for row in words.collect():
            bits[row["w"]] = row["b"]
        shared = spark.sparkContext.broadcast(bits.tobytes())

        @F.pandas_udf("boolean")
        def maybe(code: pd.Series) -> pd.Series:
            place = code.to_numpy()
            word = np.frombuffer(shared.value, "<u4")[place >> 5].astype(np.int64)
            return pd.Series((word >> (place & 31)) & 1 == 1)

        self._maybe = maybe

    def maybe(self, id_column: Column) -> Column:
        return self._maybe(F.pmod(F.xxhash64(id_column), F.lit(1 << MAP_BITS)))
