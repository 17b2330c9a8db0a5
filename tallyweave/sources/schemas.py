"""Record layouts, declared so no reader has to infer one."""

from pyspark.sql import types as T


def _struct(*fields):
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_S, _D, _I, _L = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()

REVIEW = _struct(
    ("review_id", _S), ("user_id", _S), ("business_id", _S), ("stars", _D), ("date", _S), ("text", _S)
)
BUSINESS = _struct(("business_id", _S), ("state", _S))
YEAR_BASKET = _struct(("year", _I), ("user_id", _S), ("business_id", _S), ("rating", _I))
USER_BUSINESS = _struct(("user_id", _S), ("business_id", _S))
ITEM_EDGE = _struct(("b1", _S), ("b2", _S), ("sim", _D), ("num_co_rated", _L))
PROFILE = _struct(("business", _S), ("user", _S), ("profile", T.ArrayType(_S)))
