"""Typed scans (A10): every read passes an explicit schema; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from glossa.schemas import TABLES

_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
_TS = T.TimestampNTZType()


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Shapes of the driver's parquet tables.
DRIVER_SCHEMAS: dict[str, T.StructType] = {
    "region": _st(("r_regionkey", _I), ("r_name", _S)),
    "nation": _st(("n_nationkey", _I), ("n_name", _S), ("n_regionkey", _I)),
    "customer": _st(("c_custkey", _L), ("c_name", _S), ("c_nationkey", _I), ("c_acctbal", _D), ("c_mktsegment", _S)),
    "supplier": _st(("s_suppkey", _L), ("s_name", _S), ("s_nationkey", _I), ("s_acctbal", _D)),
    "part": _st(("p_partkey", _L), ("p_name", _S), ("p_brand", _S), ("p_type", _S), ("p_size", _I),
                ("p_retailprice", _D)),
    "orders": _st(("o_orderkey", _L), ("o_custkey", _L), ("o_orderstatus", _S), ("o_totalprice", _D),
                  ("o_orderdate", _TS), ("o_orderpriority", _S)),
    "lineitem": _st(("l_orderkey", _L), ("l_partkey", _L), ("l_suppkey", _L), ("l_linenumber", _I),
                    ("l_quantity", _D), ("l_extendedprice", _D), ("l_discount", _D), ("l_tax", _D),
                    ("l_returnflag", _S), ("l_linestatus", _S), ("l_shipdate", _TS)),
    "events": _st(("event_id", _L), ("ts", _TS), ("user_id", _L), ("event_type", _S), ("value", _D), ("props", _S)),
    "documents": _st(("doc_id", _L), ("text", _S), ("lang", _S), ("source", _S), ("n_chars", _L)),
    "embeddings": _st(("vec_id", _L), ("embedding", T.ArrayType(T.FloatType())), ("label", _I)),
    "pages": _st(("page_id", _L), ("url", _S), ("html", _S)),
    "benchmark": _st(("item_id", _L), ("text", _S)),
    "labels": _st(("doc_id", _L), ("quality", _I), ("toxic", _I)),
    "conversations": _st(("conv_id", _L), ("turn", _L), ("role", _S), ("text", _S)),
}


def read_driver_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(DRIVER_SCHEMAS[name]).parquet(f"{root.rstrip('/')}/{name}.parquet")
