"""Type names accepted by the column-type rule, mapped to Spark types."""

from __future__ import annotations

from pyspark.sql import types as T

from ..errors import BadParameter

# One table: rule type name (pandas / numpy / Spark spelling) -> accepted Spark types.
TYPE_NAMES: dict[str, tuple[type, ...]] = {
    "timestamp": (T.TimestampType, T.TimestampNTZType),
    "datetime64": (T.TimestampType, T.TimestampNTZType),
    "datetime64[ns]": (T.TimestampType, T.TimestampNTZType),
    "timestamptype": (T.TimestampType,),
    "timestampntztype": (T.TimestampNTZType,),
    "date": (T.DateType,),
    "datetype": (T.DateType,),
    "str": (T.StringType,),
    "string": (T.StringType,),
    "object": (T.StringType,),
    "stringtype": (T.StringType,),
    "int": (T.IntegralType,),
    "int64": (T.LongType,),
    "int32": (T.IntegerType,),
    "integer": (T.IntegralType,),
    "integertype": (T.IntegerType,),
    "long": (T.LongType,),
    "longtype": (T.LongType,),
    "float": (T.FractionalType,),
    "float64": (T.DoubleType,),
    "double": (T.DoubleType,),
    "doubletype": (T.DoubleType,),
    "bool": (T.BooleanType,),
    "boolean": (T.BooleanType,),
    "booleantype": (T.BooleanType,),
}


def accepted_types(type_name: str) -> tuple[type, ...]:
    try:
        return TYPE_NAMES[type_name.lower()]
    except KeyError:
        raise BadParameter(f"unknown type name for the type rule: {type_name!r}") from None


def type_matches(dtype: T.DataType, type_name: str) -> bool:
    return isinstance(dtype, accepted_types(type_name))
