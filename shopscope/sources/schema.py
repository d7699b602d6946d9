"""Schemas of the logical inputs the jobs consume, and a validator.

The jobs are written against these column names and types; any source
(warehouse tables, a JDBC read, parquet files, or the fixture mapping in
:mod:`shopscope.sources.fixtures`) is adapted to them first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_S = T.StringType()
_L = T.LongType()
_I = T.IntegerType()
_D = T.DateType()
_TS = T.TimestampNTZType()
_MONEY = T.DecimalType(18, 4)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


LOYALTY_CUSTOMER = _struct(
    ("customer_id", _L), ("loyalty_customer_id", _L), ("loyalty_code", _S), ("status_ind", _S)
)
LOYALTY_MEMBER = _struct(("loyalty_customer_id", _L), ("date_from", _D), ("date_to", _D), ("insert_user", _S))
CRM_CUSTOMER = _struct(
    ("customer_id", _L),
    ("birth_date", _D),
    ("billing_post_code", _S),
    ("gender", _S),
    ("email_address", _S),
)
CUST_STORE = _struct(("customer_id", _L), ("store_sign_up", _I))
DIM_STORE = _struct(("store_code", _I), ("store_type", _S), ("store_brand", _S), ("store_description", _S))
LOCATION = _struct(("location_code", _I), ("postcode", _S))
DIM_ITEM = _struct(
    ("item_id", _L),
    ("item_colour_code", _S),
    ("item_description", _S),
    ("division", _S),
    ("department", _S),
    ("category", _S),
    ("size", _S),
)
FACT_SALES = _struct(
    ("customer_id", _L),
    ("item_id", _L),
    ("sale_code", _L),
    ("online_sale", _I),
    ("loyalty_flag", _I),
    ("transaction_date_time", _TS),
    ("ordered_date", _TS),
    ("store_currency_code", _S),
    ("aud_sales", _MONEY),
)
DATE_DIMENSION = _struct(("d", _D), ("date_key", _I), ("trade_week_code", _I))
SENDJOBS = _struct(("send_id", _I), ("email_name", _S))
OPENS = _struct(("subscriber_key", _S), ("send_id", _I))
CLICKS = OPENS

_KV = T.ArrayType(
    T.StructType(
        [
            T.StructField("key", _S, True),
            T.StructField(
                "value",
                T.StructType([T.StructField("string_value", _S, True), T.StructField("int_value", _L, True)]),
                True,
            ),
        ]
    ),
    True,
)
APP_EVENTS = _struct(
    ("event_date", _S),
    ("event_timestamp", _L),
    ("event_name", _S),
    ("user_pseudo_id", _S),
    ("geo", T.StructType([T.StructField("country", _S, True)])),
    ("event_value_in_usd", T.DecimalType(18, 2)),
    ("event_params", _KV),
    ("user_properties", _KV),
)

LOGICAL_SCHEMAS = {
    "loyalty_customer": LOYALTY_CUSTOMER,
    "loyalty_member": LOYALTY_MEMBER,
    "crm_customer": CRM_CUSTOMER,
    "cust_store": CUST_STORE,
    "dim_store": DIM_STORE,
    "location": LOCATION,
    "dim_item": DIM_ITEM,
    "fact_sales": FACT_SALES,
    "date_dimension": DATE_DIMENSION,
    "sendjobs": SENDJOBS,
    "opens": OPENS,
    "clicks": CLICKS,
    "app_events": APP_EVENTS,
}


def _shape(t: T.DataType) -> str:
    # Nullability is not part of the contract; compare the type tree only.
    if isinstance(t, T.StructType):
        return "struct<" + ",".join(f"{f.name}:{_shape(f.dataType)}" for f in t.fields) + ">"
    if isinstance(t, T.ArrayType):
        return f"array<{_shape(t.elementType)}>"
    return t.simpleString()


def validate(df: DataFrame, name: str) -> DataFrame:
    """Check that ``df`` has the columns and types of logical input ``name``.

    Extra columns are allowed (and pruned by the planner when unused).  Text
    columns that partition discovery has read as integers are cast back.
    Raises ``ValueError`` listing every missing or mistyped column.
    """
    expected = LOGICAL_SCHEMAS[name]
    actual = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for field in expected.fields:
        # A day like 20240131 in a folder name is read back as an integer.
        if isinstance(field.dataType, T.StringType) and isinstance(actual.get(field.name), (T.IntegerType, T.LongType)):
            df = df.withColumn(field.name, df[field.name].cast("string"))
            continue
        if field.name not in actual:
            problems.append(f"missing {field.name}")
        elif _shape(actual[field.name]) != _shape(field.dataType):
            problems.append(f"{field.name}: {actual[field.name].simpleString()} != {field.dataType.simpleString()}")
    if problems:
        raise ValueError(f"{name}: " + "; ".join(problems))
    return df
