"""Explicit schema of the visit-action input."""

from pyspark.sql import types as T

# One user action on the shop site (a click, an order, a payment or a search).
VISIT_ACTION = T.StructType([
    T.StructField("date", T.StringType()),               # yyyy-MM-dd
    T.StructField("user_id", T.LongType(), False),
    T.StructField("session_id", T.StringType(), False),
    T.StructField("page_id", T.LongType(), False),
    T.StructField("action_time", T.StringType(), False),  # yyyy-MM-dd HH:mm:ss, compared as text
    T.StructField("search_keyword", T.StringType()),
    T.StructField("click_category_id", T.LongType(), False),  # -1 = not a click
    T.StructField("click_product_id", T.LongType(), False),   # -1 = not a click
    T.StructField("order_category_ids", T.StringType()),  # comma list, null = not an order
    T.StructField("order_product_ids", T.StringType()),
    T.StructField("pay_category_ids", T.StringType()),    # comma list, null = not a payment
    T.StructField("pay_product_ids", T.StringType()),
    T.StructField("city_id", T.LongType(), False),
])
