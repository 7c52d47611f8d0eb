"""Fixed schemas of the entities, and the name -> schema registry.

Fixed values: column names and types must equal the feeds'.
"""

from __future__ import annotations

from pyspark.sql import types as T


def columns(text: str) -> T.StructType:
    """A schema from "name type, name type" with simple types; needs no running session."""
    out = T.StructType()
    for part in text.split(","):
        name, kind = part.split()
        out.add(name, {"int": "integer", "bigint": "long"}.get(kind.lower(), kind.lower()))
    return out


CUSTOMERS = columns(
    "customer_id STRING, location STRING, tenure_months INT, account_creation_date DATE"
)
ORDERS = columns(
    "order_id STRING, customer_id STRING, order_date DATE, payment_method STRING, "
    "days_since_last_purchase INT, repeat_customer INT, total_amount DOUBLE"
)
ORDER_ITEMS = columns(
    "order_item_id STRING, order_id STRING, product_id STRING, quantity INT, unit_price DOUBLE, line_total DOUBLE"
)
PRODUCTS = columns(
    "product_id STRING, product_name STRING, category STRING, unit_price DOUBLE, stock_level INT, "
    "product_launch_date DATE, supplier_id STRING"
)

TABLE_SCHEMAS = {
    "customers": CUSTOMERS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "products": PRODUCTS,
}

#: Typed landing columns of the bronze tables loaded from string-only CSV.
BRONZE_CASTS = {
    "customers": columns(
        "customer_id STRING, email STRING, name STRING, city STRING, state STRING, country STRING, signup_date DATE"
    ),
    "orders": columns(
        "order_id STRING, customer_id STRING, order_date DATE, order_total DOUBLE, order_status STRING"
    ),
    "order_items": columns(
        "order_item_id STRING, order_id STRING, product_id STRING, quantity INT, unit_price DOUBLE"
    ),
    "products": columns(
        "product_id STRING, product_name STRING, category STRING, subcategory STRING, price DOUBLE"
    ),
}

BATCH_SALES = columns(
    "sale_id INT, product_id INT, sale_date TIMESTAMP, quantity INT, unit_price DOUBLE"
)

RAW_SALES = columns(
    "event_id STRING, customer_id STRING, product_id STRING, quantity INT, unit_price DOUBLE, "
    "currency STRING, region STRING, event_timestamp TIMESTAMP, source_system STRING"
)

DEVICE_PAYLOAD = columns(
    "deviceId STRING, ts STRING, temperature DOUBLE, humidity DOUBLE, pressure DOUBLE, battery DOUBLE, "
    "lat DOUBLE, lon DOUBLE, status STRING"
)
DEVICE_ALERT_PAYLOAD = columns("deviceId STRING, ts STRING, temperature DOUBLE, battery DOUBLE")

#: Envelope of one message-bus record; `body` holds a JSON array of payloads.
BUS_ENVELOPE = columns("body BINARY, enqueuedTime TIMESTAMP, partition STRING")

GEO = T.StructType().add("lat", "string").add("lng", "string")
REST_USERS = (
    columns("id INT, name STRING, username STRING, email STRING, phone STRING")
    .add("address", T.StructType().add("city", "string").add("geo", GEO))
    .add("company", T.StructType().add("name", "string"))
)
REST_POSTS = columns("id INT, userId INT, title STRING, body STRING")

FEATURE_COLUMNS = (
    "customer_id STRING, order_id STRING, order_date DATE, order_amount DOUBLE, label_next_order_amount DOUBLE, "
    "last_order_amount DOUBLE, days_since_prev_order INT, purchase_count_to_date INT, hist_avg_purchase DOUBLE, "
    "total_spend_to_date DOUBLE"
)
FEATURES = columns(FEATURE_COLUMNS)


def schema_for(table: str) -> T.StructType:
    """The registered schema, or ValueError for an unknown table."""
    try:
        return TABLE_SCHEMAS[table]
    except KeyError:
        raise ValueError(f"no schema registered for table {table!r}") from None
