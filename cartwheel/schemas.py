"""Schemas of the incoming data: change-feed envelopes, click events, FX documents, behaviour CSV."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: payload columns of the captured tables (money widened to 18 digits, ids to 64 bits) ---
PAYLOADS = {
    "products": "product_id STRING, category_id STRING, category_code STRING, category_fill STRING, "
                "brand STRING, avg_price DECIMAL(18,2), created_at STRING",
    "orders": "id BIGINT, user_id BIGINT, product_id STRING, quantity INT, unit_price DECIMAL(18,2), "
              "total_amount DECIMAL(18,2), amount DECIMAL(18,2), currency STRING, payment_method STRING, "
              "status STRING, created_at STRING, updated_at STRING",
    "users": "id BIGINT, name STRING, email STRING, phone STRING, city STRING, country STRING, "
             "created_at STRING, updated_at STRING",
    "order_items": "order_item_id BIGINT, order_id BIGINT, product_id BIGINT, quantity INT, unit_price DECIMAL(18,2)",
    "categories": "category_id BIGINT, name STRING, parent_id BIGINT",
    "reviews": "review_id BIGINT, user_id BIGINT, product_id BIGINT, rating INT, comment STRING, created_at BIGINT",
    "coupons": "coupon_id BIGINT, code STRING, discount_pct DECIMAL(5,2), valid_from BIGINT, valid_to BIGINT, "
               "is_active BOOLEAN",
}
CHANGE_SOURCE = ("version STRING, connector STRING, name STRING, ts_ms BIGINT, db STRING, schema STRING, "
                 "`table` STRING, txId BIGINT, lsn BIGINT, xmin BIGINT")
# --- fixed values: click event as it arrives (timestamp still text, ids widened to 64 bits) ---
CLICK_EVENT = ("event_id STRING, user_id BIGINT, session_id STRING, event_type STRING, device STRING, "
               "referrer STRING, ip_address STRING, user_agent STRING, event_timestamp STRING, "
               "item_id STRING, page_url STRING, duration_ms INT, scroll_depth_pct INT, search_query STRING, "
               "result_count INT, click_target STRING, quantity INT, cart_total FLOAT, step STRING, "
               "pseudo_order_id STRING, real_order_id BIGINT, purchase_amount FLOAT")
# --- fixed values: historical behaviour CSV ---
BEHAVIOUR_CSV = ("event_time STRING, event_type STRING, product_id STRING, category_id STRING, "
                 "category_code STRING, brand STRING, price DOUBLE, user_id STRING, user_session STRING")


def ddl(text: str) -> T.StructType:
    return T.StructType.fromDDL(text)


def envelope(payload: T.StructType) -> T.StructType:
    """Change event around a row: its image before and after, the operation and where it came from."""
    return (
        T.StructType()
        .add("before", payload)
        .add("after", payload)
        .add("op", T.StringType())
        .add("ts_ms", T.LongType())
        .add("source", ddl(CHANGE_SOURCE))
    )


# types that hold every value of those before them
_WHOLE = ("tinyint", "smallint", "int", "bigint")


def _whole_digits(kind: T.DataType) -> int | None:
    """Digits before the point that a whole number or decimal type can hold."""
    if isinstance(kind, T.DecimalType):
        return kind.precision - kind.scale
    return dict(zip(_WHOLE, (3, 5, 10, 19))).get(kind.simpleString())


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds all values of both; ValueError where there is none."""
    if a == b:
        return a
    names = {a.simpleString(), b.simpleString()}
    if names <= set(_WHOLE):
        return a if _WHOLE.index(a.simpleString()) > _WHOLE.index(b.simpleString()) else b
    if names == {"float", "double"}:
        return T.DoubleType()
    if names == {"date", "timestamp"}:
        return T.TimestampType()
    digits = [_whole_digits(t) for t in (a, b)]
    if None not in digits:
        scale = max(getattr(t, "scale", 0) for t in (a, b))
        if max(digits) + scale <= 38:
            return T.DecimalType(max(digits) + scale, scale)
    raise ValueError(f"no type holds {a.simpleString()} and {b.simpleString()}")


def resolved(*versions: str | T.StructType) -> T.StructType:
    """One schema for rows of several versions: columns in the order they first came, each of the widest type."""
    found: dict[str, T.DataType] = {}
    for version in versions:
        for field in (ddl(version) if isinstance(version, str) else version):
            try:
                found[field.name] = wider(found.get(field.name, field.dataType), field.dataType)
            except ValueError as error:
                raise ValueError(f"{field.name}: {error}") from None
    return T.StructType([T.StructField(name, kind) for name, kind in found.items()])


def payload(table: str, *later: str) -> T.StructType:
    """Columns of a captured table over all its versions: the registered one and ``later`` ones."""
    if table not in PAYLOADS:
        raise ValueError(f"no change-feed schema for {table!r}; known tables: {', '.join(sorted(PAYLOADS))}")
    return resolved(PAYLOADS[table], *later)


def change_schema(table: str, *later: str) -> T.StructType:
    """Envelope around the rows of a table. Lines of an older version lack the columns added since, which are NULL then."""
    return envelope(payload(table, *later))


def click_schema() -> T.StructType:
    return ddl(CLICK_EVENT)


def landed_click_schema() -> T.StructType:
    """Schema of the parsed event files: typed timestamp, text day, no pseudo order id."""
    fields = []
    for field in click_schema():
        if field.name == "pseudo_order_id":
            continue
        if field.name == "event_timestamp":
            fields += [T.StructField("event_timestamp", T.TimestampType()), T.StructField("event_date", T.StringType())]
        else:
            fields.append(field)
    return T.StructType(fields)
