"""Column expressions: text clean-up, banding, alert rules, currency, time parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Band limits and labels, alert limits, labels and texts, exchange rates,
# timestamp patterns. All must equal the published rules.
ORDER_VALUE_BANDS = [(500, "Low"), (1500, "Medium"), (2500, "High")]
ORDER_VALUE_TOP = "Premium"
TENURE_BANDS = [(180, "New"), (365, "Growing"), (730, "Established")]
TENURE_TOP = "Loyal"
HOT_CRITICAL, HOT_HIGH = 35, 30
BATTERY_CRITICAL, BATTERY_LOW = 10, 20
ALERT_TEXT = {
    "CRITICAL_TEMPERATURE": ("Critical temperature detected: ", "temperature", "°C"),
    "HIGH_TEMPERATURE": ("High temperature warning: ", "temperature", "°C"),
    "CRITICAL_BATTERY": ("Critical battery level: ", "battery", "%"),
    "LOW_BATTERY": ("Low battery warning: ", "battery", "%"),
}
SEVERITY = {
    "CRITICAL": ["CRITICAL_TEMPERATURE", "CRITICAL_BATTERY"],
    "WARNING": ["HIGH_TEMPERATURE", "LOW_BATTERY"],
}
USD_RATES = {"USD": 1.0, "EUR": 1.08, "GBP": 1.27, "CAD": 0.74}
EVENT_TIME_PATTERNS = ["yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "yyyy-MM-dd'T'HH:mm:ss'Z'"]


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def banded(value: Column | str, bands: list[tuple[float, str]], top: str) -> Column:
    """First band whose upper limit exceeds the value; NULL falls through to `top`."""
    limit, label = bands[0]
    chain = F.when(col(value) < limit, label)
    for limit, label in bands[1:]:
        chain = chain.when(col(value) < limit, label)
    return chain.otherwise(top)


def order_value_band(total: Column | str) -> Column:
    return banded(total, ORDER_VALUE_BANDS, ORDER_VALUE_TOP)


def tenure_band(days: Column | str) -> Column:
    return banded(days, TENURE_BANDS, TENURE_TOP)


def alert_type(temperature: Column | str, battery: Column | str, battery_full: float = 100.0) -> Column:
    """Rule label, first match wins. `battery_full` is the reading of a full battery:
    100 for percentages, 1 for devices that report a fraction."""
    level = col(battery) if battery_full == 100.0 else col(battery) * F.lit(100.0 / battery_full)
    return (
        F.when(col(temperature) > HOT_CRITICAL, "CRITICAL_TEMPERATURE")
        .when(col(temperature) > HOT_HIGH, "HIGH_TEMPERATURE")
        .when(level < BATTERY_CRITICAL, "CRITICAL_BATTERY")
        .when(level < BATTERY_LOW, "LOW_BATTERY")
        .otherwise("NORMAL")
    )


def alert_message(kind: Column | str, temperature: Column | str, battery: Column | str) -> Column:
    reading = {"temperature": col(temperature), "battery": col(battery)}
    text = None
    for label, (lead, source, unit) in ALERT_TEXT.items():
        body = F.concat(F.lit(lead), reading[source].cast("string"), F.lit(unit))
        text = F.when(col(kind) == label, body) if text is None else text.when(col(kind) == label, body)
    return text.otherwise("Normal operation")


def alert_severity(kind: Column | str) -> Column:
    chain = None
    for label, kinds in SEVERITY.items():
        test = col(kind).isin(kinds)
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    return chain.otherwise("NORMAL")


def usd_rate(currency: Column | str, rates: dict[str, float] | None = None) -> Column:
    """Rate of a currency code; an unknown or NULL code counts as 1.0."""
    table = USD_RATES if rates is None else rates
    lookup = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(lookup[col(currency)], F.lit(1.0))


def parse_event_time(text: Column | str) -> Column:
    """Timestamp of an ISO text with or without milliseconds, NULL when neither fits."""
    return F.coalesce(*[F.try_to_timestamp(col(text), F.lit(p)) for p in EVENT_TIME_PATTERNS])


def is_weekend(day: Column | str) -> Column:
    return F.when(F.dayofweek(col(day)).isin(7, 1), 1).otherwise(0)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Rounded percentage, NULL when the whole is zero."""
    return F.round(F.try_divide(part * 100.0, whole), digits)


def minutes_between(start: Column | str, end: Column | str) -> Column:
    return F.round((F.unix_timestamp(col(end)) - F.unix_timestamp(col(start))) / 60, 2)


def cast_to(schema: T.StructType, lenient: bool = True) -> list[Column]:
    """One cast per field of the schema; lenient casts turn bad input into NULL."""
    return [
        (F.col(f.name).try_cast(f.dataType) if lenient else F.col(f.name).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ]
