"""Clock parts of the event time text, as SQL expressions."""


def hour_or_null(c: str) -> str:
    """Hour of an ISO text, null when it cannot be read."""
    return f"hour(try_to_timestamp({c}))"


def hour_of_day(c: str) -> str:
    return f"coalesce({hour_or_null(c)}, 12)"


def minute_of_hour(c: str) -> str:
    return f"coalesce(minute(try_to_timestamp({c})), 0)"


def is_weekend(c: str) -> str:
    return f"coalesce(cast(weekday(try_to_timestamp({c})) >= 5 AS int), 0)"
