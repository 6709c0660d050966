"""Column expressions: all JVM-side built-ins, no Python UDFs."""

from reelhouse.functions.exprs import (  # noqa: F401
    bucketize,
    first_item,
    first_word,
    fill_int_expr,
    num,
    parse_date,
    popularity,
    rating_band,
    surrogate_key,
    year_range,
)
from reelhouse.functions.calendar import (  # noqa: F401
    HOLIDAY_RULES,
    holiday_name,
    is_weekend,
    season,
    weekday_name,
)
