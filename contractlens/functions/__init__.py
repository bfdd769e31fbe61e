"""Native column expressions.  No Python UDF anywhere."""

from contractlens.functions.parse import (  # noqa: F401
    parse_date,
    parse_decimal,
    parse_flag,
    parse_localized,
    parse_month,
    parse_percent,
    parse_timestamp,
)
from contractlens.functions.scalar import (  # noqa: F401
    calendar_months_between,
    code_lookup,
    date_key,
    fold,
    minutes_between,
    money,
    month_of,
    normalize_code,
    positive_part,
    rate,
    row_hash,
    whole_ratio,
)
