"""Scalar helpers: each returns a ``Column`` built from built-in functions,
so they stay inside whole-stage codegen."""

from firmo.functions.keys import company_key, metric_key, founder_key  # noqa: F401
from firmo.functions.text import (  # noqa: F401
    blank_to_null, clean_country, clean_domain, extract_host, label_truncate,
    strip_ws, title_case, upper_trim, is_missing_text,
)
from firmo.functions.numeric import (  # noqa: F401
    coerce_numeric, format_currency, format_number, parse_revenue_text,
    parse_year, parse_count,
)
from firmo.functions.time import parse_timestamp_multi  # noqa: F401
