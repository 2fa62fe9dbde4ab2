"""Scalar column functions: ``Column -> Column`` built on Spark built-ins."""

from .dates import (  # noqa: F401
    age, birth_by_date, birth_year, fill_date, format_date, header_to_iso,
    lenient_date, parse_mdy, reorder_mdy, year_of, year_only_to_date_text,
)
from .keys import link_key, mail_key, normalise_mark, number_or_zero  # noqa: F401
from .predicates import (  # noqa: F401
    contains_literal, equals_flag, in_codes, not_sentinel, pattern_flag, present,
)
from .text import (  # noqa: F401
    analyze, join_nonnull, lower, search_text, strip_ws, truncate_words, upper,
)
