"""Column functions: parsers for dirty text, validators and safe arithmetic.
All are compositions of built-in Spark expressions (JVM side, codegen'd)."""

from strata.functions.parse import (  # noqa: F401
    parse_price, parse_percent, parse_count_text, parse_flag, parse_list,
    parse_date, lenient_number, year_of, missing,
)
from strata.functions.validate import valid_email  # noqa: F401
from strata.functions.arith import safe_ratio, convert_currency  # noqa: F401
