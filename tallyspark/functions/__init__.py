"""Column -> Column building blocks. Everything here is a native Spark
expression (whole-stage codegen), except the similarity ratio, which is an
Arrow-batched pandas UDF applied to pre-filtered candidate pairs only."""

from tallyspark.functions.clean import (  # noqa: F401
    collapse_ws,
    is_blank,
    keep_numeric_chars,
    blank_to_null,
    to_number,
    round_half_even_2,
    negate,
    parse_date,
    parse_timestamp_day,
    na_tokens_to_null,
)
from tallyspark.functions.identity import amount_text, date_text, row_id  # noqa: F401
