from tidemark.functions.scalar import is_blank, json_field, json_is_bad, month_number, name_in
from tidemark.functions.text import count_redactions, redact, redact_columns, split_url

__all__ = [
    "count_redactions",
    "is_blank",
    "json_field",
    "json_is_bad",
    "month_number",
    "name_in",
    "redact",
    "redact_columns",
    "split_url",
]
