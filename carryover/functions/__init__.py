"""Driver-side helpers over names and check results (no data passes through here)."""

from .names import (
    is_plain_identifier,
    path_stem,
    path_table_name,
    qualify,
    quote_ident,
    quote_ref,
    split_ref,
    sql_string,
    target_table_name,
)
from .truth import judge

__all__ = [
    "is_plain_identifier",
    "judge",
    "path_stem",
    "path_table_name",
    "qualify",
    "quote_ident",
    "quote_ref",
    "split_ref",
    "sql_string",
    "target_table_name",
]
