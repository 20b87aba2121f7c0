from lakeloom.functions.keys import any_null, changed, key_match
from lakeloom.functions.types import schema_from_columns, type_from_name

__all__ = ["any_null", "changed", "key_match", "schema_from_columns", "type_from_name"]
