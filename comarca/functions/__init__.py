from comarca.functions.labels import code_to_label, indicator
from comarca.functions.numbers import leading_int, per_unit, to_int
from comarca.functions.text import contains_any, has_prefix, repair_text, strip_code

__all__ = [
    "code_to_label",
    "contains_any",
    "has_prefix",
    "indicator",
    "leading_int",
    "per_unit",
    "repair_text",
    "strip_code",
    "to_int",
]
