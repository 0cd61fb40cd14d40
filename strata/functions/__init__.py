from strata.functions.text import (
    first_filled,
    group_key,
    layer_of,
    or_default,
    parse_keys,
    stripped,
)

__all__ = ["first_filled", "group_key", "layer_of", "or_default", "parse_keys", "stripped"]
