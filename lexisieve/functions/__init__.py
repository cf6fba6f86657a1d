from lexisieve.functions.text import (
    alnum_count,
    distinct_tokens,
    lower_ascii,
    lower_ascii_py,
    query_tokens,
    tokens,
)

__all__ = ["alnum_count", "distinct_tokens", "lower_ascii", "lower_ascii_py", "query_tokens", "tokens"]
