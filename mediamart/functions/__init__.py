from mediamart.functions.columns import (  # noqa: F401
    blank_to,
    decade_of,
    empty_to,
    first_or,
    first_or_null,
    int_div,
    null_to,
    out_of_range,
    readable_size,
    split_list,
    split_list_or_empty,
    to_float,
    to_int,
)
