"""Column functions shared by sources, operators and plans."""

from .scalars import (
    address_label,
    age_years,
    id_set_intersection,
    joined_text,
    larger_id,
    list_length,
    parse_dob,
    person_label,
    smaller_id,
    split_fields,
    to_float,
    to_integer,
    yyyymmdd,
)

__all__ = [
    "address_label",
    "age_years",
    "id_set_intersection",
    "joined_text",
    "larger_id",
    "list_length",
    "parse_dob",
    "person_label",
    "smaller_id",
    "split_fields",
    "to_float",
    "to_integer",
    "yyyymmdd",
]
