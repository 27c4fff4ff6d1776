"""Text inputs as typed DataFrames."""

from .text import (
    named,
    parse_adjacency,
    parse_businesses,
    parse_profiles,
    parse_reviews,
    read_adjacency,
    read_businesses,
    read_lines,
    read_profiles,
    read_reviews,
    well_formed,
)

__all__ = [
    "named",
    "parse_adjacency",
    "parse_businesses",
    "parse_profiles",
    "parse_reviews",
    "read_adjacency",
    "read_businesses",
    "read_lines",
    "read_profiles",
    "read_reviews",
    "well_formed",
]
