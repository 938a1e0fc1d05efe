from talmir.sources.text import (
    parse_labelled_points,
    parse_points,
    parse_ratings,
    partition_into,
    read_labelled_points,
    read_lines,
    read_points,
    read_ratings,
    split_bad_labelled_points,
    split_bad_points,
    split_bad_ratings,
    write_result,
)

__all__ = [
    "parse_labelled_points",
    "parse_points",
    "parse_ratings",
    "partition_into",
    "read_labelled_points",
    "read_lines",
    "read_points",
    "read_ratings",
    "split_bad_labelled_points",
    "split_bad_points",
    "split_bad_ratings",
    "write_result",
]
