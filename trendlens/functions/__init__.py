"""Column expressions (F1-F14).  All built-in, JVM-side, inside codegen."""

from .columns import (
    text_length, word_count_single_space, word_count_whitespace, split_pipe,
    split_on, normalize_tag, lower_all, drop_blank, time_part, TIME_PARTS,
    ratio, log1p, parse_publish_time, as_string, decode_json,
)

__all__ = [
    "text_length", "word_count_single_space", "word_count_whitespace", "split_pipe",
    "split_on", "normalize_tag", "lower_all", "drop_blank", "time_part", "TIME_PARTS",
    "ratio", "log1p", "parse_publish_time", "as_string", "decode_json",
]
