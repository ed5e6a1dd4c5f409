"""Column functions shared by the operators."""

from tidemark.functions.buckets import first_match, level_label, interval_label
from tidemark.functions.json_text import payload_as_text, prune_json
from tidemark.functions.stats import percent
from tidemark.functions.text import is_bot, is_present, quoted_list, region
from tidemark.functions.time import day_key, floor_hour, hour_key, iso_utc, parse_hour_key, parse_utc

__all__ = [
    "day_key", "first_match", "floor_hour", "hour_key", "interval_label", "is_bot", "is_present",
    "iso_utc", "level_label", "parse_hour_key", "parse_utc", "payload_as_text", "percent", "prune_json",
    "quoted_list", "region",
]
