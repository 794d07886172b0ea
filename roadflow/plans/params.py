"""Parameters the registered queries run with (run date as a literal so results repeat)."""

RUN_DATE = "2024-02-01"
TOP_N = 5
# Day slice (R7): the day before this run date.
SLICE_RUN_DATE = "1998-06-02"
# Time-range filter (R4), strict on both ends.
RANGE_LO = "1998-01-01 00:00:00"
RANGE_HI = "1998-12-31 12:00:00"
# Streaming windows over flow_events (one event about every 4 minutes at sf0.01): 2 h size, 1 h slide.
WINDOW_SIZE_H = 2
WINDOW_SLIDE_H = 1
# Streaming local prefix for the running totals (city prefix, D21).
STREAM_LOCAL_PREFIX = "黑A"
