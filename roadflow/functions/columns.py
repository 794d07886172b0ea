"""Column expressions for the reference's per-value helpers. All built-in functions, so
they stay inside whole-stage codegen; none is a Python UDF (U2: no UDF or UDTF is registered)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_trim(c: Column | str) -> Column:
    """Strip leading and trailing characters <= U+0020 (Java ``String.trim``: spaces, tabs, CR, LF and
    other control characters; Spark's ``trim`` strips spaces only) (F2)."""
    return F.btrim(_c(c), F.lit("".join(map(chr, range(0x21)))))


# --- time (R1 R2 R6) -------------------------------------------------------------------------------

def date_hour(ts: Column | str) -> Column:
    """``yyyy-MM-dd_HH``."""
    return F.date_format(_c(ts), "yyyy-MM-dd_HH")


def five_minute_start(ts: Column | str) -> Column:
    """Start of the 5-minute bucket of a timestamp (R2). ``date_trunc`` yields a zoned timestamp; cast
    to ``timestamp_ntz`` for wall-clock input (in a UTC session the value is unchanged)."""
    t = _c(ts)
    return F.timestamp_add("MINUTE", -(F.minute(t) % 5), F.date_trunc("minute", t))


def five_minute_label(start: Column | str) -> Column:
    """``date HH:mm~date HH:mm`` for a bucket start. Where the bucket ends on the hour the end is written
    with the hour plus one on the same date, so 23:55 ends at ``date 24:00`` (the reference's label)."""
    s = _c(start)
    hour_end = F.concat(F.date_format(s, "yyyy-MM-dd "), F.lpad((F.hour(s) + 1).cast("string"), 2, "0"), F.lit(":00"))
    plain_end = F.date_format(F.timestamp_add("MINUTE", F.lit(5), s), "yyyy-MM-dd HH:mm")
    end = F.when(F.minute(s) == 55, hour_end).otherwise(plain_end)
    return F.concat(F.date_format(s, "yyyy-MM-dd HH:mm"), F.lit("~"), end)


def date_key(ts: Column | str) -> Column:
    """``yyyyMMdd``."""
    return F.date_format(_c(ts), "yyyyMMdd")


def minute_key(ts: Column | str) -> Column:
    """``yyyyMMddHHmm``."""
    return F.date_format(_c(ts), "yyyyMMddHHmm")


def parse_time(c: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text -> timestamp_ntz; null when it does not parse (R5 ``parseTime``)."""
    return F.try_to_timestamp(_c(c), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")


def wall_time(c: Column | str) -> Column:
    """Exactly ``yyyy-MM-dd HH:mm:ss`` text -> timestamp_ntz, null for anything else (a date alone, a ``T``, a
    zone, an impossible day). Hour 24 is hour 0 of the next day, as the sightings' source writes it."""
    x = _c(c)
    shape = x.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2} ([01][0-9]|2[0-4]):[0-5][0-9]:[0-5][0-9]$")
    late = F.substring(x, 12, 2) == "24"
    at = parse_time(F.when(late, F.concat(F.substring(x, 1, 11), F.lit("00"), F.substring(x, 14, 6))).otherwise(x))
    return F.when(shape, F.when(late, F.timestamp_add("DAY", F.lit(1), at)).otherwise(at))


def strict_date(c: Column | str) -> Column:
    """Exactly ``yyyy-MM-dd`` text -> date, null for anything else."""
    x = _c(c)
    return F.when(x.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), x.try_cast("date"))


def parse_date_key(c: Column | str) -> Column:
    """``yyyyMMdd`` text -> date; null when it does not parse (R5 ``parseDateKey``)."""
    return F.try_to_timestamp(_c(c), F.lit("yyyyMMdd")).cast("date")


def seconds_between(later: Column | str, earlier: Column | str) -> Column:
    """Whole seconds from ``earlier`` to ``later`` (R3); null when either side is null."""
    return F.timestamp_diff("SECOND", _c(earlier), _c(later))


# --- text (R8 R9 R10 R11) --------------------------------------------------------------------------

def fixed_width(c: Column | str, width: int) -> Column:
    """Left-pad with ``0`` to ``width``; longer values stay whole (plain ``lpad`` would cut them)."""
    x = _c(c)
    return F.when(F.length(x) < width, F.lpad(x, width, "0")).otherwise(x)


def pad_single(c: Column | str) -> Column:
    """One-argument form of R8: only a one-character value gets a leading ``0``."""
    x = _c(c)
    return F.when(F.length(x) == 1, F.concat(F.lit("0"), x)).otherwise(x)


def trim_comma(c: Column | str) -> Column:
    """Drop one leading and one trailing comma."""
    return F.regexp_replace(_c(c), "^,|,$", "")


def _single_char(delimiter: str) -> str | None:
    """The literal character a delimiter regex stands for (``\\|`` -> ``|``, ``,`` -> ``,``), or None
    when it is a longer or real pattern."""
    if len(delimiter) == 1 and delimiter not in ".^$*+?()[]{}|\\":
        return delimiter
    if len(delimiter) == 2 and delimiter[0] == "\\" and not delimiter[1].isalnum():
        return delimiter[1]
    return None


def _cls(ch: str) -> str:
    """``ch`` escaped for use inside a regex character class."""
    return "\\" + ch if ch in "]\\^-[" else ch


def _entries(c: Column, delimiter: str) -> Column:
    """Entries of a packed ``k=v<delim>k=v`` text, with trailing empty entries dropped as Java's split
    does. ``delimiter`` is a regular expression, as in the reference."""
    stripped = F.regexp_replace(c, f"(?:{delimiter})+$", "")
    return F.split(stripped, delimiter)


def _pair_pattern(ch: str, field: str | None = None) -> str:
    """One well-formed entry between delimiters ``ch``: name ``=`` non-empty value, trailing ``=`` allowed
    (the entries Java's ``split("=")`` cuts into exactly two parts). Group 1 name, group 2 value."""
    c = _cls(ch)
    name = re.escape(field) if field is not None else f"([^{c}=]*)"
    return f"(?:^|{re.escape(ch)}){name}=([^{c}=]+)=*(?={re.escape(ch)}|$)"


def _pairs(c: Column, delimiter: str) -> Column:
    """Entries that split on ``=`` into exactly two parts once trailing ``=`` are dropped (``k=`` and
    ``a=b=c`` are skipped, ``a=1=`` is kept as ``a -> 1``)."""
    return kv_pairs_of(_entries(c, delimiter))


def kv_pairs_of(entries: Column | str) -> Column:
    """``[key, value]`` arrays of the well-formed entries of an entries array (see ``_pairs``)."""
    parts = F.transform(_c(entries), lambda e: F.split(F.rtrim(e, F.lit("=")), "="))
    return F.filter(parts, lambda a: F.size(a) == 2)


def kv_map_of(pairs: Column | str) -> Column:
    """Map from ``kv_pairs_of`` output; last duplicate wins (LAST_WIN dedup policy)."""
    return F.map_from_entries(F.transform(_c(pairs), lambda a: F.struct(a[0].alias("k"), a[1].alias("v"))))


def kv_first_of(pairs: Column | str, field: str) -> Column:
    """Value of the first pair named ``field`` from ``kv_pairs_of`` output; null when absent."""
    hits = F.filter(_c(pairs), lambda a: a[0] == F.lit(field))
    return F.try_element_at(hits, F.lit(1))[1]


def kv_map(c: Column | str, delimiter: str = r"\|") -> Column:
    """All key=value entries as a map; a repeated key keeps its last value (R9). Needs
    ``spark.sql.mapKeyDedupPolicy=LAST_WIN`` (set by ``roadflow.session.configure``).

    A one-character delimiter uses two codegen'd ``regexp_extract_all`` calls; other delimiters use the
    general split path."""
    ch = _single_char(delimiter)
    if ch is None:
        return kv_map_of(_pairs(_c(c), delimiter))
    pat = F.lit(_pair_pattern(ch))
    return F.map_from_arrays(F.regexp_extract_all(_c(c), pat, F.lit(1)), F.regexp_extract_all(_c(c), pat, F.lit(2)))


def kv_field(c: Column | str, field: str, delimiter: str = r"\|") -> Column:
    """Value of the first entry named ``field``; null when absent."""
    ch = _single_char(delimiter)
    if ch is None:
        return kv_first_of(_pairs(_c(c), delimiter), field)
    # the value group is non-empty by construction, so an empty extract means "absent"
    return F.nullif(F.regexp_extract(_c(c), _pair_pattern(ch, field), 1), F.lit(""))


def kv_entries(c: Column | str, delimiter: str = r"\|") -> Column:
    """The entries array of a packed text (trailing empty entries dropped). Project it once into a column
    when several helpers below read it, so each row is split once."""
    return _entries(_c(c), delimiter)


def kv_position(entries: Column | str, field: str) -> Column:
    """1-based index of the first entry named ``field`` (0 when absent; F7 ``array_position``)."""
    return F.array_position(F.transform(_c(entries), lambda x: F.substring_index(x, "=", 1)), F.lit(field))


def kv_replace_at(entries: Column | str, pos: Column | str, field: str, value: Column | str) -> Column:
    """Entries re-joined with ``|``, the one at ``pos`` (if > 0) replaced by ``field=value``."""
    e, p = _c(entries), _c(pos)
    v = F.lit(value) if isinstance(value, str) else value
    new = F.concat(F.lit(field + "="), v.cast("string"))
    before = F.slice(e, F.lit(1), F.greatest(p - 1, F.lit(0)).cast("int"))
    after = F.slice(e, (p + 1).cast("int"), F.greatest(F.size(e) - p, F.lit(0)).cast("int"))
    return F.when(p > 0, F.concat_ws("|", before, new, after)).otherwise(F.array_join(e, "|"))


def kv_set_entries(entries: Column | str, field: str, value: Column | str) -> Column:
    """``kv_set`` on an already split entries array."""
    return kv_replace_at(entries, kv_position(entries, field), field, value)


def kv_set(c: Column | str, field: str, value: Column | str, delimiter: str = r"\|") -> Column:
    """Replace the first entry named ``field`` by ``field=value``; others unchanged; always re-joined with
    ``|`` (R10). An entry's name is its text before the first ``=``.

    With the ``|`` delimiter this is one anchored ``regexp_replace`` (codegen'd): the lazy prefix stops at
    the first entry named ``field``. Other delimiters use array slices around the first match."""
    ch = _single_char(delimiter)
    v = F.lit(value) if isinstance(value, str) else value
    if ch != "|":  # other delimiters are re-joined with "|", which the slice path does entry by entry
        return kv_set_entries(kv_entries(c, delimiter), field, v)
    d, cl = re.escape(ch), _cls(ch)
    stripped = F.regexp_replace(_c(c), f"(?:{d})+$", "")
    pattern = f"^((?:[^{cl}]*{d})*?){re.escape(field)}(?:=[^{cl}]*)?(?={d}|$)"
    # the new value goes through the replacement string: escape its $ and backslashes
    safe = F.regexp_replace(v.cast("string"), r"([\\$])", r"\\$1")
    field_text = field.replace("\\", "\\\\").replace("$", "\\$")
    replaced = F.regexp_replace(stripped, F.lit(pattern), F.concat(F.lit("$1" + field_text + "="), safe))
    return replaced
