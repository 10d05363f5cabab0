"""Scalar text functions of the engine, all built from native expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Lengths at which names, keys, tool outputs and scanned texts are cut.
NAME_CUT, KEY_CUT, TOOL_CUT, SCAN_LIMIT = 180, 120, 1000, 4000
#: White space of Python's str.split and str.strip, as a pattern and as characters.
SPACE = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(x: Column) -> Column:
    """Only the ends of a text are read."""
    return F.trim(x, F.lit(SPACES))


def folded(x: Column) -> Column:
    """Lower case, runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), rf"{SPACE}+", " "))


def without_space(x: Column) -> Column:
    """Thinking tags, spaces, tabs and line ends removed."""
    return F.translate(F.replace(F.replace(x, F.lit("<think>"), F.lit("")), F.lit("</think>"), F.lit("")), " \n\r\t", "")


def scan_trim(x: Column, limit: int = SCAN_LIMIT) -> Column:
    """Both ends of a text that is longer than limit."""
    half = F.lit(limit // 2)
    return F.when(F.length(x) <= limit, x).otherwise(F.concat(F.left(x, half), F.lit("\n"), F.right(x, half)))


def file_name(key: Column) -> Column:
    return F.left(F.translate(key, ":/\\<>|", "______"), F.lit(NAME_CUT))


def session_key_text(x: Column) -> Column:
    return F.translate(x, ":/\\", "___")


def sidecar_segment(x: Column) -> Column:
    """A source name as one safe path segment."""
    parts = F.filter(F.split(F.translate(x, ":|/\\<>", "______"), "_"), lambda p: (p != "") & (p != ".."))
    return F.when(F.size(parts) == 0, "unsafe").otherwise(F.array_join(parts, "_"))


def byte_size(n: Column) -> Column:
    out = F.when(n >= 1 << 30, F.format_string("%.1f GiB", F.bround(n / float(1 << 30), 1))).when(n >= 1 << 20, F.format_string("%.1f MiB", F.bround(n / float(1 << 20), 1)))
    return out.when(n >= 1 << 10, F.format_string("%.1f KiB", F.bround(n / 1024.0, 1))).otherwise(F.concat(n.cast("string"), F.lit(" B")))


def rounded(x: Column, places: int) -> Column:
    """x times 10^places as a whole number, half to even by x's exact binary value as Python rounds; for 0 <= x < 2^20, 4 places at most."""
    unit, one = F.lit(1 << 25), 1 << 75
    parts = [x * unit]
    for _ in range(2):
        parts.append((parts[-1] - F.floor(parts[-1])) * unit)
    # x in units of 2^-75, exactly; what is smaller is far from any half
    high, middle, low = (F.floor(p).cast("decimal(38,0)") for p in parts)
    scaled = ((high * F.lit(Decimal(1 << 50)) + middle * F.lit(Decimal(1 << 25)) + low) * F.lit(Decimal(10**places))).cast("decimal(38,0)")
    whole = F.call_function("div", scaled, F.lit(Decimal(one)))
    rest = scaled - whole.cast("decimal(12,0)") * F.lit(Decimal(one))
    return F.when((rest * 2 > F.lit(Decimal(one))) | ((rest * 2 == F.lit(Decimal(one))) & (whole % 2 == 1)), whole + 1).otherwise(whole)


def percent(part: Column, whole: Column) -> Column:
    tenths = rounded(part * 100.0 / F.when(whole > 0, whole), 1)
    return F.when(whole > 0, F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"), F.lit("%"))).otherwise("—")


def table_cell(x: Column) -> Column:
    return F.coalesce(F.replace(x, F.lit("|"), F.lit("\\|")), F.lit("—"))


def safe_member(name: Column) -> Column:
    """Whether an archive member may be read: a relative .jsonl path without parent segments."""
    path = F.replace(name, F.lit("\\"), F.lit("/"))
    return (name != "") & ~name.contains("\x00") & name.endswith(".jsonl") & ~path.startswith("/") & (F.substring(name, 2, 1) != ":") & ~F.array_contains(F.split(path, "/"), "..")


def working_directory(x: Column) -> Column:
    """The path inside the first <cwd> tag, else null."""
    found = F.regexp_extract(x, r"(?i)<cwd>\s*([^<]+?)\s*</cwd>", 1)
    return F.when(found != "", strip(found))
