"""Path, name and text helpers (operators B2, B4-B9, B11, J1, B3).

Column in, Column out; nothing here leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opslog.functions.fmt import WHITESPACE, strftime_to_spark, strip


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def expand_home(col, home: str) -> Column:
    """B2: a leading ``~`` (alone or before ``/``) becomes the home directory."""
    return F.regexp_replace(_c(col), r"^~(?=/|$)", home.replace("\\", "\\\\").replace("$", "\\$"))


def base_name(col) -> Column:
    """Last path component; trailing slashes are ignored."""
    return F.substring_index(F.rtrim(_c(col), F.lit("/")), "/", -1)


def dir_name(col) -> Column:
    """Everything before the last ``/`` ('' for a bare name)."""
    c = _c(col)
    return F.regexp_extract(c, r"^(.*)/[^/]*$", 1)


# Archive time stamp layout in file names.
ARCHIVE_TIME_FORMAT = "%Y-%m-%d_%H%M"


def archive_ext(kind, codec=None) -> Column:
    """``tar`` / ``tar.<codec>``, ``zip``, ``rar``."""
    k = _c(kind)
    cd = _c(codec) if codec is not None else F.lit(None).cast("string")
    return (F.when(k == "tar", F.when(cd.isNull(), F.lit("tar")).otherwise(F.concat(F.lit("tar."), cd)))
            .when(k == "zip", F.lit("zip"))
            .when(k == "rar", F.lit("rar")))


def archive_name(dest, group, directory, ts, ext) -> Column:
    """``dest/group/name/name_<yyyy-MM-dd_HHmm>.ext`` with name the base name of the directory."""
    name = base_name(directory)
    stamp = F.date_format(_c(ts), strftime_to_spark(ARCHIVE_TIME_FORMAT))
    d = _c(dest) if not isinstance(dest, str) else F.lit(dest)
    e = _c(ext) if not isinstance(ext, str) else F.lit(ext)
    return F.concat(F.concat_ws("/", d, _c(group), name, F.concat(name, F.lit("_"), stamp)), F.lit("."), e)


def slot_name(base, slot) -> Column:
    """The ``n``-th free name for an archive: the base itself, then ``_01``, ``_02`` ...."""
    s = _c(slot)
    return F.when(s == 0, _c(base)).otherwise(F.concat(_c(base), F.lit("_"), F.format_string("%02d", s)))


def upload_key(group, directory, archive) -> Column:
    """``group/basename(directory)/basename(archive)``."""
    return F.concat_ws("/", _c(group), base_name(directory), base_name(archive))


def strip_base(col, base: str) -> Column:
    """Remove every occurrence of ``base`` from the path, then the first character."""
    return F.substring(F.replace(_c(col), F.lit(base), F.lit("")), 2, 1 << 30)


# Runs of white space as Python's str.split() sees it.
_BLANKS = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in WHITESPACE) + "]+"


def argv(col) -> Column:
    """Split a command line on runs of whitespace, dropping empty pieces."""
    return F.filter(F.split(_c(col), _BLANKS), lambda x: x != "")


def output_lines(col) -> Column:
    """B10 helper: captured output stripped, then split on newlines; null stays null, '' gives none."""
    s = strip(col)
    return F.when(s.isNull(), F.lit(None)).when(s == "", F.array().cast("array<string>")).otherwise(F.split(s, "\n"))


def map_overlay(base, over) -> Column:
    """Merge two maps, the right side wins per key; a null right side keeps the base.

    Key order follows a dict update: base keys first (with replaced values), then new keys.
    """
    b, o = _c(base), _c(over)
    updated = F.transform(F.map_entries(b), lambda e: F.struct(
        e["key"].alias("key"),
        F.when(F.array_contains(F.map_keys(o), e["key"]), F.try_element_at(o, e["key"]))
         .otherwise(e["value"]).alias("value")))
    added = F.filter(F.map_entries(o), lambda e: ~F.array_contains(F.map_keys(b), e["key"]))
    return F.when(o.isNull(), b).otherwise(F.map_from_entries(F.concat(updated, added)))


def nested_get(json_col, path: str) -> Column:
    """Dotted access into JSON text; a missing step, a non-object step or '' gives null."""
    if not path:
        return F.lit(None).cast("string")
    steps = path.split(".")
    if any(s == "" for s in steps):
        return F.lit(None).cast("string")
    jp = "$" + "".join(f"['{s}']" for s in steps)
    return F.get_json_object(_c(json_col), jp)
