"""Column helpers (scalar functions used inside the operators).

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; none is a Python UDF.  Time helpers work on TIMESTAMP_NTZ values and
on epoch arithmetic so that the session time zone never changes a result.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

# ---------------------------------------------------------------------------
# Fixed values (formats and markers that must stay exactly as they are)
# ---------------------------------------------------------------------------
#: text format of load times, cutoffs and modification times
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
#: the same format for Python's strftime / strptime
PY_TIME_FORMAT = "%Y-%m-%d %H:%M:%S"
#: directory value Spark writes for a NULL partition value
NULL_PARTITION_DIR = "__HIVE_DEFAULT_PARTITION__"
#: sub-folders of the default-location rule: staging schemas, then the rest
STAGING_SUBDIR = "stg"
PUBLIC_SUBDIR = "pa"
#: default table lifetime in days and default target file size in blocks
DEFAULT_LIFETIME_DAYS = 730
DEFAULT_BLOCKS_PER_FILE = 1.85
DEFAULT_BLOCK_BYTES = 128 * 1024 * 1024

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def java_quote(text: str) -> str:
    """Quote text for literal use inside a Java regular expression."""
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


# F1 ------------------------------------------------------------------------
def partition_value(path: Column | str, key: str) -> Column:
    """Value of ``key`` in a ``.../key=value/...`` path; NULL when absent.

    The raw directory text is returned (still path-escaped); use
    :func:`unescape_partition_value` for the logical value.
    """
    pattern = "/" + java_quote(key) + "=([^/]*)"
    p = _col(path)
    return F.when(p.rlike(pattern), F.regexp_extract(p, pattern, 1))


def unescape_partition_value(raw: Column | str) -> Column:
    """Directory text of one partition value -> logical value (NULL marker aware).

    Spark writes special characters as ``%XX``; a literal ``+`` is kept, so it is
    protected before URL decoding.  Malformed escapes are kept as they are.
    """
    r = _col(raw)
    decoded = F.try_url_decode(F.replace(r, F.lit("+"), F.lit("%2B")))
    return F.when(r == F.lit(NULL_PARTITION_DIR), F.lit(None).cast("string")).otherwise(
        F.coalesce(decoded, r))


# F2 ------------------------------------------------------------------------
def partition_spec_map(text: Column | str) -> Column:
    """``k1=v1/k2=v2`` (catalog / directory text) -> ``map<string,string>``."""
    m = F.str_to_map(_col(text), F.lit("/"), F.lit("="))
    return F.transform_values(m, lambda _k, v: unescape_partition_value(v))


# F3 ------------------------------------------------------------------------
def default_location(table_name: Column | str, schema_prefix: str, root: str) -> Column:
    """Default storage path for ``<prefix><schema>.<table>`` names.

    ``<prefix><schema>_stg.<table>`` -> ``<root>/<schema>/stg/<table>``;
    ``<prefix><schema>.<table>``     -> ``<root>/<schema>/pa/<table>``;
    anything else                    -> ``''``.
    """
    name = _col(table_name)
    root = root.rstrip("/")
    stg = "^" + java_quote(schema_prefix) + "(.*)_stg\\.(.*)$"
    pub = "^" + java_quote(schema_prefix) + "(.*)\\.(.*)$"

    def build(pattern: str, sub: str) -> Column:
        return F.concat(F.lit(root + "/"), F.regexp_extract(name, pattern, 1),
                        F.lit(f"/{sub}/"), F.regexp_extract(name, pattern, 2))

    return (F.when(name.rlike(stg), build(stg, STAGING_SUBDIR))
            .when(name.rlike(pub), build(pub, PUBLIC_SUBDIR))
            .otherwise(F.lit("")))


# F4 ------------------------------------------------------------------------
def json_map(text: Column | str) -> Column:
    """JSON object text (single or double quotes) -> ``map<string,string>``.

    Quotes are understood by the JSON reader itself, so apostrophes inside
    double-quoted values survive; non-object text gives NULL.
    """
    return F.from_json(_col(text), "map<string,string>", {"allowSingleQuotes": "true"})


# F5 ------------------------------------------------------------------------
def map_default(m: Column | str, key, default) -> Column:
    """``m[key]`` or ``default`` when the key is missing or the map is NULL."""
    return F.coalesce(F.try_element_at(_col(m), _lit(key)), _lit(default))


# F6 ------------------------------------------------------------------------
def step_number(name: Column | str) -> Column:
    """The single run of digits in a name as int; raises if there is not exactly one."""
    n = _col(name)
    runs = F.regexp_extract_all(n, F.lit(r"(\d+)"), 1)
    return F.when(F.size(runs) == 1, runs.getItem(0).cast("int")).otherwise(
        F.raise_error(F.concat(F.lit("expected exactly one number in name: "),
                               F.coalesce(n, F.lit("NULL")))))


# F7 ------------------------------------------------------------------------
def safe_cast(c: Column | str, type_name: str | DataType) -> Column:
    """Cast to a type named by string; values that do not fit become NULL."""
    return _col(c).try_cast(type_name)


# F8 ------------------------------------------------------------------------
def date_text(c: Column | str, length: int = 10) -> Column:
    """First ``length`` characters (``yyyy-MM-dd`` of a longer time text)."""
    return _col(c).cast("string").substr(1, length)


# F9 ------------------------------------------------------------------------
def retention_cutoff(now_text: Column | str, days) -> Column:
    """``now - days`` (calendar days, no time zone) formatted as TIME_FORMAT."""
    ts = F.to_timestamp_ntz(_col(now_text))
    return F.date_format(F.timestamp_add("DAY", -_lit(days), ts), TIME_FORMAT)


def now_text() -> str:
    """The current UTC time as TIME_FORMAT text (a run's load time)."""
    return _dt.datetime.now(_dt.timezone.utc).strftime(PY_TIME_FORMAT)


def cutoff_text(now: str | None, days: int) -> str:
    """Driver-side twin of :func:`retention_cutoff` for a scalar parameter
    (``now`` defaults to the current UTC time)."""
    start = _dt.datetime.strptime(now or now_text(), PY_TIME_FORMAT)
    return (start - _dt.timedelta(days=days)).strftime(PY_TIME_FORMAT)


# F10 -----------------------------------------------------------------------
def epoch_text(millis: Column | str) -> Column:
    """Epoch milliseconds -> UTC wall-clock text, independent of the session zone."""
    return F.date_format(F.timestamp_add("MILLISECOND", _col(millis), F.expr(_EPOCH_NTZ)),
                         TIME_FORMAT)


def ntz_epoch_millis(ts: Column | str) -> Column:
    """TIMESTAMP_NTZ (read as UTC wall clock) -> epoch milliseconds."""
    return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH_NTZ), _col(ts))


def instant_text(ts: Column | str) -> Column:
    """TIMESTAMP (an instant, e.g. a file mtime) -> UTC text."""
    return epoch_text(F.unix_millis(_col(ts)))


# F11 -----------------------------------------------------------------------
def file_factor(size_bytes: Column | str, block_bytes: int = DEFAULT_BLOCK_BYTES,
                blocks_per_file: float = DEFAULT_BLOCKS_PER_FILE) -> Column:
    """Target file count: ``bytes // (block * blocks_per_file) + 1``; 0 when empty."""
    b = _col(size_bytes)
    per_file = float(block_bytes) * float(blocks_per_file)
    return (F.when(b == 0, F.lit(0).cast("bigint"))
            .otherwise(F.floor(b / F.lit(per_file)).cast("bigint") + 1))


# F12 -----------------------------------------------------------------------
def change_flag(load_time: Column | str, last_modified: Column | str,
                force: Column | bool | int, rows: Column | str) -> Column:
    """``int((load_time < last_modified or force) and rows > 0)``; no mtime = unchanged."""
    newer = F.coalesce(_col(load_time) < _col(last_modified), F.lit(False))
    forced = _lit(force).cast("boolean")
    return ((newer | F.coalesce(forced, F.lit(False))) & (_col(rows) > 0)).cast("int")


# F13 -----------------------------------------------------------------------
def statistic_payload(loading_id, entity_id, stat_id, value) -> Column:
    """JSON body ``{loading_id, entity_id, stat_id, avalue: [value]}`` of one statistic."""
    return F.to_json(F.struct(
        _lit(loading_id).cast("int").alias("loading_id"),
        _lit(entity_id).cast("int").alias("entity_id"),
        _lit(stat_id).cast("int").alias("stat_id"),
        F.array(_lit(value).cast("string")).alias("avalue"),
    ))
