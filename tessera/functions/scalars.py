"""Scalar column functions: buckets, labels, time, formatting, boxes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values that must equal the reference's output -------------------
# Four-way age groups of the MapReduce pivot: under 18, up to 35, up to 50,
# older.
AGE_GROUPS_4 = ["0-18", "18-35", "35-50", "50+"]
# Seven-way age groups of the RDD job: under 18, <=24, <=34, <=44, <=49,
# <=55, older. The last label says "over 56" but every age > 55 gets it.
AGE_GROUPS_7 = ["Duoi 18", "18-24", "25-34", "35-44", "45-49", "50-55", "Tren 56"]
# Gender labels: M and F are renamed, any other value is shown unchanged.
GENDER_LABELS = {"M": "Nam (M)", "F": "Nu (F)"}
# Box fields written per detection, in output order.
BOX_FIELDS = ["x1", "y1", "x2", "y2", "confidence"]
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# -----------------------------------------------------------------------------

BOX_TYPE = T.StructType(
    [
        T.StructField("x1", T.IntegerType()),
        T.StructField("y1", T.IntegerType()),
        T.StructField("x2", T.IntegerType()),
        T.StructField("y2", T.IntegerType()),
        T.StructField("confidence", T.DoubleType()),
    ]
)
BOXES_TYPE = T.ArrayType(BOX_TYPE)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def age_group_4(age: str | Column) -> Column:
    a = _col(age)
    return (
        F.when(a < 18, AGE_GROUPS_4[0])
        .when(a <= 35, AGE_GROUPS_4[1])
        .when(a <= 50, AGE_GROUPS_4[2])
        .when(a.isNotNull(), AGE_GROUPS_4[3])
    )


def age_group_7(age: str | Column) -> Column:
    a = _col(age)
    return (
        F.when(a < 18, AGE_GROUPS_7[0])
        .when(a <= 24, AGE_GROUPS_7[1])
        .when(a <= 34, AGE_GROUPS_7[2])
        .when(a <= 44, AGE_GROUPS_7[3])
        .when(a <= 49, AGE_GROUPS_7[4])
        .when(a <= 55, AGE_GROUPS_7[5])
        .when(a.isNotNull(), AGE_GROUPS_7[6])
    )


def gender_label(g: str | Column) -> Column:
    """Case-sensitive rename of M / F; other values pass through."""
    x = _col(g)
    expr = None
    for raw, label in GENDER_LABELS.items():
        expr = (F.when(x == raw, label) if expr is None else expr.when(x == raw, label))
    return expr.otherwise(x)


def is_male(g: str | Column) -> Column:
    """``equalsIgnoreCase("M")``: the pivot counts anything else as female."""
    return F.upper(_col(g)) == F.lit("M")


def calendar_year(ts: str | Column, dtype: T.DataType | None = None) -> Column:
    """Year of an instant. Numbers are epoch seconds (UTC when the session
    time zone is UTC); timestamps are used as they are."""
    c = _col(ts)
    if isinstance(dtype, T.NumericType):
        return F.year(F.timestamp_seconds(c))
    return F.year(c)


def epoch_seconds(ts: str | Column) -> Column:
    """Timestamp (with or without zone) to epoch seconds as a double.

    ``timestamp_ntz`` values are read as UTC wall-clock instants (the
    session zone is UTC).
    """
    return F.unix_micros(F.to_timestamp(_col(ts))) / F.lit(1_000_000.0)


def local_datetime(epoch: str | Column, zone: str) -> Column:
    """Epoch seconds to ``yyyy-MM-dd HH:mm:ss`` wall time in ``zone``
    (a region id or a fixed offset such as ``+07:00``). Fractions are cut,
    as ``strftime`` does."""
    inst = F.timestamp_micros(F.floor(_col(epoch) * F.lit(1_000_000)).cast("long"))
    return F.date_format(F.from_utc_timestamp(inst, zone), DATETIME_FORMAT)


def ellipsis(title: str | Column, max_len: int = 38, keep: int = 35) -> Column:
    """Titles longer than ``max_len`` become the first ``keep`` chars + '...'."""
    t = _col(title)
    return F.when(F.length(t) > max_len, F.concat(F.substring(t, 1, keep), F.lit("..."))).otherwise(t)


def pad_right(c: str | Column, width: int) -> Column:
    """``%-Ns``: pad to ``width``, never truncate."""
    x = _col(c)
    return F.when(F.length(x) >= width, x).otherwise(F.rpad(x, width, " "))


def fixed2(c: str | Column, na: str = "N/A") -> Column:
    """``%.2f`` (HALF_UP), with ``na`` for null (Java would print "nu")."""
    x = _col(c)
    return F.when(x.isNull(), F.lit(na)).otherwise(F.format_string("%.2f", x))


def round_half_even(c: str | Column, digits: int) -> Column:
    """Python's ``round(x, n)`` (banker's rounding), e.g. for ``process_ms``."""
    return F.bround(_col(c), digits)


def truncate_int(c: str | Column) -> Column:
    """Python's ``int(x)`` for a float coordinate: drop the fraction."""
    return _col(c).cast("int")


def json_field(c: str | Column, path: str, default: Column | None = None) -> Column:
    """``json.loads(s).get(k, default)`` for one scalar field."""
    v = F.get_json_object(_col(c), path)
    return v if default is None else F.coalesce(v, default)


def boxes_json(boxes: str | Column) -> Column:
    """Encode a box array the way Python's ``json.dumps`` writes it:
    ``[{"x1": 1, "y1": 2, "x2": 3, "y2": 4, "confidence": 0.5}]``."""

    def one(b: Column) -> Column:
        parts = []
        for name in BOX_FIELDS:
            parts.append(F.lit(f'"{name}": '))
            parts.append(b[name].cast("string"))
            parts.append(F.lit(", "))
        return F.concat(F.lit("{"), *parts[:-1], F.lit("}"))

    return F.concat(F.lit("["), F.array_join(F.transform(_col(boxes), one), ", "), F.lit("]"))


def parse_boxes_json(c: str | Column) -> Column:
    """Decode a ``boxes_json`` column back to ``array<struct>``."""
    return F.from_json(_col(c), BOXES_TYPE)
