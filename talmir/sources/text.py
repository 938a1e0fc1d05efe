"""Line-oriented text sources, their parsers, and the Parquet sink.

Each parser has two modes. ``parse_*`` is strict: one malformed line fails the job.
``split_bad_*`` returns the parsed rows and, beside them, the lines it rejected. Each of
the two reads the source when it is used; with ``once`` the lines are parsed when the function is
called, in one pass, and both outputs are kept in the shared folder (Parquet, one folder each).
Columns other than the text column are carried through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talmir.functions import require
from talmir.session import new_path

# Fixed values of the file formats: field counts, separators and white space.
RATING_FIELDS = 4
COMMA = ","
ASCII_SPACE_RUN = r"[\t-\r\x1c-\x20]+"
OTHER_SPACES = (
    "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line: ``value``. Line ends and a leading byte-order mark are dropped."""
    return spark.read.text(path)


def partition_into(df: DataFrame, n: int) -> DataFrame:
    """The same rows in exactly n evenly filled partitions."""
    return df.repartition(n)


def write_result(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a result as Parquet, one file per partition."""
    df.write.mode(mode).parquet(path)


def _doubles(texts: Column) -> Column:
    """As numbers, with NULL for a text that is none."""
    return texts.try_cast("array<double>")


def _complete(numbers: Column) -> Column:
    """At least one number, and all of them finite (NaN is above every number here)."""
    finite = lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False))
    return (F.size(numbers) > 0) & F.forall(numbers, finite)


class _Format:
    """How a line becomes columns.

    ``parse`` does the costly part, once per line. ``valid`` and ``columns`` refer to what it
    returns by name.
    """

    def __init__(self, parse, valid: Callable[[], Column], columns: Callable[[], dict]):
        self.parse, self.valid, self.columns = parse, valid, columns


def _rating_columns() -> dict[str, Column]:
    fields = F.col("_fields")
    return {
        "product": F.get(fields, F.lit(0)),
        "user": F.get(fields, F.lit(1)),
        "rating": F.get(fields, F.lit(2)).try_cast("double"),
        "ts": F.get(fields, F.lit(3)).try_cast("bigint"),
    }


def _is_rating() -> Column:
    # A rating must have a whole part; NaN and infinities have none.
    in_range = F.abs(_rating_columns()["rating"]) < F.lit(2.0**63)
    return (F.size("_fields") == RATING_FIELDS) & in_range


def _parse_labelled_point(text: Column) -> dict[str, Column]:
    fields = F.split(text, COMMA, -1)
    return {
        "point": _doubles(F.slice(fields, 1, F.size(fields) - 1)),
        "cluster": F.substring_index(text, COMMA, -1).try_cast("int"),
    }


def _parse_point(text: Column) -> dict[str, Column]:
    # Nearly all lines are ASCII, for which a look at two lengths is enough.
    ascii_only = F.length(text) == F.octet_length(text)
    spaces = F.translate(text, OTHER_SPACES, " " * len(OTHER_SPACES))
    fields = F.split(F.when(ascii_only, text).otherwise(spaces), ASCII_SPACE_RUN, -1)
    # Surrounding white space leaves an empty text at either end.
    return {"point": _doubles(F.array_remove(fields, ""))}


# Plain commas: quotes are ordinary characters here, so no CSV reader.
RATING = _Format(lambda text: {"_fields": F.split(text, COMMA, -1)}, _is_rating, _rating_columns)
LABELLED_POINT = _Format(
    _parse_labelled_point,
    lambda: F.col("cluster").isNotNull() & _complete(F.col("point")),
    lambda: {"point": F.col("point"), "cluster": F.col("cluster")},
)
POINT = _Format(
    _parse_point, lambda: _complete(F.col("point")), lambda: {"point": F.col("point")}
)


def _parsed(lines: DataFrame, column: str, line: _Format) -> DataFrame:
    # Through a generator of one row, as a filter on its columns is not pushed below it.
    # So each line is parsed once, and checked even where only some columns are used.
    values = line.parse(F.col(column))
    row = F.struct(*[value.alias(name) for name, value in values.items()])
    return lines.select("*", F.inline(F.array(row)))


def _columns(lines: DataFrame, column: str, line: _Format) -> list[Column]:
    kept = [F.col(name) for name in lines.columns if name != column]
    return kept + [value.alias(name) for name, value in line.columns().items()]


def _strict(lines: DataFrame, column: str, line: _Format) -> DataFrame:
    message = F.concat(F.lit("malformed line: "), F.col(column))
    valid = F.coalesce(line.valid(), F.lit(False))
    checked = _parsed(lines, column, line).filter(require(valid, message))
    return checked.select(*_columns(lines, column, line))


def _permissive(
    lines: DataFrame, column: str, line: _Format, once: bool
) -> tuple[DataFrame, DataFrame]:
    parsed = _parsed(lines, column, line)
    valid = F.coalesce(line.valid(), F.lit(False))
    if once:
        # Both outputs read one of the two folders that this pass writes.
        good = F.struct(*_columns(lines, column, line)).alias("good")
        rows = parsed.select(F.struct(*lines.columns).alias("line"), good, valid.alias("valid"))
        kept = F.when(F.col("valid"), F.col("good")), F.when(~F.col("valid"), F.col("line"))
        path = new_path(lines.sparkSession, "parsed")
        rows = rows.select(kept[0].alias("good"), kept[1].alias("line"), "valid")
        rows.write.partitionBy("valid").parquet(path)
        back = lines.sparkSession.read.schema(rows.schema).parquet(path)
        return (
            back.filter("valid").select("good.*"),
            back.filter("NOT valid").select("line.*"),
        )
    good = parsed.filter(valid).select(*_columns(lines, column, line))
    return good, parsed.filter(~valid).select(*lines.columns)


def parse_ratings(lines: DataFrame, column: str = "value") -> DataFrame:
    """``product,user,rating,timestamp`` lines to (product, user, rating, ts)."""
    return _strict(lines, column, RATING)


def split_bad_ratings(
    lines: DataFrame, column: str = "value", once: bool = False
) -> tuple[DataFrame, DataFrame]:
    """As :func:`parse_ratings`, with malformed lines in a second DataFrame."""
    return _permissive(lines, column, RATING, once)


def parse_labelled_points(lines: DataFrame, column: str = "value") -> DataFrame:
    """``x1,...,xd,label`` lines to (point, cluster)."""
    return _strict(lines, column, LABELLED_POINT)


def split_bad_labelled_points(
    lines: DataFrame, column: str = "value", once: bool = False
) -> tuple[DataFrame, DataFrame]:
    """As :func:`parse_labelled_points`, with malformed lines in a second DataFrame."""
    return _permissive(lines, column, LABELLED_POINT, once)


def parse_points(lines: DataFrame, column: str = "value") -> DataFrame:
    """Whitespace-separated coordinates to (point). A blank line is malformed."""
    return _strict(lines, column, POINT)


def split_bad_points(
    lines: DataFrame, column: str = "value", once: bool = False
) -> tuple[DataFrame, DataFrame]:
    """As :func:`parse_points`, with malformed lines in a second DataFrame."""
    return _permissive(lines, column, POINT, once)


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Rating file to (product, user, rating, ts); one line is one review."""
    return parse_ratings(read_lines(spark, path))


def read_labelled_points(spark: SparkSession, path: str) -> DataFrame:
    """Clustering file to (point, cluster)."""
    return parse_labelled_points(read_lines(spark, path))


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """Point file to (point)."""
    return parse_points(read_lines(spark, path))
