"""Text, JSON and map helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_entry(last_page_id="page.last_page_id") -> Column:
    """True when a page was opened without coming from another page."""
    return F.coalesce(F.col(last_page_id), F.lit("")) == ""


def as_long(c) -> Column:
    return F.col(c).try_cast("bigint")


def as_money(c) -> Column:
    return F.col(c).try_cast("decimal(16,2)")


def comma_list(c) -> Column:
    """Comma text to an array; parts keep their blanks."""
    return F.split(F.col(c), ",", -1)


def tuple_text(*cols) -> Column:
    """Columns as ``(a,b,c)``; a null prints as ``null``."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in cols]
    return F.concat(F.lit("("), F.concat_ws(",", *parts), F.lit(")"))


def row_text(df: DataFrame) -> Column:
    """All columns of a row, comma-joined; a null prints as ``null``."""
    return F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in df.columns])


def keep_keys(entries, keys: Column) -> Column:
    """Map entries whose key is in ``keys``."""
    return F.map_filter(entries, lambda k, _: F.array_contains(keys, k))


def parse_json(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """JSON text to the columns of ``schema``.

    ``inline`` makes the parse a step of its own. A plain projection would be
    repeated in every later filter that the optimizer pushes below it.
    """
    return df.select(F.inline(F.array(F.from_json(F.col(value), schema))))


def parse_record(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Flat JSON text to typed columns.

    Numbers may come bare or quoted, so every field is read as text and cast;
    a field that does not fit its type becomes null.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = parse_json(df, text, value)
    return raw.select([F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def checked_json(
    df: DataFrame, schema: T.StructType, needs: tuple[str, ...] = (), flat: bool = False, value: str = "value"
) -> DataFrame:
    """JSON text to the columns of ``schema``, plus ``raw``, the text itself, and ``readable``.

    Readable is a JSON object that has the fields in ``needs``; without any, one whose fields all have their types.
    With ``flat``, numbers may come bare or quoted as in ``parse_record``.
    """
    shape = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]) if flat else schema
    wide = T.StructType([*shape.fields, T.StructField("_corrupt", T.StringType())])
    row = F.from_json(F.col(value), wide, {"columnNameOfCorruptRecord": "_corrupt"})
    # inline makes the parse a step of its own (see parse_json)
    parsed = df.select(F.inline(F.array(F.struct(row.alias("_row"), F.col(value).alias("raw")))))
    fields = {f.name: F.col("_row")[f.name] for f in schema.fields}
    if flat:
        fields = {f.name: fields[f.name].try_cast(f.dataType) for f in schema.fields}
    whole = F.col("_row._corrupt").isNull()
    for i, path in enumerate(needs):
        first, *inner = path.split(".")
        found = fields[first]
        for name in inner:
            found = found[name]
        whole = found.isNotNull() if i == 0 else whole & found.isNotNull()
    readable = F.coalesce(F.col("_row").isNotNull() & F.col("raw").rlike(r"^\s*\{") & whole, F.lit(False))
    return parsed.select(*[c.alias(name) for name, c in fields.items()], "raw", readable.alias("readable"))


def readable_rows(checked: DataFrame) -> DataFrame:
    """The rows that could be read, as their columns."""
    return checked.filter("readable").drop("raw", "readable")


def unreadable_lines(checked: DataFrame, topic: str) -> DataFrame:
    """The lines that could not, as JSON text with the topic they came from."""
    rows = checked.filter("NOT readable").select(F.lit(topic).alias("topic"), F.coalesce("raw", F.lit("")).alias("line"))
    return to_value(rows)


def to_value(df: DataFrame) -> DataFrame:
    """Rows as JSON text in one ``value`` column; null fields are left out."""
    return df.select(F.to_json(F.struct("*")).alias("value"))
