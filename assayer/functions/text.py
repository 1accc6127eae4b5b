"""Identifier, URL and date functions."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import add
from types import MappingProxyType

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: accepted date and date-time text ------------------------
# A date, or a date with a T and a time of at least minutes, and for either one
# an optional offset. The same text works in Java and RE2 regular expressions.
ISO_DATETIME = (
    r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])"
    r"([Tt]([01]\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d{0,9})?)?)?"
    r"([Zz]|[+-]\d\d:\d\d(:\d\d)?(\[[A-Za-z_/+-]+\])?)?$"
)

# --- fixed values: evidence code URLs whose codes are written ECO:n --------
ECO_URL_LIKE = "%/identifiers.org/eco/%"

# A character above U+0020, i.e. one that trimming does not remove.
NON_BLANK = r"[^\x00-\x20]"


def url_basename(url: Column) -> Column:
    """Text after the last slash; all of it if there is none."""
    return F.substring_index(url, "/", -1)


def disease_code(url: Column) -> Column:
    """Disease code of a disease URL."""
    return url_basename(url)


def url_part(url: Column, index: int) -> Column:
    """Slash-separated part of a URL counted from 0; NULL beyond the last one."""
    return F.get(F.split(url, "/"), F.lit(index))


def evidence_code(url: Column) -> Column:
    """Evidence code of one code URL."""
    base = url_basename(url)
    return F.when(
        url.like(ECO_URL_LIKE), F.replace(base, F.lit("ECO:"), F.lit("ECO_"))
    ).otherwise(base)


def evidence_codes(urls: Column) -> Column:
    """Evidence codes of an array of code URLs, in the same order."""
    return F.transform(urls, evidence_code)


def is_iso_datetime(text: Column) -> Column:
    """Whether the text is an ISO date or date-time."""
    return text.rlike(ISO_DATETIME)


def is_nonblank_uri(text: Column) -> Column:
    """Whether a URI holds anything but blanks."""
    return text.rlike(NON_BLANK)


def add_record_id(
    df: DataFrame,
    name: str = "id",
    fields: str = "unique_association_fields",
    source: str = "sourceID",
    source_as: str = "datasource",
    listed: Mapping[str, T.DataType] = MappingProxyType({}),
) -> DataFrame:
    """Add the MD5 of a record's identifying fields as its id.

    The identifying struct is rebuilt to hold exactly what is hashed: its own
    fields but `source_as`, plus the record's source under that name, in code
    point order where the source sorts by the name of its own column. Fields
    that are NULL stay out of the JSON text, so only keys a record has count.

    Identifying fields may also be a map, which has every key of a record,
    whatever the schema: all of them count, and those `listed` make the struct, with
    their types.
    """
    if isinstance(df.schema[fields].dataType, T.MapType):
        return _add_id_of_map(df, name, fields, source, source_as, listed)
    inner = [f for f in df.select(f"{fields}.*").columns if f != source_as]
    parts = [
        F.col(source).alias(source_as) if f == source else F.col(f"{fields}.{f}").alias(f)
        for f in sorted([*inner, source])
    ]
    key = F.struct(*parts)
    return df.withColumns({fields: key, name: F.md5(F.to_json(key))})


def _add_id_of_map(
    df: DataFrame, name: str, fields: str, source: str, source_as: str, listed: Mapping[str, T.DataType]
) -> DataFrame:
    entries, keys = F.map_entries(fields), F.map_keys(fields)

    def counts(entry: Column, index: Column) -> Column:
        # Of a key that repeats the first counts.
        first = F.array_position(keys, entry["key"]) == index + 1
        return entry["value"].isNotNull() & first & ~entry["key"].isin(source, source_as)

    def part(by: Column, key: Column, value: Column) -> Column:
        return F.struct(by.alias("by"), key.alias("key"), value.alias("value"))

    own = F.transform(F.filter(entries, counts), lambda e: part(e["key"], e["key"], e["value"]))
    origin = F.array(part(F.lit(source), F.lit(source_as), F.col(source)))
    every = F.concat(
        F.coalesce(own, F.slice(origin, 1, 0)), F.when(F.col(source).isNull(), F.slice(origin, 1, 0)).otherwise(origin)
    )

    ordered = F.transform(F.array_sort(every), lambda e: F.struct(e["key"], e["value"]))
    # Where each key is a listed one and has a value, the listed texts in their order
    # make the same JSON text, in compiled code.
    names = sorted({*listed, source} - {source_as})
    present = [F.col(fields)[f].isNotNull().cast("int") for f in (source, source_as)]
    present += [F.col("id:texts")[f].isNotNull().cast("int") for f in names if f != source]
    only_listed = F.coalesce(F.size(fields) == reduce(add, present), F.lit(True))
    texts = F.struct(
        *[F.col(source).alias(source_as) if f == source else F.col(fields)[f].alias(f) for f in names]
    )

    def typed(field: str) -> Column:
        value, kind = F.col("id:texts")[field], listed[field]
        if isinstance(kind, T.StringType):
            return value
        nested = isinstance(kind, (T.StructType, T.ArrayType, T.MapType))
        return F.from_json(value, kind) if nested else value.try_cast(kind)

    digest = F.md5(
        F.when(only_listed, F.to_json("id:texts")).otherwise(F.to_json(F.map_from_entries(ordered)))
    )
    struct = F.col("id:texts")
    if any(not isinstance(kind, T.StringType) for kind in listed.values()):
        struct = F.struct(
            *[struct[source_as].alias(source_as) if f == source else typed(f).alias(f) for f in names]
        )
    df = df.withColumn("id:texts", texts).withColumn(name, digest)
    return df.withColumn(fields, struct).drop("id:texts")
