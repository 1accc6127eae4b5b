"""Columns of nested frames: prefixes, structs, rewrites by path, flattening."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def add_prefix(df: DataFrame, prefix: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Prefix all column names, or only the given ones."""
    chosen = set(columns or df.columns)
    return df.toDF(*[prefix + c if c in chosen else c for c in df.columns])


def drop_prefix(df: DataFrame, prefix: str) -> DataFrame:
    """Drop the columns whose names start with a prefix."""
    return df.drop(*[c for c in df.columns if c.startswith(prefix)])


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def create_struct(df: DataFrame, name: str, *columns: str) -> DataFrame:
    """Move columns into a new struct, which becomes the last column."""
    kept = [F.col(quoted(c)) for c in df.columns if c not in columns]
    return df.select(*kept, F.struct(*[F.col(quoted(c)) for c in columns]).alias(name))


def append_struct(df: DataFrame, name: str, *columns: str) -> DataFrame:
    """Move columns into a struct, at the end of its fields if it exists."""
    if name not in df.columns:
        return create_struct(df, name, *columns)
    merged = F.struct(F.col(f"{name}.*"), *[F.col(quoted(c)) for c in columns])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*[merged.alias(c) if c == name else F.col(quoted(c)) for c in kept])


def type_at(schema: T.StructType, path: str) -> T.DataType:
    """Type of the field at a dotted path; KeyError if there is none."""
    kind: T.DataType = schema
    for part in path.split("."):
        if not isinstance(kind, T.StructType) or part not in kind.fieldNames():
            raise KeyError(f"no field {path}")
        kind = kind[part].dataType
    return kind


def aligned_type(found: T.DataType, needed: T.DataType) -> T.DataType:
    """A type found in data with the fields of one that is needed.

    Fields that only the former has are kept, those it lacks come behind them, and
    where both have a value of another kind the needed one counts.
    """
    if isinstance(found, T.StructType) and isinstance(needed, T.StructType):
        wanted = {f.name: f.dataType for f in needed}
        own = [
            T.StructField(f.name, aligned_type(f.dataType, wanted.pop(f.name, f.dataType))) for f in found
        ]
        return T.StructType([*own, *[T.StructField(n, t) for n, t in wanted.items()]])
    if isinstance(found, T.ArrayType) and isinstance(needed, T.ArrayType):
        return T.ArrayType(aligned_type(found.elementType, needed.elementType))
    return needed


def pruned_type(kind: T.StructType, paths: Iterable[str]) -> T.StructType:
    """A type with the fields at some dotted paths only, in their order; KeyError if
    there is none. A path that ends at a struct keeps all of it.
    """
    below: dict[str, list[str]] = {}
    for path in paths:
        type_at(kind, path)
        first, _, rest = path.partition(".")
        below.setdefault(first, []).append(rest)
    return T.StructType(
        [
            f if "" in below[f.name] else T.StructField(f.name, pruned_type(f.dataType, below[f.name]))
            for f in kind
            if f.name in below
        ]
    )


def has_path(schema: T.StructType, path: str) -> bool:
    try:
        type_at(schema, path)
    except KeyError:
        return False
    return True


def mutate(df: DataFrame, changes: Mapping[str, Column | Callable[[Column], Column]]) -> DataFrame:
    """Replace fields at dotted paths, leaving the schema as it is.

    A function gets the present field. Every replacement sees the frame as it
    was, is cast to the type of the field it replaces, and a NULL struct on the
    way to the field stays NULL. A path that does not exist is an error.
    """
    by_root: dict[str, Column] = {}
    for path, change in changes.items():
        kind = type_at(df.schema, path)
        value = (change(F.col(path)) if callable(change) else change).cast(kind)
        root, _, rest = path.partition(".")
        by_root[root] = by_root.get(root, F.col(root)).withField(rest, value) if rest else value
    return df.withColumns(by_root)


def mutate_columns(
    df: DataFrame, paths: Iterable[str], change: Callable[[Column], Column]
) -> DataFrame:
    """One function over many paths."""
    return mutate(df, {path: change for path in paths})


def flat_columns(paths: Iterable[str], presence: Iterable[str] = ()) -> list[Column]:
    """Nested fields as flat columns, and a flag for each struct of `presence`.

    The name is the path with _ for the dots, with `_exists` for the flags.
    """
    fields = [F.col(p).alias(p.replace(".", "_")) for p in paths]
    flags = [F.col(p).isNotNull().alias(p.replace(".", "_") + "_exists") for p in presence]
    return fields + flags


def same_schema(expected: DataFrame, message: str = "") -> Callable[[DataFrame], DataFrame]:
    """A check for `transform`: names, types and order must be those expected.

    Whether a field may be NULL is left out, since an expression can narrow it.
    """

    def check(df: DataFrame) -> DataFrame:
        if df.schema.simpleString() != expected.schema.simpleString():
            raise AssertionError(
                (message or "schemas differ")
                + f"\nexpected:\n{expected.schema.treeString()}\nfound:\n{df.schema.treeString()}"
            )
        return df

    return check
