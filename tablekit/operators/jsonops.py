"""JSON flattening and JSON-to-tables.

JSON text is parsed into Spark's VARIANT type, once a job; paths are read with
``variant_get`` and arrays expanded with ``explode`` of ``array<variant>``.
Schema inference is two distributed jobs: ``schema_of_variant_agg`` gives
the merged structure (every path), then one pass counts the kinds of values at
every path; never a sample or a driver-side parse of rows.  The merged type of
a path tells its kind, but for fractions (whole numbers may be among them) and
conflicts: only there the values' own types are read.

A path is a tuple of steps: a field name, or ``None`` for the elements of an
array.  Written as text, steps join with dots, elements add ``[]``, and names
that are not plain words stand in back quotes (``a.`p.q`[]``).  The driver
holds one row per path.  Objects whose field names are data (ids as names) are
found by a sketch of the distinct names at each path and read as arrays of
``{"key": ..., "value": ...}``, so a path stands for all of them.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator, Mapping
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: the JSON-to-DDL type lattice
SQL_BOOLEAN, SQL_INT, SQL_FLOAT, SQL_TEXT = "BOOLEAN", "INT", "FLOAT", "VARCHAR(255)"


def _jpath(path: str) -> str:
    return path if path.startswith("$") else "$." + path


def json_flatten(df: DataFrame, payload: str, parent_paths: Mapping[str, str | tuple[str, str]],
                 array_path: str, item_paths: Mapping[str, str | tuple[str, str]],
                 outer: bool = False) -> DataFrame:
    """One row per element of the JSON array at ``array_path``, with parent
    fields repeated.  ``*_paths`` map an output name to a JSON path, or to
    (path, spark type); without a type the value is text (like ``->>``).
    An empty or missing array gives no row unless ``outer=True``."""
    def get(v: Column, spec) -> Column:
        path, typ = (spec, "string") if isinstance(spec, str) else spec
        return F.try_variant_get(v, _jpath(path), typ)

    v = F.try_parse_json(F.col(payload))
    base = df.withColumn("_tk_v", v)
    items = F.try_variant_get(F.col("_tk_v"), _jpath(array_path), "array<variant>")
    explode = F.explode_outer if outer else F.explode
    rows = base.select(*[get(F.col("_tk_v"), s).alias(n) for n, s in parent_paths.items()],
                       explode(items).alias("_tk_item"))
    return rows.select(*parent_paths.keys(),
                       *[get(F.col("_tk_item"), s).alias(n) for n, s in item_paths.items()])


def _kind(t: Column) -> Column:
    return (F.when(t.startswith("OBJECT"), "object").when(t.startswith("ARRAY"), "array")
             .when(t == "VOID", "null").when(t == "BOOLEAN", "boolean")
             .when(t.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), "int")
             .when(t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT"), "float")
             .otherwise("text"))


def _variant(df: DataFrame, payload: str) -> Column:
    dt = df.schema[payload].dataType
    return F.col(payload) if isinstance(dt, T.VariantType) else F.try_parse_json(F.col(payload))


def merged_schema(df: DataFrame, payload: str) -> T.DataType:
    """Merged structure of all JSON values of the column: one aggregate job
    (``schema_of_variant_agg``), parsed by Spark's own DDL parser."""
    ddl = df.agg(F.schema_of_variant_agg(_variant(df, payload))).first()[0]
    if ddl is None:
        return T.NullType()
    # quoted field names stay as they are
    parts = re.split(r"(`(?:[^`]|``)*`)", ddl)
    parts[::2] = [x.replace("OBJECT<", "STRUCT<") for x in parts[::2]]
    return T.DataType.fromDDL("".join(parts))


# ---------------------------------------------------------------- names that are data

MAX_FIELDS = 1_000   # an object path with about this many distinct names holds data as names
_RSD = 0.02          # of the sketch


class _Number(str):
    """A number as it was written."""


def _write(v, path: tuple[str, ...], maps: set[tuple[str, ...]], out: list[str]) -> None:
    """``v`` as JSON text, objects at ``maps`` as arrays of keys and values."""
    if isinstance(v, dict):
        as_rows = path in maps
        for i, (k, x) in enumerate(v.items()):
            out.append("," if i else "[" if as_rows else "{")
            name = json.dumps(k)
            out.append(f'{{"key":{name},"value":' if as_rows else f"{name}:")
            _write(x, (*path, "{}" if as_rows else f".{k}"), maps, out)
            if as_rows:
                out.append("}")
        out.append(("]" if as_rows else "}") if v else "[]" if as_rows else "{}")
    elif isinstance(v, list):
        out.append("[")
        for i, x in enumerate(v):
            if i:
                out.append(",")
            _write(x, (*path, "[]"), maps, out)
        out.append("]")
    else:
        out.append(v if isinstance(v, _Number) else json.dumps(v))


def _text(df: DataFrame, payload: str) -> Column:
    return F.to_json(F.col(payload)) if isinstance(df.schema[payload].dataType, T.VariantType) else F.col(payload)


def data_like_objects(df: DataFrame, payload: str, max_fields: int = MAX_FIELDS) -> set[tuple[str, ...]]:
    """Paths of the objects with more than about ``max_fields`` distinct names over
    all documents.  Steps are ``.name``, ``[]`` for elements and ``{}`` for the
    values of such an object.

    One pass over the text counts all names by a sketch: with few, no object can
    have many.  Otherwise the documents are taken apart level by level, one sketch
    for each path; a level's paths stand for all names of the objects found above
    it, so neither the aggregates nor the driver hold more than real paths."""
    text = _text(df, payload)
    # a name that holds a quote is seen in part only: then look closely
    names, close = df.select(F.explode_outer(F.regexp_extract_all(text, F.lit('"([^"]*+)"\\s*+:'), 1)).alias("name"),
                             F.coalesce(text.contains('\\"') & text.rlike('\\\\"[^"]*+"\\s*+:'), F.lit(False)).alias("close")).agg(
        F.approx_count_distinct("name", _RSD), F.coalesce(F.max("close"), F.lit(False))).first()
    if names <= max_fields * (1 - 5 * _RSD) and not close:
        return set()
    maps: set[tuple[str, ...]] = set()
    path = F.array().cast("array<string>")
    level = df.select(path.alias("path"), _variant(df, payload).alias("v"))
    while True:
        inside = level.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("v").outer())).select("path", "key", "value")
        nested = F.schema_of_variant("value").startswith("OBJECT<") | F.schema_of_variant("value").startswith("ARRAY<")
        found = (inside.groupBy("path").agg(F.approx_count_distinct("key", _RSD).alias("n"), F.max(nested).alias("deeper"))
                 .groupBy().agg(F.collect_list(F.when(F.col("n") > max_fields, F.col("path"))).alias("maps"),
                                F.coalesce(F.max("deeper"), F.lit(False)).alias("deeper")).first())
        here = [list(p) for p in found["maps"]]
        maps |= {tuple(p) for p in here}
        if not found["deeper"]:
            return maps
        is_map = F.lit(False)
        for p in here:
            is_map = is_map | (F.col("path") == F.array(*[F.lit(x) for x in p]).cast("array<string>"))
        step = F.when(F.col("key").isNull(), "[]").when(is_map, "{}").otherwise(F.concat(F.lit("."), F.col("key")))
        level = inside.where(nested).select(F.concat("path", F.array(step)).alias("path"), F.col("value").alias("v"))


def keys_as_rows(df: DataFrame, payload: str, max_fields: int = MAX_FIELDS) -> Column:
    """The documents of the column as VARIANT, objects with data as names
    (``data_like_objects``) as arrays of ``{"key": name, "value": value}``."""
    maps = data_like_objects(df, payload, max_fields)
    return F.try_parse_json(_as_rows(df, payload, maps)) if maps else _variant(df, payload)


def _as_rows(df: DataFrame, payload: str, maps: set[tuple[str, ...]]) -> Column:
    """The documents as JSON text, objects at ``maps`` as arrays of keys and values."""
    @F.pandas_udf("string")
    def rewritten(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sys.setrecursionlimit(10_000)   # documents nest up to 1,000 levels
        def one(text):
            out: list[str] = []
            _write(json.loads(text, parse_int=_Number, parse_float=_Number), (), maps, out)
            return "".join(out)

        for texts in batches:
            yield texts.map(one, na_action="ignore")

    return rewritten(F.when(_variant(df, payload).isNotNull(), _text(df, payload)))


def _parsed(df: DataFrame, payload: str, max_fields: int, *keys: Column) -> DataFrame:
    """The documents of the column as VARIANT (``_tk_v``, see ``keys_as_rows``) beside ``keys``.

    Whatever makes JSON text runs once: it is written as Parquet, and all jobs
    after read that.  Text is written and no VARIANT, as Spark's Parquet files need not keep
    the types of VARIANT numbers (whole numbers beside fractions come back as such)."""
    from ..session import discard, materialize
    docs = df.select(*keys, F.col(payload).alias("_tk_t"))
    if not isinstance(df.schema[payload].dataType, T.VariantType):
        docs = materialize(docs, "json_documents")
    maps = data_like_objects(docs, "_tk_t", max_fields)
    if maps:
        rows = materialize(docs.withColumn("_tk_t", _as_rows(docs, "_tk_t", maps)), "json_rows")
        discard(docs)
        docs = rows
    return docs.withColumn("_tk_v", _variant(docs, "_tk_t")).drop("_tk_t")


Path = tuple[str | None, ...]


def path_text(path: Path) -> str:
    """A path as text (see the module's docstring)."""
    out = ""
    for step in path:
        if step is None:
            out += "[]"
        else:
            name = step if re.fullmatch(r"\w+", step) else "`" + step.replace("`", "``") + "`"
            out += ("." if out else "") + name
    return out


def _get(v: Column, names: tuple[str, ...], typ: str = "variant") -> Column:
    """The value at fields inside fields, in one look-up."""
    path = "$"
    for name in names:
        if re.search(r"""['"\\\[\]]""", name):  # variant paths have no escapes: look the name up in a map
            v, path = F.try_element_at(F.try_variant_get(v, path, "map<string,variant>"), F.lit(name)), "$"
        else:
            path += f"['{name}']"
    return v if path == "$" and typ == "variant" else F.try_variant_get(v, path, typ)


_FRACTIONS = (T.DecimalType, T.DoubleType, T.FloatType)


def _name_of_all(t: T.DataType) -> str | None:
    """The type name of all values (but nulls) that were merged to ``t``; None: they may differ."""
    if isinstance(t, (*_FRACTIONS, T.VariantType)):
        return None
    return ("OBJECT" if isinstance(t, T.StructType) else "ARRAY" if isinstance(t, T.ArrayType)
            else "VOID" if isinstance(t, T.NullType) else "BOOLEAN" if isinstance(t, T.BooleanType)
            else "BIGINT" if isinstance(t, T.IntegralType) else "STRING")


def _levels(frame: DataFrame, dt: T.DataType, path: Path = ()) -> Iterator[tuple[DataFrame, list[tuple[Path, T.DataType, tuple[str, ...]]]]]:
    """Frames of one column ``value``, the documents and then the elements of
    each array, with the (path, type, field names) of the values in them up to
    the next array."""
    here = []

    def visit(t: T.DataType, path: Path, names: tuple[str, ...]) -> None:
        here.append((path, t, names))
        if isinstance(t, T.StructType):
            for f in t.fields:
                visit(f.dataType, (*path, f.name), (*names, f.name))

    visit(dt, path, ())
    yield frame, here
    for at, t, names in here:
        if isinstance(t, T.ArrayType):
            yield from _levels(frame.select(F.explode_outer(_get(F.col("value"), names, "array<variant>")).alias("value")),
                               t.elementType, (*at, None))


def _infer(df: DataFrame, payload: str, only: tuple = ()) -> tuple[T.DataType, list[Path], DataFrame | None]:
    """Merged structure, the paths in order, and per path number: kinds, n_values.
    ``only``: count just the values merged to these types (None without any)."""
    dt = merged_schema(df, payload)
    paths: list[Path] = []
    counts = []
    for frame, here in _levels(df.select(F.col(payload).alias("value")), dt):
        here = [x for x in here if not only or isinstance(x[1], only)]
        if not here:
            continue
        # each value is taken out once, before the kinds look at it
        values = frame.select(*[_get(F.col("value"), names).alias(f"v{i}") for i, (_, _, names) in enumerate(here)])
        pairs = []
        for i, (path, t, _) in enumerate(here):
            v, name = F.col(f"v{i}"), _name_of_all(t)
            of_all = F.regexp_extract(F.schema_of_variant(v), r"^\w+", 0) if name is None else F.when(F.is_variant_null(v), "VOID").otherwise(name)
            pairs.append(F.struct(F.lit(len(paths)).alias("path"), F.when(v.isNotNull(), of_all).alias("name")))
            paths.append(path)
        counts.append(values.select(F.explode(F.array(*pairs)).alias("p")).select("p.path", "p.name")
                      .filter("name is not null").groupBy("path", "name").agg(F.count(F.lit(1)).alias("n")))
    if not counts:
        return dt, paths, None
    kind = _kind(F.col("name"))
    return dt, paths, reduce(DataFrame.unionByName, counts).groupBy("path").agg(
        F.array_sort(F.collect_set(F.when(kind != "null", kind))).alias("kinds"), F.sum("n").alias("n_values"))


def _sql_type(kinds: Column) -> Column:
    n, single = F.size(kinds), F.get(kinds, F.lit(0))
    return (F.when(n != 1, SQL_TEXT)
             .when(single == "boolean", SQL_BOOLEAN).when(single == "int", SQL_INT)
             .when(single == "float", SQL_FLOAT)
             .when(single == "object", "OBJECT").when(single == "array", "ARRAY")
             .otherwise(SQL_TEXT))


def infer_json_columns(df: DataFrame, payload: str, max_fields: int = MAX_FIELDS) -> DataFrame:
    """Per JSON path: the kinds seen, the DDL type of the lattice
    BOOLEAN | INT | FLOAT | VARCHAR(255) (conflict or all-null -> text),
    whether kinds conflict, and how many values were seen.  Objects and
    arrays are listed as such; their members appear as ``a.b`` / ``a[]``.  An
    object with more than about ``max_fields`` distinct names over all documents
    counts as an array of ``{"key", "value"}``."""
    _, paths, kinds = _infer(_parsed(df, payload, max_fields), "_tk_v")
    names = F.lit([path_text(p) for p in paths])
    return kinds.filter(F.get(names, F.col("path")) != "").select(
        F.get(names, F.col("path")).alias("path"), F.array_join("kinds", ",").alias("kinds"),
        _sql_type(F.col("kinds")).alias("sql_type"), (F.size("kinds") > 1).alias("conflict"), "n_values")


def _known_type(t: T.DataType) -> str:
    """``_sql_type`` of values merged to ``t`` that is no fraction."""
    return {"BOOLEAN": SQL_BOOLEAN, "BIGINT": SQL_INT}.get(_name_of_all(t), SQL_TEXT)


_SPARK_TYPE = {SQL_BOOLEAN: "boolean", SQL_INT: "bigint", SQL_FLOAT: "double", SQL_TEXT: "string"}


def _own_names(wanted: list[str], taken: list[str]) -> list[str]:
    """Column names without clashes (compared without case): a number is added."""
    used = {t.lower() for t in taken}
    out = []
    for name in wanted:
        new, k = name, 2
        while new.lower() in used:
            new, k = f"{name}_{k}", k + 1
        used.add(new.lower())
        out.append(new)
    return out


def json_to_tables(df: DataFrame, payload: str, key_col: str | None = None,
                   max_fields: int = MAX_FIELDS) -> dict[Path, DataFrame]:
    """Split a JSON column into a parent table and child tables, keyed by the
    path they come from (``()`` is the parent; ``("a", "items")`` the objects
    or elements at ``a.items``; ``("m", None)`` the inner arrays of ``m``).

    The parent has the key and the scalar fields.  Each object field is a
    child table, each array a child table with one row per element; both
    carry the document's key as ``root_id`` and the positions in all arrays
    around them as ``pos_1``, ``pos_2``, ...  Elements that are no objects
    are in ``value``; arrays inside arrays are tables of their own.  Types
    follow ``infer_json_columns``: what conflicts becomes text (objects as
    their JSON).  A document that is an array of records gives one record per
    element, keyed ``key:position``.  An object with more than about
    ``max_fields`` distinct names over all documents is a child table with
    ``key`` and ``value``.  The document's key is ``key_col`` if given, else
    the SHA-256 of the payload (stable on recomputation, unlike ``uuid()``)."""
    key = key_col or "_id"
    base = _parsed(df, payload, max_fields, (F.col(key_col) if key_col else F.sha2(F.col(payload), 256)).alias(key))
    # only fractions need a look at their values: the merged type tells all others
    dt, paths, kinds = _infer(base, "_tk_v", only=_FRACTIONS)
    types = {} if kinds is None else {
        paths[r["path"]]: r["t"] for r in kinds.select("path", _sql_type(F.col("kinds")).alias("t")).collect()}
    if isinstance(dt, T.ArrayType) and isinstance(dt.elementType, T.StructType):
        base = (base.select(key, F.posexplode(_get(F.col("_tk_v"), (), "array<variant>")).alias("_tk_pos", "_tk_e"))
                    .select(F.concat_ws(":", F.col(key).cast("string"), F.col("_tk_pos").cast("string")).alias(key),
                            F.col("_tk_e").alias("_tk_v")))
        dt, types = dt.elementType, {p[1:]: t for p, t in types.items() if p[:1] == (None,)}
    tables: dict[Path, DataFrame] = {}
    value = F.col("_tk_v")

    def scalar(v: Column, names: tuple[str, ...], t: T.DataType, path: Path) -> Column:
        return _get(v, names, _SPARK_TYPE[types.get(path, _known_type(t))])

    def nested(t: T.DataType) -> bool:
        return isinstance(t, T.StructType | T.ArrayType)

    def build(frame: DataFrame, t: T.DataType, path: Path, ids: list[str]) -> None:
        """The table of the values in ``_tk_v`` at ``path``, and those inside it."""
        if isinstance(t, T.StructType):
            plain = [f for f in t.fields if not nested(f.dataType)]
            names = _own_names([f.name for f in plain], ids)
            tables[path] = frame.select(*ids, *[scalar(value, (f.name,), f.dataType, (*path, f.name)).alias(n)
                                                for f, n in zip(plain, names)])
            for f in t.fields:
                if nested(f.dataType):
                    child(frame, (f.name,), f.dataType, (*path, f.name), ids)
        elif isinstance(t, T.ArrayType):
            child(frame, (), t, path, ids)
        else:
            tables[path] = frame.select(*ids, scalar(value, (), t, path).alias("value"))

    def child(frame: DataFrame, names: tuple[str, ...], t: T.DataType, path: Path, ids: list[str]) -> None:
        """The tables of the value at ``names`` inside ``_tk_v``."""
        if ids[0] == key:
            frame, ids = frame.withColumnRenamed(key, "root_id"), ["root_id", *ids[1:]]
        if isinstance(t, T.StructType):
            build(frame.select(*ids, _get(value, names).alias("_tk_v")).filter(value.isNotNull()), t, path, ids)
            return
        pos = f"pos_{len(ids)}"
        # outer, then filtered: an inner one has its array made twice, first for the planner's own filter on its size
        rows = frame.select(*ids, F.posexplode_outer(_get(value, names, "array<variant>")).alias(pos, "_tk_v")).filter(F.col(pos).isNotNull())
        inner = (*path, None)
        if isinstance(t.elementType, T.ArrayType):
            child(rows, (), t.elementType, inner, [*ids, pos])
        elif isinstance(t.elementType, T.StructType):
            before = set(tables)
            build(rows, t.elementType, inner, [*ids, pos])
            # the records of an array are named by the array itself
            for p in [p for p in tables if p not in before and p[:len(inner)] == inner]:
                tables[path + p[len(inner):]] = tables.pop(p)
        else:
            tables[path] = rows.select(*ids, pos, scalar(value, (), t.elementType, inner).alias("value"))

    build(base, dt, (), [key])
    return tables
