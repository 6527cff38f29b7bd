"""Columns from XML text, with a declared schema and without failing on bad documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEAD_KEYS = (
    "income_monthly", "bank_name", "home_state", "email_primary", "date_dob_m", "date_dob_d", "date_dob_y",
    "bank_length_months", "residence_length_months", "residence_type", "employer_length_months",
    "loan_amount_desired", "sub_id",
)

ENTRY = "array<struct<_name:string,_VALUE:string>>"


def without_declaration(text: Column) -> Column:
    return F.regexp_replace(text, r"<\?xml[^>]*\?>", "")


def parse_xml(text: Column, schema: T.StructType | str, drop_ampersands: bool = False) -> Column:
    """Struct of a document; every field is NULL when the text is missing or malformed.

    The schema is a struct type or a column list as text. Keep the result in a column of
    its own before taking several fields, so that each document is parsed once.
    """
    body = without_declaration(text)
    if drop_ampersands:
        body = F.replace(body, F.lit("&"), F.lit(""))
    return F.from_xml(body, schema, {"mode": "PERMISSIVE"})


def first_named(entries: Column, name: str) -> Column:
    """Text of the first entry with that name attribute, else NULL."""
    return F.get(F.filter(entries, lambda entry: entry["_name"] == name), F.lit(0))["_VALUE"]


def named_values(
    df: DataFrame, column: str, names: Sequence[str] = LEAD_KEYS, root: str = "loan_request", suffix: str = ""
) -> DataFrame:
    """One column per ``<data name="...">`` below each root element of the text.

    Text without such a root keeps its row, with NULLs; two roots give two rows.
    """
    wrapped = F.concat(F.lit("<all>"), without_declaration(F.col(column)), F.lit("</all>"))
    schema = f"{root} array<struct<data:{ENTRY}>>"
    parsed = df.withColumn("_roots", parse_xml(wrapped, schema, drop_ampersands=True)[root])
    rows = parsed.withColumn("_doc", F.explode_outer("_roots")).drop("_roots")
    return rows.withColumns({f"{name}{suffix}": first_named(F.col("_doc.data"), name) for name in names}).drop("_doc")


def leaf_paths(schema: T.StructType, depth: int = 1) -> list[tuple[str, str, int]]:
    """(path, tag, depth) of every leaf; children of the root have depth 1."""
    found = []
    for field in schema.fields:
        kind = field.dataType.elementType if isinstance(field.dataType, T.ArrayType) else field.dataType
        if isinstance(kind, T.StructType):
            found += [(f"{field.name}.{path}", tag, level) for path, tag, level in leaf_paths(kind, depth + 1)]
        else:
            found.append((field.name, field.name, depth))
    return found


def _all_repeated(schema: T.StructType) -> T.StructType:
    """The same schema with every element allowed to repeat."""
    fields = []
    for field in schema.fields:
        inner = _all_repeated(field.dataType) if isinstance(field.dataType, T.StructType) else T.StringType()
        fields.append(T.StructField(field.name, T.ArrayType(inner)))
    return T.StructType(fields)


def _texts(node: Column, path: str) -> Column:
    """All texts at a path of a schema in which every element repeats, in document order."""
    head, *rest = path.split(".")
    values = node[head]
    for name in rest:
        values = _children(values, name)
    return values


def _children(elements: Column, name: str) -> Column:
    """All children with that name, of all elements."""
    present = F.filter(F.transform(elements, lambda element: element[name]), lambda found: found.isNotNull())
    return F.flatten(present)


def flatten_xml(df: DataFrame, column: str, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """One text column per leaf tag at depth 2 to 5.

    The last of repeated tags wins; with the same tag in several sections the later
    section of the schema wins. A missing tag is NULL: nothing carries over from the
    record before, and the columns do not depend on which record comes first.
    """
    by_tag: dict[str, list[str]] = {}
    for path, tag, depth in leaf_paths(schema):
        if 2 <= depth <= 5:
            by_tag.setdefault(tag, []).append(path)
    parsed = df.select(*keep, parse_xml(F.col(column), _all_repeated(schema)).alias("_doc"))
    last = lambda path: F.try_element_at(_texts(F.col("_doc"), path), F.lit(-1))
    columns = [F.coalesce(*[last(path) for path in reversed(paths)]).alias(tag) for tag, paths in by_tag.items()]
    return parsed.select(*keep, *columns)


# --- documents without a declared schema ------------------------------------------

TEXT_TAG = "#text"
WALK = {"excludeAttribute": "true", "valueTag": TEXT_TAG, "inferSchema": "false"}
MOST_TAGS = 5000


def _well_formed(body: Column) -> Column:
    return F.from_xml(body, "_bad string", {"columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"})["_bad"].isNull() & (F.trim(body) != "")


def discover_paths(df: DataFrame, column: str, depth: int = 5) -> DataFrame:
    """(path, n): every element with own text, or without children, at depth 1 to ``depth`` below the root, over all documents.

    A document is read as a variant, which needs no schema, and its objects and lists are opened level by level; the paths are
    counted by one aggregate with a map-side part. Malformed documents have no paths.
    """
    body = without_declaration(F.col(column))
    # The check and the variant are in different steps, so that no malformed document reaches the second parse.
    fine = df.select(body.alias("_body")).where(F.col("_body").isNotNull())
    rows = fine.withColumn("_body", F.when(_well_formed(F.col("_body")), F.col("_body"))).select(
        F.array().cast("array<string>").alias("path"), F.from_xml("_body", "variant", WALK).alias("v"))
    explode = df.sparkSession.tvf.variant_explode_outer
    for _ in range(depth + 1):
        for _ in range(2):  # a repeated element is a list of objects: one step opens the list, one the objects
            opened = rows.lateralJoin(explode(F.col("v").outer()))
            under = F.when(F.col("key").isNull() | (F.col("key") == TEXT_TAG), F.col("path")).otherwise(F.concat("path", F.array("key")))
            rows = opened.select(under.alias("path"), F.col("value").alias("v"))
    return rows.where(F.size("path").between(1, depth)).groupBy("path").agg(F.count(F.lit(1)).alias("n"))


def _schema_of(paths: Sequence[Sequence[str]]) -> T.StructType:
    """Nested struct of the paths; an element that has both text and children keeps its text under ``TEXT_TAG``."""
    tree: dict = {}
    for path in paths:
        node = tree
        for name in path:
            node = node.setdefault(name, {})

    def struct(node: dict, path: tuple) -> T.StructType:
        fields = [T.StructField(name, struct(inner, (*path, name)) if inner else T.StringType()) for name, inner in sorted(node.items())]
        if path in found:
            fields.append(T.StructField(TEXT_TAG, T.StringType()))
        return T.StructType(fields)

    found = {tuple(p) for p in paths}
    return struct(tree, ())


def _steps(schema: T.StructType, path: tuple = ()) -> list[tuple[str, ...]]:
    out = []
    for field in schema.fields:
        here = (*path, field.name)
        out += _steps(field.dataType, here) if isinstance(field.dataType, T.StructType) else [here]
    return out


def _texts_at(node: Column, path: Sequence[str]) -> Column:
    head, *rest = path
    values = node[head]
    for name in rest:
        values = _children(values, name)
    return values


def flatten_open(df: DataFrame, column: str, keep: Sequence[str] = (), depth: int = 5, most_tags: int = MOST_TAGS) -> DataFrame:
    """One text column per tag that any document has at depth 2 to ``depth`` below the root, in order of the names.

    Two passes: the first discovers the tags of all documents, the second parses each document once against the schema they
    make. The last of repeated tags wins; of several sections with the same tag, the one whose path sorts last. A missing tag is
    NULL, malformed and empty documents have only NULLs. A tag named like a kept column gets ``_xml`` at its end; tags that differ
    in case alone are one column, as they are for Spark's reader. More than ``most_tags`` paths are an error: no table would hold them.
    """
    found = discover_paths(df, column, depth).select("path").limit(most_tags + 1).collect()
    if len(found) > most_tags:
        raise ValueError(f"more than {most_tags} paths")
    spelled: dict[str, str] = {}
    for path in sorted(tuple(r["path"]) for r in found):
        for name in path:
            spelled.setdefault(name.lower(), name)
    paths = sorted({tuple(spelled[name.lower()] for name in r["path"]) for r in found})
    by_tag: dict[str, list[tuple[str, ...]]] = {}
    for path in _steps(_schema_of(paths)):
        named = path[:-1] if path[-1] == TEXT_TAG else path
        if 2 <= len(named) <= depth:
            by_tag.setdefault(named[-1], []).append(path)
    body = without_declaration(F.col(column))
    schema = _all_repeated(_schema_of(paths))
    parsed = df.select(*keep, F.from_xml(body, schema, {"mode": "PERMISSIVE", "valueTag": TEXT_TAG, "excludeAttribute": "true"}).alias("_doc")) if paths else df.select(*keep)
    taken = {name.lower() for name in keep}
    columns = []
    for tag, own in sorted(by_tag.items()):
        values = [F.try_element_at(F.filter(_texts_at(F.col("_doc"), path), lambda t: t.isNotNull()), F.lit(-1)) for path in sorted(own, reverse=True)]
        columns.append(F.coalesce(*values).alias(f"{tag}_xml" if tag.lower() in taken else tag))
    return parsed.select(*keep, *columns)
