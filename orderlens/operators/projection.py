"""Projections: nested pruning (P3), child slices (P5) and flattening for reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .rownum import top_n_per_group


def _tree(paths: list[str]) -> dict:
    tree: dict = {}
    for p in paths:
        node = tree
        for seg in p.split("."):
            node = node.setdefault(seg, {})
    return tree


def _build(expr: Column, dtype: T.DataType, subtree: dict) -> Column:
    if not subtree:
        return expr
    if isinstance(dtype, T.ArrayType):
        return F.transform(expr, lambda x: _build(x, dtype.elementType, subtree))
    fields = {f.name: f.dataType for f in dtype.fields}
    parts = [_build(expr[k], fields[k], subtree[k]).alias(k) for k in sorted(subtree)]
    return F.when(expr.isNotNull(), F.struct(*parts))


def prune_nested(df: DataFrame, paths: list[str]) -> list[Column]:
    """One Column per top-level root; paths sharing a prefix are merged; keys are in
    alphabetical order at every level (top level included)."""
    tree = _tree(paths)
    schema = {f.name: f.dataType for f in df.schema.fields}
    return [_build(F.col(k), schema[k], tree[k]).alias(k) for k in sorted(tree)]


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Flat report columns: nested struct leaves become ``a_b_c`` columns (arrays kept)."""
    cols: list[Column] = []

    def walk(expr: Column, dtype: T.DataType, name: str):
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                walk(expr[f.name], f.dataType, f"{name}{sep}{f.name}")
        else:
            cols.append(expr.alias(name))

    for f in df.schema.fields:
        walk(F.col(f.name), f.dataType, f.name)
    return df.select(*cols)


def slice_children(c, n: int) -> Column:
    """P5 on nested input: first n children in list order; null list stays null."""
    return F.slice(c if isinstance(c, Column) else F.col(c), 1, n)


def attach_children(parents: DataFrame, children: DataFrame, parent_key: str, child_key: str,
                    order_cols, child_cols: dict, n: int | None, name: str, max_parents: int | None = None,
                    truncated: str | None = None) -> DataFrame:
    """P5 on a child table: the children of each parent (``order_cols`` order) as an array ``name``
    of structs built from ``child_cols`` ({field: Column}); with ``n`` the first that many, and a
    boolean column ``truncated`` may tell whether there were more.

    ``parent_key`` identifies a parent row. ``max_parents`` is a proven bound on the parent rows (a
    page); the parent keys are then broadcast explicitly, otherwise the join strategy is left to
    AQE's runtime size check."""
    parent_keys = parents.select(F.col(parent_key).alias(child_key))
    if max_parents is not None:
        parent_keys = F.broadcast(parent_keys)
    kept = children.join(parent_keys, child_key, "left_semi")
    value = F.struct(*[c.alias(k) for k, c in child_cols.items()]).alias("v")
    if n is None:
        packed = kept.select(child_key, F.struct(*[F.col(c) if isinstance(c, str) else c for c in order_cols], value).alias("e"))
    else:  # one more than asked for tells whether there are more
        ranked = top_n_per_group(kept, [child_key], order_cols, n + 1, out="_pos")
        packed = ranked.select(child_key, F.struct(F.col("_pos"), value).alias("e"))
    grouped = packed.groupBy(child_key).agg(F.sort_array(F.collect_list("e")).alias("_arr"))
    values = F.transform("_arr", lambda e: e["v"])
    more = F.lit(False) if n is None else F.size("_arr") > n
    grouped = grouped.select(F.col(child_key).alias("_ck"), (values if n is None else F.slice(values, 1, n)).alias(name), more.alias("_more"))
    empty = F.array().cast(grouped.schema[name].dataType)
    out = parents.join(grouped, parents[parent_key] == grouped["_ck"], "left").drop("_ck")
    out = out.withColumn(name, F.coalesce(F.col(name), empty))
    return out.withColumn(truncated, F.coalesce("_more", F.lit(False))).drop("_more") if truncated else out.drop("_more")


def select_fields(df: DataFrame, paths=None, source=None) -> DataFrame:
    """The requested catalogue paths (defaults when none; required ids first; unknown paths
    are an error), merged into nested columns (P3)."""
    from ..plans.catalog import ORDER_SOURCE, resolve_field_paths
    return df.select(*prune_nested(df, resolve_field_paths(source or ORDER_SOURCE, paths)))


def select_bulk_fields(df: DataFrame, paths=None, source=None) -> DataFrame:
    """As P1 with the 20-field bulk default; child-list paths are an error."""
    from ..plans.catalog import ORDER_SOURCE, resolve_field_paths
    return df.select(*prune_nested(df, resolve_field_paths(source or ORDER_SOURCE, paths, bulk=True)))


def take_children(df: DataFrame, n=None, root: str = "lineItems") -> DataFrame:
    """P5 on nested input: the first n children (default 50, clamped to 1..100) of ``root``."""
    from ..plans.catalog import clamp
    return df.withColumn(root, slice_children(root, clamp(n, 50, 100)))
