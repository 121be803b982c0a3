"""Versioned asset tables as a folder convention over plain Parquet.

``<root>/<table>/gen=<g>/_v=<n>/part_<column>=<value>/`` holds the rows that commit ``n`` wrote and
``<root>/<table>/history/`` one row per commit. A commit never changes earlier files: it adds its
own folder and records which partitions it replaces. A read is one Parquet scan of a generation with
a filter on the partition columns ``_v`` and ``part_*``, so replaced and unwanted folders are pruned
before any file is opened, and a slice overwrite copies nothing it does not touch.

One writer per table at a time. A failed write leaves a folder no history row names; the next commit
overwrites it. With a catalog that has row-level operations (Iceberg, Delta), use those instead.
"""

from __future__ import annotations

import json
import warnings
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetloom.operators.schemas import conform, evolve, schema_diff
from assetloom.operators.slices import (
    Dim,
    LayoutField,
    Slice,
    StaticDim,
    check_layout,
    encoded_key,
    is_aligned,
    layout_diff,
    layout_of,
    layout_range,
    slice_predicate,
    with_layout,
)
from assetloom.operators.upsert import UpsertOptions, require_unique_keys, upsert
from assetloom.session import path_exists, spread_for_write

HISTORY = (
    "table_name string, generation int, version int, mode string, committed_at timestamp, run_id string,"
    " partition_key string, appended_rows bigint, total_rows bigint, missing boolean, schema_json string,"
    " layout_json string, replaced_json string, properties map<string,string>"
)
_NULL_KEY = "\x00"


class AssetTable:
    """One versioned table below ``root``."""

    def __init__(self, spark: SparkSession, root: str, name: str, version: int | None = None):
        self.spark, self.name, self.pinned = spark, name, version
        self.path = f"{root.rstrip('/')}/{name}"

    # --- history ---------------------------------------------------------------------------------

    def history(self) -> DataFrame:
        """One row per commit; empty when nothing was written yet."""
        try:
            return self.spark.read.schema(HISTORY).parquet(f"{self.path}/history")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], HISTORY)

    def _commits(self, upto: int | None = None) -> list[Row]:
        rows = self.history().orderBy("version").collect()
        return [r for r in rows if upto is None or r.version <= upto]

    def _stored(self, commits: Sequence[Row]) -> Row | None:
        written = [r for r in commits if not r.missing]
        return written[-1] if written else None

    # --- reading ---------------------------------------------------------------------------------

    def read(self, version: int | None = None, dims: Iterable[Dim] = (),
             columns: Sequence[str] | None = None, allow_missing: bool = False,
             schema: T.StructType | None = None) -> DataFrame:
        """A slice of the latest version, or of ``version``; that beats the version the table was
        opened with. A missing table is an error, or empty with ``allow_missing``."""
        if version is not None and self.pinned is not None and int(version) != self.pinned:
            warnings.warn(f"reading version {version} of {self.name!r}, not the configured {self.pinned}", stacklevel=2)
        wanted = self.pinned if version is None else int(version)
        commits = self._commits()
        if wanted is not None and wanted not in [r.version for r in commits]:
            raise ValueError(f"table {self.name!r} has no version {wanted}")
        commits = [r for r in commits if wanted is None or r.version <= wanted]
        if self._stored(commits) is None:
            if not allow_missing:
                raise FileNotFoundError(f"table {self.name!r} holds no data")
            if schema is None:
                declared = next((r.schema_json for r in commits if r.schema_json), "")
                if not declared:
                    raise ValueError(f"table {self.name!r} is missing and no schema was declared for it")
                schema = T.StructType.fromJson(json.loads(declared))
            empty = self.spark.createDataFrame([], schema)
            return empty.select(*columns) if columns else empty
        return self._live(commits, tuple(dims), columns)

    def read_slice(self, part: Slice, version: int | None = None) -> DataFrame:
        return self.read(version, part.dims, part.columns)

    def _live(self, commits: Sequence[Row], dims: Sequence[Dim] = (), columns=None,
              where: Column | None = None, layout_columns: bool = False) -> DataFrame:
        head = self._stored(commits)
        schema = T.StructType.fromJson(json.loads(head.schema_json))
        layout = _layout_from(head.layout_json)
        path = f"{self.path}/gen={head.generation}"
        # Every file of the generation may predate a column; Parquet fills those with null by name.
        full = T.StructType(
            [T.StructField(f.name, f.dataType, True, f.metadata) for f in schema]
            + [T.StructField("_v", T.IntegerType())]
            + [T.StructField(f.name, T.StringType()) for f in layout]
        )
        if head.total_rows == 0 and not path_exists(self.spark, path):  # created, not yet written
            df = self.spark.createDataFrame([], full)
        else:
            df = self.spark.read.schema(full).option("basePath", path).parquet(path)
        df = df.where(_live_predicate([r for r in commits if r.generation == head.generation]))
        if where is not None:
            df = df.where(where)
        if dims:
            df = df.where(_touched(dims, layout)).where(slice_predicate(dims, schema))
        names = list(columns) if columns else schema.fieldNames()
        return df.select(*names, *[f.name for f in layout] if layout_columns else [])

    def read_commit(self, version: int) -> DataFrame:
        """Only the rows one commit wrote."""
        commits = [r for r in self._commits() if r.version <= version]
        return self._live(commits, where=F.col("_v") == version)

    def layout(self) -> tuple[LayoutField, ...]:
        head = self._stored(self._commits())
        return _layout_from(head.layout_json) if head else ()

    # --- writing ---------------------------------------------------------------------------------

    def create(self, schema: T.StructType, layout: Sequence[LayoutField] = (), run_id: str = "",
               properties: dict[str, str] | None = None) -> int:
        """Declare an empty table, if there is none yet; returns its latest version."""
        commits = self._commits()
        if self._stored(commits) is not None:
            return commits[-1].version
        check_layout(layout, schema)
        tags = dict(run_id=run_id, partition_key="", properties=properties or {})
        version = commits[-1].version + 1 if commits else 0
        return self._record(None, version, "create", tags, schema=schema, layout=tuple(layout), replaced="all")

    def append(self, df: DataFrame | None, **options) -> int:
        return self._write(df, "append", **options)

    def overwrite(self, df: DataFrame | None, **options) -> int:
        return self._write(df, "overwrite", **options)

    def overwrite_slice(self, df: DataFrame | None, dims: Sequence[Dim], reject_outside: bool = False,
                        **options) -> int:
        """Delete the rows of the slice, then append all given rows, in or out of the slice."""
        if reject_outside and df is not None:
            inside = F.coalesce(slice_predicate(dims, df.schema), F.lit(False))
            if not df.where(~inside).isEmpty():
                raise ValueError("rows lie outside the slice")
        return self._write(df, "overwrite_slice", dims=tuple(dims), **options)

    def overwrite_partitions(self, df: DataFrame | None, **options) -> int:
        """Replace exactly the partitions present in the data."""
        return self._write(df, "overwrite_partitions", **options)

    def upsert(self, df: DataFrame, options: UpsertOptions, **write_options) -> int:
        """Merge rows by key; only partitions that hold a matched row are written again."""
        options = options.checked()
        require_unique_keys(df, options.join_cols)
        return self._write(df, "upsert", merge=options, **write_options)

    def relayout(self, layout: Sequence[LayoutField], **options) -> int:
        """Rewrite the table into another partition layout (also to none) as a new generation."""
        return self._write(None, "relayout", layout=tuple(layout), layout_mode="update", **options)

    def _write(self, df: DataFrame | None, mode: str, *, dims: tuple[Dim, ...] = (),
               layout: Sequence[LayoutField] | None = None, layout_mode: str = "error",
               schema_mode: str = "error", merge: UpsertOptions | None = None, run_id: str = "",
               partition_key: str = "", properties: dict[str, str] | None = None,
               writer_options: dict[str, str] | None = None) -> int:
        commits = self._commits()
        head = self._stored(commits)
        version = commits[-1].version + 1 if commits else 0
        tags = dict(run_id=run_id, partition_key=partition_key, properties=properties or {})
        if df is None and mode != "relayout":
            return self._record(head, version, mode, tags, missing=True)

        stored_layout = _layout_from(head.layout_json) if head else ()
        if layout is None:
            layout = stored_layout if head else layout_of(dims)
        wanted_layout = tuple(layout)
        if head is None:
            wanted_schema, generation, fresh = df.schema, 0, True
        else:
            stored = T.StructType.fromJson(json.loads(head.schema_json))
            wanted_schema = stored if mode == "relayout" else evolve(stored, df.schema, schema_mode)
            changed = layout_diff(stored_layout, wanted_layout)
            if any(changed.values()) and layout_mode != "update" and mode != "overwrite":
                raise ValueError(f"partition layout changed: {changed}")
            fresh = wanted_layout != stored_layout or _needs_rewrite(commits, head, stored, wanted_schema)
            generation = head.generation + 1 if fresh else head.generation
        check_layout(wanted_layout, wanted_schema)

        old = [r for r in commits if not r.missing]
        replaced: object = None
        if mode == "relayout":
            out, replaced = self._live(old), "all"
        else:
            out = conform(df, wanted_schema)
            if mode == "overwrite" or head is None:
                replaced = "all"
            elif mode == "overwrite_slice":
                out, replaced = self._slice_rows(out, old, dims, stored_layout, wanted_schema, fresh)
            elif mode == "upsert":
                out, replaced = self._merged_rows(out, old, merge, stored_layout, wanted_schema)
            elif mode == "overwrite_partitions":
                if not stored_layout:
                    replaced = "all"
            if fresh and head is not None and mode in ("append", "upsert", "overwrite_partitions"):
                if mode != "append" and replaced != "all":
                    raise ValueError(f"{mode} cannot change the layout or retype a column; use relayout first")
                if replaced is None:
                    out, replaced = conform(self._live(old), wanted_schema).unionByName(out), "all"

        target = f"{self.path}/gen={generation}/_v={version}"
        rows, written = self._save(out, target, wanted_layout, writer_options or {})
        if rows == 0 and not (head is not None and mode in ("relayout", "upsert", "overwrite_slice")):
            return self._record(head, version, mode, tags, missing=True, schema=wanted_schema)
        if mode == "overwrite_partitions" and replaced is None:
            replaced = {"columns": [f.name for f in stored_layout], "in": written}
        before = head.total_rows if head else 0
        if replaced == "all":
            total = rows
        elif replaced is None:
            total = before + rows
        else:
            total = before + rows - self._live(old, where=_replaced_predicate(replaced)).count()
        return self._record(head, version, mode, tags, generation=generation, schema=wanted_schema,
                            layout=wanted_layout, replaced=replaced, rows=rows, total=total)

    def _slice_rows(self, new, old, dims, layout, schema, fresh):
        """New rows plus the old rows that share a replaced partition but lie outside the slice."""
        by_column = {f.column: f for f in layout}
        covered = [d for d in dims if d.column in by_column and _is_prunable(d, by_column[d.column])]
        whole = len(covered) == len(dims) and all(is_aligned(d, by_column[d.column]) for d in covered)
        if fresh:
            kept = self._live(old).where(~F.coalesce(slice_predicate(dims, schema), F.lit(False)))
            return conform(kept, schema).unionByName(new), "all"
        replaced = [_touched_spec(d, by_column[d.column]) for d in covered] or "all"
        if whole:
            return new, replaced
        near = _replaced_predicate(replaced) if covered else F.lit(True)
        inside = F.coalesce(slice_predicate(dims, schema), F.lit(False))
        kept = self._live(old, where=near & ~inside)
        return conform(kept, schema).unionByName(new), replaced

    def _merged_rows(self, source, old, merge, layout, schema):
        keys = list(merge.join_cols)
        parts = [f.name for f in layout]
        if not parts:
            target, replaced = conform(self._live(old), schema), "all"
        else:
            # One pass over the key columns; Catalyst broadcasts the source keys when they are small.
            hit = self._live(old, columns=keys, layout_columns=True).join(source.select(*keys), keys, "left_semi")
            touched = [list(r) for r in hit.select(*parts).distinct().collect()]
            replaced = {"columns": parts, "in": touched}
            target = conform(self._live(old, where=_replaced_predicate(replaced)), schema)
        return upsert(target, source, keys, merge.when_matched_update_all, merge.when_not_matched_insert_all), replaced

    def _save(self, df: DataFrame, target: str, layout, options) -> tuple[int, list[list[str]]]:
        """Write one commit folder; returns its row count (file footers only) and its partitions."""
        parts = [f.name for f in layout]
        out = with_layout(df, layout)
        if parts:
            out = spread_for_write(out, *parts)
        settings = {"compression": "zstd", **options}
        out.write.mode("overwrite").options(**settings).partitionBy(*parts).parquet(target)
        try:
            schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema]
                                  + [T.StructField(p, T.StringType()) for p in parts])
            written = self.spark.read.schema(schema).parquet(target)
        except AnalysisException:  # no file at all: an empty frame written by partition
            return 0, []
        if not parts:
            return written.count(), []
        counts = written.groupBy(*parts).count().collect()
        return sum(r["count"] for r in counts), [[r[p] for p in parts] for r in counts]

    def _record(self, head: Row | None, version: int, mode: str, tags: dict, *, missing: bool = False,
                generation: int | None = None, schema: T.StructType | None = None, layout=None,
                replaced=None, rows: int = 0, total: int | None = None) -> int:
        if layout is not None:
            layout_json = json.dumps([[f.column, f.transform, f.prefix] for f in layout])
        else:
            layout_json = head.layout_json if head else "[]"
        values = {
            "table_name": self.name, "generation": generation if generation is not None else (head.generation if head else 0),
            "version": version, "mode": mode, "run_id": tags["run_id"], "partition_key": tags["partition_key"],
            "appended_rows": rows, "total_rows": total if total is not None else (head.total_rows if head else 0),
            "missing": missing,
            "schema_json": json.dumps(schema.jsonValue()) if schema is not None else (head.schema_json if head else ""),
            "layout_json": layout_json, "replaced_json": json.dumps(replaced),
        }
        pairs = [F.lit(str(x)) for kv in tags["properties"].items() for x in kv]
        row = self.spark.range(0, 1, 1, 1).select(
            *[F.lit(v).alias(k) for k, v in values.items()], F.current_timestamp().alias("committed_at"),
            F.create_map(*pairs).cast("map<string,string>").alias("properties"))
        entry = row.select(*[F.col(c.name).cast(c.dataType) for c in T.DataType.fromDDL(HISTORY)])
        entry.write.mode("append").parquet(f"{self.path}/history")
        return version

    # --- facts -----------------------------------------------------------------------------------

    def last_version(self) -> Row | None:
        commits = self._commits()
        return commits[-1] if commits else None

    def has_tag(self, **tags: str) -> bool:
        """Whether a commit carries all these properties (used to skip a replayed batch)."""
        cond = reduce(lambda a, b: a & b, [F.element_at("properties", k) == v for k, v in tags.items()])
        return not self.history().where(cond).isEmpty()

    def create_view(self, name: str | None = None) -> None:
        self.read().createOrReplaceTempView(name or self.name)


def _layout_from(text: str | None) -> tuple[LayoutField, ...]:
    return tuple(LayoutField(*parts) for parts in json.loads(text or "[]"))


def _needs_rewrite(commits, head, stored: T.StructType, wanted: T.StructType) -> bool:
    """A retyped column, or one dropped earlier and added again, must not meet its old files."""
    diff = schema_diff(stored, wanted)
    if diff.retyped:
        return True
    seen: set[str] = set()
    for r in commits:
        if r.generation == head.generation and not r.missing:
            seen.update(f["name"] for f in json.loads(r.schema_json)["fields"])
    return any(name in seen for name in diff.added)


def _is_prunable(dim: Dim, f: LayoutField) -> bool:
    return isinstance(dim, StaticDim) == (f.transform == "identity")


def _touched_spec(dim: Dim, f: LayoutField) -> dict:
    if isinstance(dim, StaticDim):
        return {"columns": [f.name], "in": [[encoded_key(k)] for k in dim.keys]}
    return {"columns": [f.name], "between": list(layout_range(dim, f.transform))}


def _touched(dims: Sequence[Dim], layout: Sequence[LayoutField]) -> Column:
    """The partitions a slice can meet, as a filter on the layout columns only."""
    by_column = {f.column: f for f in layout}
    specs = [_touched_spec(d, by_column[d.column]) for d in dims
             if d.column in by_column and _is_prunable(d, by_column[d.column])]
    return _replaced_predicate(specs)


def _replaced_predicate(spec) -> Column:
    if spec == "all":
        return F.lit(True)
    if isinstance(spec, list):
        return reduce(lambda a, b: a & b, [_replaced_predicate(s) for s in spec], F.lit(True))
    columns = [F.coalesce(F.col(c), F.lit(_NULL_KEY)) for c in spec["columns"]]
    if "between" in spec:
        low, high = spec["between"]
        return (F.col(spec["columns"][0]) >= low) & (F.col(spec["columns"][0]) <= high)
    if not spec["in"]:
        return F.lit(False)
    values = [[_NULL_KEY if v is None else v for v in key] for key in spec["in"]]
    if len(columns) == 1:
        return columns[0].isin(*[v[0] for v in values])
    return F.concat_ws("\x01", *columns).isin(*["\x01".join(v) for v in values])


def _live_predicate(commits: Sequence[Row]) -> Column:
    """Rows still standing after the given commits, by ``_v`` and the layout columns.

    Only the last replacement of each key and window counts, so the filter grows with the partitions, not the commits.
    """
    written = [r for r in commits if not r.missing]
    last_full = max((r.version for r in written if r.replaced_json == '"all"'), default=0)
    known = [r.version for r in written if r.version >= last_full]
    cond = (F.col("_v") >= last_full) & (F.col("_v") <= max(known))
    if len(known) != max(known) - last_full + 1:
        cond = cond & F.col("_v").isin(*known)
    by_key: dict[tuple[str, ...], dict[str, int]] = {}
    windows: dict[str, dict[tuple[str, str], int]] = {}
    rest: dict[str, tuple[object, int]] = {}
    for r in written:
        spec = json.loads(r.replaced_json)
        spec = spec[0] if isinstance(spec, list) and len(spec) == 1 else spec
        if r.version <= last_full or not spec:
            continue
        if isinstance(spec, dict) and "in" in spec:
            by_key.setdefault(tuple(spec["columns"]), {}).update({_joined_key(k): r.version for k in spec["in"]})
        elif isinstance(spec, dict):
            windows.setdefault(spec["columns"][0], {})[tuple(spec["between"])] = r.version
        else:
            rest[json.dumps(spec)] = (spec, r.version)
    v, conds = F.col("_v"), [cond]
    for columns, latest in by_key.items():
        since = F.map_from_arrays(F.lit(list(latest)), F.lit(list(latest.values())))
        conds.append(v >= F.coalesce(F.try_element_at(since, _key_text(columns)), F.lit(0)))
    for column, latest in windows.items():
        lows, highs = (F.lit([w[i] for w in latest]) for i in (0, 1))
        spans = F.arrays_zip(lows.alias("low"), highs.alias("high"), F.lit(list(latest.values())).alias("since"))
        conds.append(~F.coalesce(F.exists(spans, lambda s: (v < s["since"]) & (F.col(column) >= s["low"]) & (
            F.col(column) <= s["high"])), F.lit(False)))
    conds += [~((v < version) & F.coalesce(_replaced_predicate(spec), F.lit(False))) for spec, version in rest.values()]
    return _all_of(conds)


def _joined_key(key: Sequence[str | None]) -> str:
    return "\x01".join(_NULL_KEY if v is None else v for v in key)


def _key_text(columns: Sequence[str]) -> Column:
    return F.concat_ws("\x01", *[F.coalesce(F.col(c), F.lit(_NULL_KEY)) for c in columns])


def _all_of(conds: list[Column]) -> Column:
    """A balanced conjunction, so that its depth stays small."""
    half = len(conds) // 2
    return conds[0] if len(conds) == 1 else _all_of(conds[:half]) & _all_of(conds[half:])
