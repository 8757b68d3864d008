"""Many named filters over all uploads in one pass."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import batched

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions.atoms import conjunction
from strataflow.functions.predicates import compile_predicate
from strataflow.operators.filterindex import FilterIndex, indexed_counts, matching
from strataflow.operators.ordered import with_running
from strataflow.schema import ACTIVE, check_columns
from strataflow.session import local_table, stage


@dataclass(frozen=True)
class FilterSpec:
    """A named filter: predicate text (None passes every row), columns, communities."""

    filter_id: int
    text: str | None = None
    selections: tuple[str, ...] = ()
    communities: tuple[int, ...] = ()
    name: str = ""


# Filters evaluated in one plan; more are taken through an index, what it can't hold in groups.
FILTERS_PER_SCAN = 200


def specs_from_registry(filters: DataFrame) -> list[FilterSpec]:
    """Active filters of a registry table; predicates are plan text, so they are needed here."""
    columns = ["filter_id", "name", "filter", "selections", "communities"]
    rows = filters.where(F.col("status") == ACTIVE).select(*columns).orderBy("filter_id").toLocalIterator()
    return [
        FilterSpec(r.filter_id, r.filter, tuple(r.selections or ()), tuple(r.communities or ()), r.name or "")
        for r in rows
    ]


def _groups(specs: Iterable[FilterSpec]) -> Iterator[tuple[FilterSpec, ...]]:
    return batched(specs, FILTERS_PER_SCAN)


def filter_rows(rows: DataFrame, spec: FilterSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Selected columns of the rows that match."""
    return rows.where(compile_predicate(spec.text)).select(*keep, *check_columns(list(spec.selections)))


def complement(rows: DataFrame, spec: FilterSpec, keep: Sequence[str] = ()) -> DataFrame:
    """One constant per row that is known not to match."""
    return rows.where(~compile_predicate(spec.text)).select(*keep, F.lit(1).alias("unmatched"))


def count_matches(rows: DataFrame, keys: Sequence[str], specs: Iterable[FilterSpec]) -> DataFrame:
    """Matched, unmatched and unknown rows per key and filter, from a single scan.

    Filters beyond ``FILTERS_PER_SCAN`` are taken through an index over their conditions; those of another form
    are evaluated one by one, in groups with a scan each.
    """
    index, rest = split_specs(specs)
    parts = [_count_group(rows, keys, group) for group in _groups(rest)]
    if index is not None:
        parts.append(_count_indexed(rows, keys, index))
    return reduce(DataFrame.unionByName, parts)


def split_specs(specs: Iterable[FilterSpec]) -> tuple[FilterIndex | None, list[FilterSpec]]:
    """An index over the filters it can hold, if there are many, and the others."""
    specs = list(specs)
    if len(specs) <= FILTERS_PER_SCAN:
        return None, specs
    found = [(s, conjunction(s.text)) for s in specs]
    held = [(s.filter_id, atoms) for s, atoms in found if atoms is not None]
    rest = [s for s, atoms in found if atoms is None]
    return (FilterIndex(*zip(*held)) if held else None), rest


def id_array(ids: Iterable[int]) -> Column:
    """Many whole numbers as one constant."""
    return F.split(F.lit(",".join(map(str, ids))), ",").cast("array<long>")


def _count_indexed(rows: DataFrame, keys: Sequence[str], index: FilterIndex) -> DataFrame:
    # Written: every row of a key with every filter is counted against this small table.
    told = stage(indexed_counts(rows, keys, index))
    total = stage(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")))
    every = total.withColumn("filter_id", F.explode(id_array(index.ids.tolist())))
    renamed = told.select(*[F.col(k).alias(f"_of_{k}") for k in keys], F.col("filter_id").alias("_of_filter"), "matched", "unknown")
    on = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys], F.col("filter_id") == F.col("_of_filter")
    )
    counted = every.join(renamed, on, "left")
    matched, unknown = F.coalesce("matched", F.lit(0)), F.coalesce("unknown", F.lit(0))
    return counted.select(
        *keys, "filter_id", matched.alias("matched"), (F.col("_rows") - matched - unknown).alias("unmatched"), unknown.alias("unknown")
    )


def _count_group(rows: DataFrame, keys: Sequence[str], specs: Iterable[FilterSpec]) -> DataFrame:
    aggregates, records = [], []
    for spec in specs:
        p, tag = compile_predicate(spec.text), f"_{spec.filter_id}"
        aggregates += [
            F.count_if(p).alias(f"m{tag}"),
            F.count_if(~p).alias(f"u{tag}"),
            F.count_if(p.isNull()).alias(f"n{tag}"),
        ]
        records.append(
            F.struct(
                F.lit(spec.filter_id).cast("long").alias("filter_id"),
                F.col(f"m{tag}").alias("matched"),
                F.col(f"u{tag}").alias("unmatched"),
                F.col(f"n{tag}").alias("unknown"),
            )
        )
    counted = rows.groupBy(*keys).agg(*aggregates)
    return counted.select(*keys, F.inline(F.array(*records)))


def with_empty_uploads(
    counts: DataFrame, announced: DataFrame, keys: Sequence[str], specs: Iterable[FilterSpec]
) -> DataFrame:
    """Counts of every announced upload and filter; an upload without rows has zeros for all of them."""
    filters = id_array(s.filter_id for s in specs)
    expected = announced.select(*keys).distinct().withColumn("filter_id", F.explode(filters))
    zeros = {c: F.lit(0).cast("long") for c in ("matched", "unmatched", "unknown")}
    missing = expected.join(counts, [*keys, "filter_id"], "left_anti").withColumns(zeros)
    return counts.unionByName(missing)


def completeness(counts: DataFrame, announced: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Compare the three counts with the announced rows; see ``with_empty_uploads`` for uploads without rows."""
    seen = F.col("matched") + F.col("unmatched") + F.col("unknown")
    joined = announced.select(*keys, F.col("rows").cast("long").alias("rows")).join(counts, list(keys), "left")
    return joined.withColumn("complete", F.coalesce(seen, F.lit(0)) == F.col("rows"))


def all_filters_done(checked: DataFrame, keys: Sequence[str], active: int) -> DataFrame:
    """Uploads for which every active filter is complete."""
    return checked.groupBy(*keys).agg(
        F.count_distinct(F.when(F.col("complete"), F.col("filter_id"))).alias("filters_done")
    ).withColumn("done", F.col("filters_done") == active)


def fan_out(rows: DataFrame, specs: Iterable[FilterSpec]) -> DataFrame:
    """Each row once per filter it matches, with ``filter_id``; see :func:`count_matches` for many filters."""
    index, rest = split_specs(specs)
    parts = []
    for group in _groups(rest) if rest else ((),):
        hits = [F.when(compile_predicate(s.text), F.lit(s.filter_id).cast("long")) for s in group]
        found = [F.array_compact(F.array(*hits))] if hits else []
        if index is not None and not parts:
            found.append(matching(index))
        parts.append(rows.withColumn("filter_id", F.explode(F.concat(*found))))
    return reduce(DataFrame.unionByName, parts)


def community_gate(uploads: DataFrame, specs: Iterable[FilterSpec], community: str = "community_id") -> DataFrame:
    """Each upload with each filter and whether the filter's communities hold the upload's."""
    pairs = F.array(
        *[
            F.struct(
                F.lit(s.filter_id).cast("long").alias("filter_id"),
                (F.col(community).isin(*s.communities) if s.communities else F.lit(False)).alias("belongs"),
            )
            for s in specs
        ]
    )
    return uploads.select(*uploads.columns, F.inline(pairs))


def belonging(uploads: DataFrame, specs: Iterable[FilterSpec], community: str = "community_id") -> DataFrame:
    """Each upload with the filters whose communities hold its own."""
    pairs = sorted({(s.filter_id, c) for s in specs for c in s.communities})
    table = local_table(uploads.sparkSession, pairs, "filter_id long, _community long")
    return uploads.join(table, F.col(community) == F.col("_community")).drop("_community")


def data_ready(counts: DataFrame, upload: str, identifier: str, before: DataFrame | None = None) -> DataFrame:
    """Slice of each filter's output that an upload produced; a slice without rows is valid.

    ``before`` (``filter_id, rows``) is the output of each filter so far: the slices of a
    later run go on after it.
    """
    ordered = counts.withColumn("count", F.col("matched"))
    ordered = with_running(ordered, ["filter_id"], upload, {"_end": ("sum", F.col("count"))})
    end = F.col("_end")
    if before is not None:
        ordered = ordered.join(before.select("filter_id", F.col("rows").alias("_before")), "filter_id", "left")
        end = end + F.coalesce("_before", F.lit(0))
    return ordered.select("filter_id", identifier, upload, (end - 1).alias("last_offset"), F.col("count"))


def selection_table(specs: Iterable[FilterSpec], spark) -> DataFrame:
    """Filter ids with their selected columns in order."""
    rows = [(s.filter_id, i, c) for s in specs for i, c in enumerate(check_columns(list(s.selections)))]
    return local_table(spark, rows, "filter_id long, place int, column string")
