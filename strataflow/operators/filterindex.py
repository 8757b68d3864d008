"""Very many filters in one scan: an index over the atoms of their conjunctions.

A filter that is a conjunction of comparisons is found through one of its atoms, the narrowest on a column
that is not null in the row: points by a sorted table of values, intervals by a segment tree over their
ends. The pairs of row and filter found so are the candidates; the atoms of a candidate that hold,
and those on null columns, are counted. All hold: the filter matches. None is false, and one at least is null:
it is unknown. Rows are taken by which of their columns are null, so that every filter has an atom to be found
by, unless all its columns are null: then it is unknown for all these rows.

The index holds the filters, not data, and travels to the tasks. Work for a row grows with the filters that
its narrowest atoms let through.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions.atoms import WHOLE, Atom
from strataflow.schema import STRING_COLUMNS

# Candidates that are counted at once, and rows whose filters are looked for at once.
PAIRS, ROWS = 1 << 18, 1024
# Parts of counts that are held before they are added up.
MOST_PARTS = 8


def _expanded(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of a list: which run, and each place in the list."""
    run = np.repeat(np.arange(len(counts)), counts)
    inner = np.arange(len(run)) - np.repeat(np.cumsum(counts) - counts, counts)
    return run, starts[run] + inner


class Runs:
    """Lists of filters by a whole number."""

    def __init__(self, keys: np.ndarray, filters: np.ndarray):
        order = np.argsort(keys, kind="stable")
        self.keys, self.filters = keys[order], filters[order]

    def counts(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = np.searchsorted(self.keys, wanted, "left")
        return first, np.searchsorted(self.keys, wanted, "right") - first


class Intervals:
    """A segment tree over closed intervals: the intervals that hold a value lie on its way to the root."""

    def __init__(self, low: np.ndarray, high: np.ndarray, filters: np.ndarray):
        self.ends = np.unique(np.concatenate([low, high]))
        self.height = int(2 * len(self.ends) + 1).bit_length()
        left = self.slots(low) + (1 << self.height)
        right = self.slots(high) + (1 << self.height) + 1
        nodes, owners = [], []
        while (open_ := left < right).any():
            for take, node in ((open_ & (left & 1 == 1), left), (open_ & (right & 1 == 1), right - 1)):
                nodes.append(node[take])
                owners.append(filters[take])
            left, right = (left + 1) >> 1, right >> 1
        self.runs = Runs(np.concatenate(nodes), np.concatenate(owners))

    def slots(self, values: np.ndarray) -> np.ndarray:
        """Ends have odd slots, the gaps between them even ones."""
        at = np.searchsorted(self.ends, values)
        same = self.ends[np.minimum(at, len(self.ends) - 1)] == values
        return 2 * at + same

    def nodes(self, values: np.ndarray) -> list[np.ndarray]:
        leaf = self.slots(values) + (1 << self.height)
        return [leaf >> level for level in range(self.height + 1)]


@dataclass
class Access:
    """How filters are found in rows with the same null columns."""

    points: dict[str, Runs]
    intervals: dict[str, Intervals]
    unknown: np.ndarray


class FilterIndex:
    """``filters`` by number, each with its atoms."""

    def __init__(self, filter_ids: Sequence[int], conjunctions: Sequence[Sequence[Atom]]):
        self.ids = np.array(filter_ids, dtype=np.int64)
        self.atoms = [list(c) for c in conjunctions]
        self.columns = sorted({a.column for c in self.atoms for a in c})
        self.needed = np.array([len(c) for c in self.atoms])
        self.first = np.cumsum(self.needed) - self.needed
        flat = [(f, a) for f, c in enumerate(self.atoms) for a in c]
        self.column = np.array([self.columns.index(a.column) for _, a in flat], dtype=np.int64)
        self.as_set = np.array([a.values is not None for _, a in flat], dtype=bool)
        # Values of sets get numbers by column; an atom holds a row's value if the pair is listed.
        self.numbers = {c: {} for c in self.columns}
        members = []
        for i, (_, a) in enumerate(flat):
            for v in a.values or ():
                members.append((i << 32) | self.numbers[a.column].setdefault(v, len(self.numbers[a.column])))
        self.members = np.sort(np.array(members, dtype=np.int64))
        kinds = {c: np.int64 if c in WHOLE else np.float64 for c in self.columns}
        self.low = {c: np.array([a.low if a.column == c else 0 for _, a in flat], dtype=kinds[c]) for c in self.columns if c not in STRING_COLUMNS}
        self.high = {c: np.array([a.high if a.column == c else 0 for _, a in flat], dtype=kinds[c]) for c in self.columns if c not in STRING_COLUMNS}
        self.access: dict[int, Access] = {}

    def way(self, nulls: int) -> Access:
        """Access for rows whose null columns are the given bits."""
        if nulls not in self.access:
            points, intervals, unknown = {}, {}, []
            for f, atoms in enumerate(self.atoms):
                able = [(a.cost, i) for i, a in enumerate(atoms) if not nulls >> self.columns.index(a.column) & 1]
                if not able:
                    unknown.append(f)
                    continue
                atom = atoms[min(able)[1]]
                if atom.values is not None:
                    numbers = self.numbers[atom.column]
                    points.setdefault(atom.column, []).extend((numbers[v], f) for v in atom.values)
                elif atom.low <= atom.high:
                    intervals.setdefault(atom.column, []).append((atom.low, atom.high, f))
            self.access[nulls] = Access(
                {c: Runs(*np.array(p, dtype=np.int64).T) for c, p in points.items()},
                {
                    c: Intervals(*(np.array(x, dtype=self.low[c].dtype) for x in list(zip(*p))[:2]), np.array([x[2] for x in p]))
                    for c, p in intervals.items()
                },
                np.array(unknown, dtype=np.int64),
            )
        return self.access[nulls]

    def prepared(self, table: pa.Table) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray], np.ndarray]:
        """Values, numbers of set values, and the bits of the null columns, for every row."""
        values, numbers, nulls = {}, {}, np.zeros(table.num_rows, dtype=np.int64)
        for bit, c in enumerate(self.columns):
            column = table.column(c).combine_chunks()
            absent = column.is_null().to_numpy(zero_copy_only=False)
            nulls |= absent.astype(np.int64) << bit
            if c not in STRING_COLUMNS:
                found = pc.fill_null(column, 0).to_numpy(zero_copy_only=False)
                # NaN is above every number; zero has one sign.
                values[c] = found if c in WHOLE else np.where(np.isnan(found), np.inf, found) + 0.0
            if self.numbers[c]:
                kind = pa.string() if c in STRING_COLUMNS else pa.int64() if c in WHOLE else pa.float64()
                known = self.numbers[c]
                if c in WHOLE:
                    # A value with decimals meets no whole number.
                    known = {int(v): n for v, n in known.items() if v == int(v)}
                told = column.cast(kind) if c in STRING_COLUMNS else pa.array(values[c], kind)
                at = pc.index_in(told, value_set=pa.array(list(known), kind))
                place = pc.fill_null(at, len(known)).to_numpy().astype(np.int64)
                numbers[c] = np.append(np.array(list(known.values()), dtype=np.int64), -1)[place]
        return values, numbers, nulls

    def candidates(self, way: Access, rows: np.ndarray, values: dict, numbers: dict) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of row and filter, each once, in lists of bounded size."""
        lists = [(runs, numbers[c][rows]) for c, runs in way.points.items()]
        lists += [(tree.runs, node) for c, tree in way.intervals.items() for node in tree.nodes(values[c][rows])]
        for runs, wanted in lists:
            first, counts = runs.counts(wanted)
            hit = np.nonzero(counts)[0]
            if not len(hit):
                continue
            group = np.cumsum(counts[hit]) // PAIRS
            for part in np.split(hit, np.nonzero(np.diff(group))[0] + 1):
                run, place = _expanded(first[part], counts[part])
                yield rows[part[run]], runs.filters[place]

    def counted(self, row: np.ndarray, owner: np.ndarray, values: dict, numbers: dict, nulls: np.ndarray):
        """Whether each pair matches, and whether it is unknown."""
        pair, atom = _expanded(self.first[owner], self.needed[owner])
        column, at = self.column[atom], row[pair]
        null = (nulls[at] >> column) & 1 == 1
        holds = np.zeros(len(atom), dtype=bool)
        for number, c in enumerate(self.columns):
            own = np.nonzero((column == number) & ~null)[0]
            if not len(own):
                continue
            sets = self.as_set[atom[own]]
            ranged, listed = own[~sets], own[sets]
            if len(ranged):
                v = values[c][at[ranged]]
                holds[ranged] = (self.low[c][atom[ranged]] <= v) & (v <= self.high[c][atom[ranged]])
            if len(listed):
                key = (atom[listed] << 32) | np.maximum(numbers[c][at[listed]], 0)
                place = np.minimum(np.searchsorted(self.members, key), len(self.members) - 1)
                holds[listed] = (self.members[place] == key) & (numbers[c][at[listed]] >= 0)
        true = np.bincount(pair[holds], minlength=len(owner))
        missing = np.bincount(pair[null], minlength=len(owner))
        needed = self.needed[owner]
        return true == needed, (true + missing == needed) & (missing > 0)

    def found(self, table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Rows, filters, and whether they match or are unknown; the rest is false."""
        values, numbers, nulls = self.prepared(table)
        for bits in np.unique(nulls).tolist():
            way, rows = self.way(bits), np.nonzero(nulls == bits)[0]
            for row, owner in self.candidates(way, rows, values, numbers):
                yield row, owner, *self.counted(row, owner, values, numbers, nulls)

    def unknown_rows(self, table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows with the filters all of whose columns are null in them."""
        _, _, nulls = self.prepared(table)
        for bits in np.unique(nulls).tolist():
            if len(self.way(bits).unknown):
                yield np.nonzero(nulls == bits)[0], self.way(bits).unknown


def _matched(index: FilterIndex, rows_: pa.StructArray) -> pa.ListArray:
    """Ids of the filters that each of a few rows matches."""
    table = pa.Table.from_arrays(rows_.flatten(), names=index.columns)
    rows, owners = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for row, owner, matches, _ in index.found(table):
        rows.append(row[matches])
        owners.append(owner[matches])
    row, owner = np.concatenate(rows), np.concatenate(owners)
    order = np.argsort(row, kind="stable")
    limits = np.searchsorted(row[order], np.arange(len(rows_) + 1))
    return pa.ListArray.from_arrays(pa.array(limits, pa.int32()), pa.array(index.ids[owner[order]]))


def matching(index: FilterIndex) -> Column:
    """Ids of the filters that each row matches."""

    @F.arrow_udf("array<long>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows_ in batches:
            found = [_matched(index, rows_.slice(at, ROWS)) for at in range(0, len(rows_), ROWS)]
            yield pa.concat_arrays(found) if found else pa.array([], pa.list_(pa.int64()))

    return ids(F.struct(*[F.col(c) for c in index.columns]))


def _added(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Counts of the same pair, from several parts, in one."""
    pair, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return pair, *(np.bincount(at, np.concatenate([p[i] for p in parts]), len(pair)).astype(np.int64) for i in (1, 2))


def indexed_counts(rows: DataFrame, keys: Sequence[str], index: FilterIndex) -> DataFrame:
    """``keys, filter_id, matched, unknown`` with the rows of each key that a filter matches or can't tell; no zeros."""
    keys = list(keys)
    wanted = rows.select(*[F.col(k).alias(f"key_{i}") for i, k in enumerate(keys)], *index.columns)
    key_schema = [f"key_{i} {rows.schema[k].dataType.simpleString()}" for i, k in enumerate(keys)]
    names = [f"key_{i}" for i in range(len(keys))]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(index.ids)
        for batch in batches:
            table = pa.Table.from_batches([batch])
            # Keys as structs are told apart in Arrow, whatever their types.
            keyed = table.select(names).append_column("row", pa.array(np.arange(table.num_rows)))
            grouped = keyed.group_by(names, use_threads=False).aggregate([("row", "list")])
            group = np.empty(table.num_rows, dtype=np.int64)
            members = grouped.column("row_list").combine_chunks()
            group[members.flatten().to_numpy()] = np.repeat(
                np.arange(len(members)), np.diff(members.offsets.to_numpy())
            )
            parts = [(np.zeros(0, dtype=np.int64),) * 3]
            for row, owner, matches, unknown in index.found(table):
                told = matches | unknown
                pair, at = np.unique(group[row[told]] * n + owner[told], return_inverse=True)
                yes = np.bincount(at, matches[told], len(pair)).astype(np.int64)
                parts.append((pair, yes, np.bincount(at, minlength=len(pair)) - yes))
                if len(parts) > MOST_PARTS:
                    parts = [_added(parts)]
            for rows_, owners in index.unknown_rows(table):
                own, each = np.unique(group[rows_], return_counts=True)
                pair = (own[:, None] * n + owners).ravel()
                parts.append((pair, np.zeros(len(pair), dtype=np.int64), np.repeat(each, len(owners))))
            pair, *sums = _added(parts)
            columns = [grouped.column(k).combine_chunks().take(pa.array(pair // n)) for k in names]
            columns += [pa.array(index.ids[pair % n]), pa.array(sums[0]), pa.array(sums[1])]
            yield pa.RecordBatch.from_arrays(columns, [*names, "filter_id", "matched", "unknown"])

    made = wanted.mapInArrow(count, ", ".join([*key_schema, "filter_id long, matched long, unknown long"]))
    summed = made.groupBy(*names, "filter_id").agg(F.sum("matched").alias("matched"), F.sum("unknown").alias("unknown"))
    return summed.select(*[F.col(n).alias(k) for n, k in zip(names, keys)], "filter_id", "matched", "unknown")
