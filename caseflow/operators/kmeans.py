"""M7: Lloyd's K-means from several starts at once, in exact whole numbers.

Points are sparse vectors ``idx array<int>, w array<int>`` whose weights were multiplied by
``SCALE`` and rounded.  Centres are rounded to the same grid, so every product and sum is
a whole number below 2^53 or held wider, and no result depends on the order of rows,
tasks or starts: any engine that follows the rules below gets the same clusters.

* Seeding: start s takes as its first centre the point of smallest u, then k - 1 times the
  point of smallest ``-ln(u) / d``, d its squared distance to the start's nearest centre so
  far: sampling in proportion to d.  u is (h + 0.5) / 2^52, h the first 13 hexadecimal
  digits of the MD5 of ``<id>:<seed + s>:<step>``.  Points at distance 0 come last; ties go to
  the smaller id, null first, then to the smaller vector.
* A point belongs to the centre with the least ``|c|^2 - 2 x.c``, ties to the smaller number.
* A centre moves to the mean of its points, each component rounded half up; one without
  points stays.  A start ends when no centre moved by more than ``tol``, or after
  ``max_iter`` steps; the start of least cost wins, ties to the smaller number.

Points are staged as blocks of plain buffers, and a step is one reading of them for all
starts that have not ended: the stacked centres (starts x k x terms, bounded by the
parameters) are broadcast, a task keeps one sum per start and centre, and one row of each
goes through a shuffle by (start, centre).  At ``MARKED`` steps the blocks are staged again
with every point's distances.  A centre that has moved by m since then is at most m nearer or
farther, so later steps measure only the points whose centre these bounds leave open, and
add up only those that changed it; the result is that of measuring all.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.session import stage

SCALE = 2**20
BLOCK = 200_000  # weights of one block of points
#: Steps before which the distances are staged; the first centres move too far to be of use.
MARKED = frozenset(3 * 2**i - 1 for i in range(16))
WIDE = 16  # centres from which points are multiplied one by one
MARGIN = 1.0  # above the rounding of a staged distance
BLOCK_SCHEMA = "idx binary, w binary, sizes binary"
MARK_SCHEMA = f"{BLOCK_SCHEMA}, near binary, own binary"
SEED_SCHEMA = "start int, race double, id string, idx array<int>, w array<int>"
SUM_SCHEMA = "start int, cluster int, n long, sums binary"


class Points:
    """Some sparse vectors, flat."""

    def __init__(self, idx: np.ndarray, w: np.ndarray, sizes: np.ndarray) -> None:
        self.idx, self.w, self.sizes = idx, w.astype(np.float64), sizes
        self.starts = np.cumsum(sizes) - sizes
        self.filled = np.flatnonzero(sizes)
        self.norms = self._by_point(self.w**2)

    @classmethod
    def of_lists(cls, batch: pa.RecordBatch) -> Points:
        idx, w = batch.column("idx"), batch.column("w")
        sizes = pc.fill_null(pc.list_value_length(idx), 0).to_numpy(zero_copy_only=False)
        return cls(idx.flatten().to_numpy(zero_copy_only=False), w.flatten().to_numpy(zero_copy_only=False), sizes.astype(np.int64))

    @classmethod
    def of_blocks(cls, batches: Iterator[pa.RecordBatch]) -> Iterator[Points]:
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("idx", "w", "sizes")), strict=True):
                yield cls.of_buffers(*row)

    @classmethod
    def of_buffers(cls, *row: pa.Scalar) -> Points:
        idx, w, sizes = (np.frombuffer(x.as_buffer(), dtype=np.int32) for x in row)
        return cls(idx, w, sizes.astype(np.int64))

    def take(self, places: np.ndarray) -> Points:
        sizes = self.sizes[places]
        at = np.arange(sizes.sum()) + np.repeat(self.starts[places] - (np.cumsum(sizes) - sizes), sizes)
        return Points(self.idx[at], self.w[at], sizes)

    def _by_point(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.sizes))
        if len(self.filled):
            out[self.filled] = np.add.reduceat(values, self.starts[self.filled])
        return out

    def distances(self, centres: np.ndarray) -> np.ndarray:
        """``|c|^2 - 2 x.c`` of every point and row of ``centres(m, terms)``, exact."""
        out = np.zeros((len(self.sizes), len(centres)))
        if len(centres) < WIDE:
            for j, c in enumerate(centres):
                out[:, j] = self._by_point(c[self.idx] * self.w)
        else:
            columns, starts, ends = np.ascontiguousarray(centres.T), self.starts.tolist(), (self.starts + self.sizes).tolist()
            for i in self.filled.tolist():
                part = slice(starts[i], ends[i])
                np.matmul(self.w[part], columns[self.idx[part]], out=out[i])
        return (centres * centres).sum(axis=1) - 2 * out


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of about ``BLOCK`` weights as plain buffers."""
    for batch in batches:
        points = Points.of_lists(batch)
        w, ends, low = points.w.astype(np.int32), points.starts + points.sizes, 0
        rows = []
        while low < batch.num_rows:
            start = points.starts[low]
            high = max(low + 1, int(np.searchsorted(ends, start + BLOCK, "right")))
            stop = ends[high - 1]
            rows.append((points.idx[start:stop].astype(np.int32).tobytes(), w[start:stop].tobytes(), points.sizes[low:high].astype(np.int32).tobytes()))
            low = high
        columns = zip(*rows, strict=True) if rows else [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], names=["idx", "w", "sizes"])


def uniform(key: str | None, seed: int, step: int) -> float:
    digest = hashlib.md5(f"{'' if key is None else key}:{seed}:{step}".encode()).hexdigest()
    return (int(digest[:13], 16) + 0.5) / 2**52


def _seeder(centres: list[np.ndarray], step: int, first_seed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each batch's best next centre for every start; ``centres[s]`` is (step, terms)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            points, ids = Points.of_lists(batch), batch.column("id").to_pylist()
            out = []
            for s in range(len(centres)):
                u = np.array([uniform(i, first_seed + s, step) for i in ids])
                if step:
                    far = points.norms + points.distances(centres[s]).min(axis=1)
                    with np.errstate(divide="ignore"):
                        race = np.where(far > 0, -np.log(u) / far, np.inf)
                else:
                    race = u
                # all points that share the least race; Spark's ordering settles ties
                out += [(s, float(race[i]), ids[i], batch.column("idx")[int(i)].as_py(), batch.column("w")[int(i)].as_py()) for i in _least(race, ids)]
            columns = list(zip(*out, strict=True))
            kinds = (pa.int32(), pa.float64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["start", "race", "id", "idx", "w"])

    return run


def _least(race: np.ndarray, ids: list[str | None]) -> list[int]:
    """Places of the least race, and among them of the least id, null first."""
    places = np.flatnonzero(race == race.min())
    best = min((ids[i] is not None, ids[i] or "") for i in places)
    return [i for i in places if (ids[i] is not None, ids[i] or "") == best]


def first_centres(points: DataFrame, k: int, terms: int, n_init: int, seed: int = 42) -> np.ndarray:
    """First centres ``(n_init, k, terms)``."""
    chosen = np.zeros((n_init, k, terms))
    rows = points.select("id", "idx", "w")
    for step in range(k):
        found = rows.mapInArrow(_seeder([c[:step] for c in chosen], step, seed), SEED_SCHEMA)
        best = found.groupBy("start").agg(F.min(F.struct("race", "id", "idx", "w")).alias("b")).collect()
        for r in best:
            chosen[r["start"], step, r["b"]["idx"]] = r["b"]["w"]
    return chosen


def _marker(centres: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks with each point's distances ``near`` to ``centres(starts, k, terms)`` and its own centres ``own``."""
    m, k, terms = centres.shape
    packed = centres.astype(np.int32).reshape(m * k, terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stacked = packed.astype(np.float64)
        for batch in batches:
            marks = []
            for row in zip(*(batch.column(c) for c in ("idx", "w", "sizes")), strict=True):
                points = Points.of_buffers(*row)
                near = points.distances(stacked)
                own = near.reshape(-1, m, k).argmin(axis=2)
                marks.append((np.sqrt(near + points.norms[:, None]).astype(np.float32).tobytes(), own.astype(np.int32).tobytes()))
            columns = zip(*marks, strict=True) if marks else [()] * 2
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("idx", "w", "sizes")), *(pa.array(c, pa.binary()) for c in columns)], names=["idx", "w", "sizes", "near", "own"])

    return run


def _own(points: Points, near: np.ndarray, was: np.ndarray, centres: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The points' centres now: of ``centres(starts, k, terms)``, each moved by ``moves(starts, k)`` since ``near`` and ``was``."""
    own, at = was.copy(), np.arange(len(was))
    for s in range(len(centres)):
        least, most = near[:, s] - moves[s] - MARGIN, near[at, s, was[:, s]] + moves[s][was[:, s]] + MARGIN
        least[at, was[:, s]] = np.inf
        if len(open_ := np.flatnonzero(least.min(axis=1) <= most)):
            own[open_, s] = points.take(open_).distances(centres[s]).argmin(axis=1)
    return own


def _summer(centres: np.ndarray, starts: list[int], marked: list[int] | None = None, moves: np.ndarray | None = None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's sums of the points of every centre of ``centres(starts, k, terms)``.

    ``marked``: the starts that the blocks hold marks of.  With ``moves``, the sums are what
    changed since the marks, else those of all points.
    """
    m, k, terms = centres.shape
    packed = centres.astype(np.int32).reshape(m * k, terms)
    places = [marked.index(s) for s in starts] if marked else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts, seen = np.zeros((m, k * terms)), np.zeros((m, k), dtype=np.int64), np.zeros((m, k), dtype=bool)
        stacked = packed.astype(np.float64)

        def add(points: Points, s: int, cluster: np.ndarray, sign: int) -> None:
            n = np.bincount(cluster, minlength=k)
            counts[s] += sign * n
            seen[s] |= n > 0
            sums[s] += sign * np.bincount(np.repeat(cluster, points.sizes) * terms + points.idx, weights=points.w, minlength=k * terms)

        for batch in batches:
            columns = ("idx", "w", "sizes", "near", "own") if marked else ("idx", "w", "sizes")
            for row in zip(*(batch.column(c) for c in columns), strict=True):
                points = Points.of_buffers(*row[:3])
                if not marked:
                    own = points.distances(stacked).reshape(-1, m, k).argmin(axis=2)
                else:
                    own = was = np.frombuffer(row[4].as_buffer(), dtype=np.int32).reshape(-1, len(marked))[:, places]
                    if moves is not None:
                        near = np.frombuffer(row[3].as_buffer(), dtype=np.float32).reshape(-1, len(marked), k)[:, places]
                        own = _own(points, near, was, stacked.reshape(m, k, terms), moves)
                for s in range(m):
                    if moves is None:
                        add(points, s, own[:, s], 1)
                    elif len(changed := np.flatnonzero(own[:, s] != was[:, s])):
                        part = points.take(changed)
                        add(part, s, own[changed, s], 1)
                        add(part, s, was[changed, s], -1)
        rows = [(s, c) for s in range(m) for c in range(k) if seen[s, c]]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([starts[s] for s, _ in rows], pa.int32()), pa.array([c for _, c in rows], pa.int32()), pa.array([int(counts[s, c]) for s, c in rows], pa.int64()),
                pa.array([sums[s, c * terms : (c + 1) * terms].astype(np.int64).tobytes() for s, c in rows], pa.binary()),
            ],
            names=["start", "cluster", "n", "sums"],
        )

    return run


def _add_up(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tasks' sums of one start and centre, added one by one."""
    total, n = None, 0
    for batch in batches:
        n += pc.sum(batch.column("n")).as_py()
        for part in batch.column("sums"):
            values = np.frombuffer(part.as_buffer(), dtype=np.int64)
            total = values.copy() if total is None else total + values
    start, cluster = (k.as_py() for k in key)
    columns = [pa.array([start], pa.int32()), pa.array([cluster], pa.int32()), pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())]
    yield pa.RecordBatch.from_arrays(columns, names=["start", "cluster", "n", "sums"])


def _coster(centres: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's cost of every start of ``centres(starts, k, terms)``."""
    m, k, terms = centres.shape
    packed = centres.astype(np.int32).reshape(m * k, terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs, stacked = [0] * m, packed.astype(np.float64)
        for points in Points.of_blocks(batches):
            far = points.distances(stacked).reshape(-1, m, k).min(axis=2) + points.norms[:, None]
            costs = [c + int(f) for c, f in zip(costs, far.astype(np.int64).sum(axis=0), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(m), pa.int32()), pa.array([Decimal(c) for c in costs], pa.decimal128(38, 0))], names=["start", "cost"])

    return run


def lloyd(points: DataFrame, centres: np.ndarray, max_iter: int = 300, tol: float = 1e-4) -> tuple[np.ndarray, list[int]]:
    """Final centres ``(starts, k, terms)`` from ``centres``, and the cost of each start at them."""
    rows = blocks = stage(points.select("idx", "w").mapInArrow(_pack, BLOCK_SCHEMA))
    centres = centres.copy()
    active, marked, at_marks = list(range(len(centres))), None, centres
    sums, sizes = np.zeros(centres.shape, dtype=np.int64), np.zeros(centres.shape[:2], dtype=np.int64)
    limit = math.floor((tol * SCALE) ** 2)
    for step in range(max_iter + 1):
        if fresh := step in MARKED:
            rows = stage(blocks.mapInArrow(_marker(centres[active]), MARK_SCHEMA))
            marked, at_marks = active, centres.copy()
        whole = fresh or not marked
        moves = None if whole else np.sqrt(((centres[active] - at_marks[active]) ** 2).sum(axis=2))
        found = rows.mapInArrow(_summer(centres[active], active, marked, moves), SUM_SCHEMA).groupBy("start", "cluster").applyInArrow(_add_up, SUM_SCHEMA).collect()
        new_sums, new_sizes = (np.zeros_like(sums), np.zeros_like(sizes)) if whole else (sums.copy(), sizes.copy())
        for r in found:
            new_sums[r["start"], r["cluster"]] += np.frombuffer(r["sums"], dtype=np.int64)
            new_sizes[r["start"], r["cluster"]] += r["n"]
        if whole:
            sums, sizes = new_sums, new_sizes
        n = np.maximum(new_sizes, 1)[:, :, None]
        moved = np.where(new_sizes[:, :, None] > 0, (2 * new_sums + n) // (2 * n), centres)
        # a start that ends keeps the centres that were read
        still = [s for s in active if ((moved[s] - centres[s]) ** 2).sum(axis=1).max() > limit]
        if not still or step == max_iter:
            break
        for s in still:
            centres[s] = moved[s]
        active = still
    costs = blocks.mapInArrow(_coster(centres), "start int, cost decimal(38,0)").groupBy("start").agg(F.sum("cost").cast("decimal(38,0)").alias("cost")).collect()
    costs = {r["start"]: int(r["cost"]) for r in costs}
    return centres, [costs.get(s, 0) for s in range(len(centres))]


def _labeller(centres: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster = Points.of_lists(batch).distances(centres).argmin(axis=1) if batch.num_rows else []
            yield batch.append_column("cluster", pa.array(cluster, pa.int32()))

    return run


def assign(points: DataFrame, centres: np.ndarray) -> DataFrame:
    """``points`` with ``cluster int``, the nearest of ``centres(k, terms)``."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in points.schema.fields)
    return points.mapInArrow(_labeller(centres), f"{schema}, cluster int")


def best_start(points: DataFrame, k: int, terms: int, n_init: int = 10, seed: int = 42, max_iter: int = 300, tol: float = 1e-4) -> np.ndarray:
    """Centres ``(k, terms)`` of the start with the least cost."""
    centres, costs = lloyd(points, first_centres(points, k, terms, n_init, seed), max_iter, tol)
    return centres[costs.index(min(costs))]
