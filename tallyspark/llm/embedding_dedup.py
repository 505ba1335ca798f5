r"""Embedding near-duplicates by collision-counting projections.

Vectors are projected on many random lines. Two vectors of cosine at least
``min_cosine`` lie at most ``sqrt(2 - 2 * min_cosine)`` apart on the unit
sphere, so on one line they are within a window of half width ``HALF`` such
distances around each other with a known probability. A pair of candidates is
verified (cosine in double precision) when enough of the ``LINES`` counted
lines see it collide; the number is the binomial quantile that keeps ``RECALL``
of the pairs at exactly ``min_cosine`` and more of the nearer ones.

Candidates: for each of several tables the vectors are sorted by their cells on
a few of the lines (cells ``CELL`` distances wide, at random offsets), so only
vectors near on all of them meet. With the number ``n`` of distinct vectors the
lines per table grow so that a cell keeps about ``PER_CELL`` unrelated vectors,
and the tables so that ``RECALL`` of the pairs at ``min_cosine`` meet somewhere.
Every vector is in every table; nothing is capped. A pair that meets in several
tables counts in the first.

Shape at scale: equal vectors are one row with a count. To the cells travels
only a sketch, one byte per counted line (the projection in steps of an eighth
of the window, rounded so that no collision is lost). Vectors follow only for
rows that collide often enough with another of their cell, to the group of rows
so connected there. Both are sorted inside partitions and read as a stream. What
leaves a group is a sum of links per vector and a spanning forest, never the
pairs. A cell of more than ``HOT`` distinct vectors is dealt out as pairs of
chunks, so a task holds two chunks.

Cases: vectors that are null, empty, all zero, or hold null or non-finite
components link with nothing, nor do rows without an id; vectors of different
lengths never link. Repeated rows are vectors of their own that link to each
other. An id given to different vectors is one node. An empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import ceil, comb, erf, exp, log, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import table, whole_groups
from tallyspark.llm.components import connected_components
from tallyspark.session import stage, unstage

MIN_COSINE = 0.95
RECALL = 0.99
CELL = 6.0       # width of a cell, in largest distances of a linked pair
HALF = 1.5       # half width of a collision window, in the same unit
LINES = 32       # lines on which collisions are counted
PER_CELL = 32
HOT = 512
STEPS = 8        # steps of a sketch in a collision window
SEED = 11


@dataclass(frozen=True)
class Plan:
    per_table: int   # lines of a table's cells
    tables: int
    distance: float  # of a pair at the least cosine
    needed: int      # collisions needed on LINES lines


def same_cell(width: float) -> float:
    """Probability that two points share a cell of ``width`` times their
    distance, on a random line at a random offset."""
    tail = 0.5 * (1 - erf(width / sqrt(2)))
    return 1 - 2 * tail - 2 / (sqrt(2 * pi) * width) * (1 - exp(-width * width / 2))


def calibrate(n: int, min_cosine: float = MIN_COSINE, recall: float = RECALL) -> Plan:
    distance = sqrt(2 - 2 * min_cosine)
    near, far = same_cell(CELL), same_cell(CELL * distance / sqrt(2))
    per_table = max(2, ceil(log(max(n / PER_CELL, 2)) / -log(far)))
    tables = max(1, ceil(log(1 - recall) / log(1 - near ** per_table)))
    p = erf(HALF / sqrt(2))
    below, needed = 0.0, 0
    while True:
        below += comb(LINES, needed) * p ** needed * (1 - p) ** (LINES - needed)
        if below > 1 - recall:
            return Plan(per_table, tables, distance, needed)
        needed += 1


@lru_cache(4)
def lines(dim: int, plan: Plan) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(counted lines, table lines, offsets)`` for vectors of ``dim``."""
    rng = np.random.default_rng([SEED, dim])
    counted = rng.standard_normal((dim, LINES))
    cells = rng.standard_normal((dim, plan.tables * plan.per_table))
    return counted, cells, rng.random(plan.tables * plan.per_table)


def unit(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)  # no overflow or underflow in the norm
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def cell_keys(v: np.ndarray, plan: Plan) -> np.ndarray:
    """One 64-bit cell per row and table."""
    _, cells, offsets = lines(v.shape[1], plan)
    at = np.floor(v @ cells / (CELL * plan.distance) + offsets).astype(np.int64).view(np.uint64)
    out = np.full((len(v), plan.tables), v.shape[1], np.uint64)
    for i in range(plan.per_table):
        out = (out ^ at[:, i::plan.per_table][:, :plan.tables]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def _vectors(col: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """``(rows, matrix)`` per vector length of a list column."""
    n = np.diff(col.offsets.to_numpy())
    flat, start = col.values.to_numpy(zero_copy_only=False), col.offsets.to_numpy()[:-1]
    return [(rows := np.flatnonzero(n == d), flat[start[rows][:, None] + np.arange(d)]) for d in np.unique(n) if d]


def sketch(v: np.ndarray, plan: Plan) -> np.ndarray:
    """The projections on the counted lines in steps of ``1 / STEPS`` of a
    collision window. Rounding down and clipping only bring rows nearer."""
    at = np.floor(v @ lines(v.shape[1], plan)[0] * (STEPS / (HALF * plan.distance)))
    return np.clip(at, -127, 127).astype(np.int8)


def collide(sketches: np.ndarray, plan: Plan) -> np.ndarray:
    """Which rows collide on enough lines (symmetric matrix, false diagonal)."""
    wide, n = sketches.astype(np.int16), len(sketches)
    out = np.zeros((n, n), bool)
    step = max(1, (1 << 21) // (n * LINES))
    for i in range(0, n, step):
        near = np.abs(wide[i:i + step, None, :] - wide[None, i:, :]) <= STEPS
        out[i:i + step, i:] = np.count_nonzero(near, axis=2) >= plan.needed
    out |= out.T
    np.fill_diagonal(out, False)
    return out


def _placed(plan: Plan):
    schema = pa.schema([("rep", pa.int64()), ("h1", pa.int64()), ("dim", pa.int32()), ("sketch", pa.binary()),
                        ("cells", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, m in _vectors(batch.column(2)):
                m, part = unit(m), batch.take(pa.array(rows))
                keys = cell_keys(m, plan)
                cells = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, plan.tables, dtype=np.int32), keys.ravel())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(np.full(len(rows), m.shape[1], np.int32)),
                     pa.array([r.tobytes() for r in sketch(m, plan)], pa.binary()), cells], schema=schema)

    return run


def _across(linked: np.ndarray, chunk: np.ndarray) -> np.ndarray:
    """With two chunks only pairs across them count: a chunk with itself is a
    task of its own."""
    return linked & (chunk[:, None] != chunk[None, :]) if chunk.min() != chunk.max() else linked


def _candidates(plan: Plan):
    """Rows of a cell that collide with another one, with their group: the
    position of its first row in the cell's order."""
    schema = pa.schema([("t", pa.int32()), ("cell", pa.int64()), ("i", pa.int64()), ("j", pa.int64()), ("g", pa.int64()),
                        ("p", pa.int64()), ("rep", pa.int64()), ("h1", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, first in whole_groups(batches, 5):
            chunk = rows.column(5).to_numpy()
            keep, group = [], []
            for s, e in zip(first, [*first[1:], rows.num_rows]):
                if e - s < 2:
                    continue
                sketches = np.frombuffer(b"".join(rows.column(8).slice(s, e - s).to_pylist()), np.int8).reshape(e - s, LINES)
                met = _across(collide(sketches, plan), chunk[s:e])
                if met.any():
                    root = np.arange(e - s)
                    for a, b in zip(*forest(met)):  # parents come before their children
                        root[b] = root[a]
                    has = np.flatnonzero(met.any(axis=1))
                    keep.append(has + s)
                    group.append(root[has])
            if keep:
                part = rows.take(pa.array(np.concatenate(keep)))
                yield pa.RecordBatch.from_arrays([*part.columns[:4], pa.array(np.concatenate(group)), *part.columns[5:8]],
                                                 schema=schema)

    return run


def links(v: np.ndarray, chunk: np.ndarray, t: int, plan: Plan, min_cosine: float) -> np.ndarray:
    """Which rows of a group link (symmetric matrix): collisions counted, then
    the cosine, then only pairs that meet in no earlier table."""
    out = _across(collide(sketch(v, plan), plan), chunk)
    a, b = np.nonzero(np.triu(out))
    keys = cell_keys(v, plan)[:, :t]
    for i in range(0, len(a), 1 << 14):
        x, y = a[i:i + (1 << 14)], b[i:i + (1 << 14)]
        drop = (np.einsum("ij,ij->i", v[x], v[y]) < min_cosine) | (keys[x] == keys[y]).any(axis=1)
        out[x[drop], y[drop]] = out[y[drop], x[drop]] = False
    return out


def forest(linked: np.ndarray) -> tuple[list[int], list[int]]:
    """Edges of a spanning forest of a link matrix."""
    a, b, left = [], [], linked.any(axis=1)
    while left.any():
        todo = [int(left.argmax())]
        left[todo[0]] = False
        while todo:
            i = todo.pop()
            near = np.flatnonzero(linked[i] & left)
            left[near] = False
            a.extend([i] * len(near))
            b.extend(near.tolist())
            todo.extend(near.tolist())
    return a, b


def _linker(plan: Plan, min_cosine: float):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, first in whole_groups(batches, 5):
            out: list[list] = [[], [], []]
            t, chunk, rep, n = (rows.column(i).to_numpy(zero_copy_only=False) for i in (0, 5, 6, 7))
            for s, e in zip(first, [*first[1:], rows.num_rows]):
                if e - s < 2:
                    continue
                for at, m in _vectors(rows.column(8).slice(s, e - s)):
                    if len(at) < 2:
                        continue
                    at = at + s
                    found = links(unit(m), chunk[at], int(t[s]), plan, min_cosine)
                    sums = found @ n[at]
                    has = np.flatnonzero(sums)
                    a, b = forest(found)
                    out[0] += [*rep[at[has]].tolist(), *rep[at[a]].tolist()] if len(has) else []
                    out[1] += [*[None] * len(has), *rep[at[b]].tolist()] if len(has) else []
                    out[2] += [*sums[has].tolist(), *[0] * len(a)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], schema=schema)

    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    min_cosine: float = MIN_COSINE, recall: float = RECALL, hot: int = HOT) -> DataFrame:
    """One row per vector: ``id_col, n_links, component_id, kept``."""
    spark = vectors.sparkSession
    v = F.col("v")
    sound = (F.col("id").isNotNull() & v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
             & F.exists(v, lambda x: x != 0))
    kept_type = "array<float>" if dict(vectors.dtypes)[vec_col] == "array<float>" else "array<double>"
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast(kept_type).alias("v"))
    rows = rows.select("id", "v", F.coalesce(sound, F.lit(False)).alias("sound"))
    name = [F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2")]
    ids = stage(rows.select("id", "sound", *name), "vec-ids")
    kinds = stage(rows.where("sound").groupBy("v").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n")), "vec-kinds")
    plan = calibrate(kinds.count(), min_cosine, recall)

    placed = stage(kinds.select("rep", F.xxhash64("v").alias("h1"), "v").mapInArrow(
        _placed(plan), "rep long, h1 long, dim int, sketch binary, cells array<long>"), "vec-cells")
    met = placed.select("rep", "h1", "dim", "sketch", F.posexplode("cells").alias("t", "cell"))
    # few rows: a cell of more than ``hot`` each
    crowded = stage(met.groupBy("t", "cell").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > hot), "vec-crowded")
    zero = F.lit(0).cast("long")
    chunks = F.coalesce(F.ceil(F.col("m") / hot), F.lit(1)).cast("long")
    met = met.join(crowded, ["t", "cell"], "left").withColumn("k", chunks).withColumn("p", F.pmod("h1", "k"))
    # every chunk meets itself and every other one: tasks (i, j), i <= j
    met = met.withColumn("q", F.explode(F.sequence(zero, F.col("k") - 1)))
    met = met.select("t", "cell", F.least("p", "q").alias("i"), F.greatest("p", "q").alias("j"),
                     F.col("dim").cast("long").alias("g"), "p", "rep", "h1", "sketch")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ["t", "cell", "i", "j", "g"]
    near = stage(met.repartition(width, *keys).sortWithinPartitions(*keys).mapInArrow(
        _candidates(plan), "t int, cell long, i long, j long, g long, p long, rep long, h1 long"), "vec-near")
    # rows of different lengths may share a group's number; they are compared apart
    dealt = near.join(kinds.withColumn("h1", F.xxhash64("v")), ["rep", "h1"]).select(*keys, "p", "rep", "n", "v")
    found = stage(dealt.repartition(width, *keys).sortWithinPartitions(*keys)
                  .mapInArrow(_linker(plan, min_cosine), "a long, b long, links long"), "vec-links")
    comps = stage(connected_components(found.where(F.col("b").isNotNull()).select("a", "b")), "vec-comps")
    sums = stage(found.where(F.col("b").isNull()).groupBy("a").agg(F.sum("links").alias("links")), "vec-sums")
    unstage(placed, crowded, near)
    named = (kinds.select(*name, "rep", "n").join(sums, F.col("rep") == F.col("a"), "left")
             .join(comps, F.col("rep") == F.col("node"), "left")
             .select("h1", "h2", (F.coalesce("links", zero) + F.col("n") - 1).alias("links"),
                     F.coalesce("component", "rep").alias("component")))
    named = stage(named, "vec-named")
    unstage(found, comps, sums, kinds)
    out = (ids.where("sound").join(named, ["h1", "h2"]).select("id", "links", "component")
           .unionByName(ids.where("not sound").select("id", zero.alias("links"), F.col("id").alias("component"))))
    return out.select(F.col("id").alias(id_col), F.col("links").alias("n_links"), F.col("component").alias("component_id"),
                      F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"))


def op4_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
