"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ASCII white space, the separators of ``[^\x20\x09-\x0D]+`` words. Fixed values.
WHITE_SPACE = " \t\n\x0b\f\r"
ROWS = 512          # rows handed to a batch function at a time
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text) -> F.Column:
    """Number of words of a text; null and empty texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def map_batches(df: DataFrame, fn: Callable[..., list], schema: str, arrow_types: list[tuple[str, pa.DataType]]) -> DataFrame:
    """``mapInArrow`` with plain Python lists: ``fn`` gets one list per column
    of ``df`` (strings as bytes) and returns one list or array per output
    column, for at most ``ROWS`` rows at a time: that and the Arrow batch they
    come from bound the memory."""
    out_schema = pa.schema(arrow_types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_shared()
        for batch, last in ((b.slice(i, ROWS), i + ROWS >= b.num_rows) for b in batches
                            for i in range(0, b.num_rows, ROWS)):
            cols = []
            for col in batch.columns:
                if pa.types.is_string(col.type) or pa.types.is_large_string(col.type):
                    col = col.cast(pa.binary() if pa.types.is_string(col.type) else pa.large_binary())
                cols.append(col.to_pylist())
            out = fn(*cols)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, type=f.type, from_pandas=False) for v, f in zip(out, out_schema, strict=True)],
                schema=out_schema)
            if last:
                pa.default_memory_pool().release_unused()
        give_back()

    return df.mapInArrow(run, schema)


def map_task(df: DataFrame, make: Callable[[], Callable[..., list]], schema: str,
             arrow_types: list[tuple[str, pa.DataType]], rows: int = ROWS) -> DataFrame:
    """``map_batches`` with a state per task: ``make()`` gives the function
    when a task starts, and what it holds (vocabularies, tables of words) is
    given back to the system when the task ends, so that it does not lie beside
    the next stage in a reused worker. What ``make`` takes from ``shared`` lives
    as long as the worker runs tasks of that stage."""
    out_schema = pa.schema(arrow_types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_shared()
        fn = make()
        try:
            for batch in batches:
                for i in range(0, batch.num_rows, rows):
                    part = batch.slice(i, rows)
                    cols = [c.cast(pa.large_binary()).to_pylist()
                            if pa.types.is_string(c.type) or pa.types.is_large_string(c.type) else c.to_pylist()
                            for c in part.columns]
                    out = fn(*cols)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v, type=f.type, from_pandas=False) for v, f in zip(out, out_schema, strict=True)],
                        schema=out_schema)
                    del cols, out
        finally:
            del fn
            give_back()

    return df.mapInArrow(run, schema)


_SHARED: dict = {}  # stage -> {key: what its tasks share in this worker}


def _stage_id() -> int:
    task = TaskContext.get()
    return task.stageId() if task else -1


def shared(key, make: Callable):
    """``make()``, kept in this worker for the tasks of the running stage. Its
    size must have a bound; the first task of another stage drops it."""
    own = _SHARED.setdefault(_stage_id(), {})
    if key not in own:
        own[key] = make()
    return own[key]


def drop_shared() -> None:
    """Drops what tasks of other stages have left in this worker."""
    here = _stage_id()
    left = [s for s in _SHARED if s != here]
    for other in left:
        del _SHARED[other]
    if left:
        gc.collect()  # tables and what fills them refer to each other


def give_back() -> None:
    """Returns a worker's free memory to the system; while the stage's tasks
    share tables there is little to look for, and looking is slow."""
    drop_shared()
    if not _SHARED:
        gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc: its allocator decides
        pass


def filter_batches(df: DataFrame, column: str, keep: Callable[[bytes | None], bool]) -> DataFrame:
    """The rows of ``df`` whose text ``column`` passes ``keep`` (as bytes)."""
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_shared()
        for batch in batches:
            for part in (batch.slice(i, ROWS) for i in range(0, batch.num_rows, ROWS)):
                texts = part.column(at).cast(pa.large_binary()).to_pylist()
                yield part.filter(pa.array([keep(t) for t in texts], pa.bool_()))
            pa.default_memory_pool().release_unused()
        give_back()

    return df.mapInArrow(run, df.schema)


def lowest(df: DataFrame, group: str, draw: str, counts: dict, each: int) -> F.Column:
    """Condition on ``group`` and ``draw`` (a 64-bit hash, once per group) that
    holds for the ``each`` rows of every group with the lowest hashes, or all
    of a smaller group. ``counts`` has the groups' sizes. The driver gets the
    hashes of about ``2 * each`` rows of a group."""
    least, most = -1 << 63, (1 << 63) - 1
    wide = {g: min(most, least + ((1 << 64) * (2 * each + 64) // n)) for g, n in counts.items()}

    def below(cuts: dict) -> F.Column:
        cut = F.create_map(*[F.lit(v) for pair in cuts.items() for v in pair])[F.col(group)]
        return F.coalesce(F.col(draw) <= cut, F.lit(False))

    found = df.where(below(wide)).select(group, draw).toArrow()
    groups, draws = np.array(found[group].to_pylist(), object), found[draw].to_numpy()
    cuts = {}
    for g, bound in wide.items():
        own = draws[groups == g]
        cuts[g] = int(np.partition(own, each - 1)[each - 1]) if len(own) > each else bound
    return below(cuts)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows sorted by their first ``keys`` (integer) columns, regrouped so that
    no group is cut: ``(rows, index of every group's first row)``."""
    open_rows: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1
        if open_rows and any(open_rows[-1].column(i)[-1].as_py() != c[0] for i, c in enumerate(cols)):
            new = np.concatenate(([0], new))
        if not len(new):
            open_rows.append(batch)
            continue
        yield from _grouped([*open_rows, batch.slice(0, new[-1])], keys)
        open_rows = [batch.slice(new[-1])]
    yield from _grouped(open_rows, keys)


def _grouped(parts: list[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    parts = [p for p in parts if p.num_rows]
    if parts:
        rows = pa.concat_batches(parts) if len(parts) > 1 else parts[0]
        cols = [rows.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        yield rows, np.concatenate(([0], np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1))
