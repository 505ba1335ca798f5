r"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint has a bit set when it is set in over half of the XXH64 values
(seed 42) of the text's word shingles, repeats included. Words are
``[^\x20\x09-\x0D]+`` after lower-casing A-Z. Fingerprints within ``max_bits``
differing bits are linked; a component is what links reach.

Blocks: a fingerprint is cut into ``m`` blocks. At most ``max_bits`` differing
bits touch at most ``max_bits`` blocks, so a linked pair agrees on at least
``m - max_bits`` of them: every choice of that many blocks is a join key, and
the pair meets under at least one key. ``m`` grows with the number of distinct
fingerprints so that a key keeps few unrelated ones; the result is the same
for every ``m``.

Shape at scale: only distinct fingerprints are joined (equal ones are counted
together first). Keys are sorted inside their partitions and read as a stream;
a key's fingerprints are compared as one array and leave at most a spanning
forest of links, never all pairs. A key with more than ``HOT`` fingerprints is
dealt out to tasks as pairs of chunks, so a task holds at most two chunks.

Cases: null and empty texts and texts without words have fingerprint zero,
linked like any other; texts with fewer words than a shingle have one shingle.
Null ids take part but are no component id unless all are null. Repeated rows
link to each other. An empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import drop_shared, give_back, map_batches, table
from tallyspark.llm.components import connected_components
from tallyspark.operators.joins import sized_broadcast
from tallyspark.session import BATCH_BYTES, bound_batches, stage, unstage

SEED = 42
SMALL_KEYS = 200_000    # keys of dropped rows that are broadcast (about 50 bytes each)
HOT = 8192          # distinct fingerprints of one key compared in one task
SMALL = 32          # keys up to this size are compared by shifted arrays
KEEP_PER_KEY = 4    # unrelated fingerprints a key may hold on average
SLICE = 1 << 16     # hashes unpacked to bits at a time


def fingerprint(text: bytes | None, shingle: int = 4) -> int:
    """The 64-bit fingerprint of one whole text."""
    words = (text or b"").lower().split()  # bytes: ASCII case and white space only
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        starts = np.concatenate(([0], ends[:n - shingle] + 1)).tolist()
        pieces = [joined[a:b] for a, b in zip(starts, ends[shingle - 1:].tolist())]
        hashes = map(xxhash.xxh64_intdigest, pieces, repeat(SEED))
        n = n - shingle + 1
    h = np.fromiter(hashes, "<u8", n if n > 1 else 1) if not isinstance(hashes, list) else np.array(hashes, "<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), SLICE):
        bits = np.unpackbits(h[i:i + SLICE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def text_keys(text_col: str) -> list[F.Column]:
    """128 bits that tell texts apart: two hashes of different seeds."""
    text = F.col(text_col).cast("string")
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int, keys: bool) -> DataFrame:
    """``(id, fp)`` per row, with ``keys`` ``(id, h1, h2, fp)``, ``h1`` and
    ``h2`` being the text's keys."""
    def run(*cols):
        *kept, texts = cols
        fps = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
        return [*kept, fps]

    names = ["id", *(["h1", "h2"] if keys else []), "fp"]
    return map_batches(docs.select(F.col(id_col).cast("long").alias("id"), *(text_keys(text_col) if keys else []),
                                   F.col(text_col).cast("string").alias("t")),
                       run, ", ".join(f"{n} long" for n in names), [(n, pa.int64()) for n in names])


def blocks(m: int) -> list[int]:
    """Masks of ``m`` blocks of nearly equal width."""
    cuts = [round(64 * i / m) for i in range(m + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]


def key_masks(n: int, max_bits: int) -> list[int]:
    """Masks of the join keys for ``n`` distinct fingerprints: the fewest
    blocks whose keys keep about ``KEEP_PER_KEY`` unrelated ones."""
    m = max_bits + 1
    while m < 2 * max_bits + 4 and n / 2 ** (64 * (m - max_bits) / m) > KEEP_PER_KEY:
        m += 1
    return [sum(c) for c in combinations(blocks(m), m - max_bits)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def forest(fps: np.ndarray, max_bits: int) -> tuple[list, list]:
    """Links of a spanning forest over the pairs within ``max_bits``: a walk
    that compares each reached fingerprint with those not yet reached."""
    a, b, rest = [], [], fps
    while rest.size > 1:
        todo, rest = [rest[0]], rest[1:]
        while todo and rest.size:
            f = todo.pop()
            near = np.bitwise_count(rest ^ f) <= max_bits
            if near.any():
                hit, rest = rest[near], rest[~near]
                a.extend(repeat(f, len(hit)))
                b.extend(hit)
                todo.extend(hit)
    return a, b


def _links(keys: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside each run of equal keys (rows sorted by key)."""
    first = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1))))
    size = np.diff(np.concatenate((first, [len(fps)])))
    run_size = np.repeat(size, size)
    left = np.repeat(first + size, size) - np.arange(len(fps)) - 1  # rows after this one in its run
    a, b = [], []
    for off in range(1, SMALL):
        i = np.flatnonzero((left >= off) & (run_size <= SMALL))
        if not i.size:
            break
        i = i[np.bitwise_count(fps[i] ^ fps[i + off]) <= max_bits]
        a.append(fps[i])
        b.append(fps[i + off])
    for s, n in zip(first[size > SMALL], size[size > SMALL]):
        x, y = forest(fps[s:s + n], max_bits)
        a.append(np.array(x, np.uint64))
        b.append(np.array(y, np.uint64))
    return np.concatenate(a or [fps[:0]]), np.concatenate(b or [fps[:0]])


def _linker(max_bits: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_shared()
        kept_keys, kept_fps = [], []

        def flush(keys, fps):
            a, b = _links(keys, fps, max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            keys, fps = np.stack(cols[:-1], axis=1), cols[-1].view(np.uint64)
            change = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1))
            if not change.size and (not kept_keys or (kept_keys[0][0] == keys[0]).all()):
                kept_keys.append(keys)
                kept_fps.append(fps)
                continue
            cut = change[-1] + 1 if change.size else 0
            done_k, done_f = np.concatenate([*kept_keys, keys[:cut]]), np.concatenate([*kept_fps, fps[:cut]])
            kept_keys, kept_fps = [keys[cut:]], [fps[cut:]]
            if len(done_f):
                yield flush(done_k, done_f)
        if kept_fps:
            yield flush(np.concatenate(kept_keys), np.concatenate(kept_fps))
        kept_keys, kept_fps = [], []
        give_back()

    return run


def fingerprint_links(distinct: DataFrame, max_bits: int = 4, hot: int = HOT) -> DataFrame:
    """``(a, b)`` links between distinct fingerprints (column ``fp``) whose
    components are those of all pairs within ``max_bits``."""
    masks = key_masks(distinct.count(), max_bits)
    keyed = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).cast("long").alias("c"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("k"))
        for i, m in enumerate(masks)])).alias("x")).select("x.c", "x.k", "fp")
    counts = stage(keyed.groupBy("c", "k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot), "simhash-hot")

    def linked(df, keys):
        # an explicit number of partitions by key, then one streaming pass
        n = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return (df.repartition(n, *keys).sortWithinPartitions(*keys, "fp").select(*keys, "fp")
                .mapInArrow(_linker(max_bits), "a long, b long"))

    if counts.isEmpty():
        return linked(keyed, ["c", "k"])
    cold = keyed.join(counts, ["c", "k"], "left_anti")
    parts = keyed.join(counts, ["c", "k"]).withColumns({
        "parts": F.ceil(F.col("n") / F.lit(hot)).cast("long"),
    }).withColumn("p", F.pmod(F.xxhash64("fp"), F.col("parts")))
    # every chunk meets every other one: task (i, j), i < j
    pairs = parts.select("c", "k", "fp", "p", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("q"))
    pairs = pairs.where(F.col("p") != F.col("q")).select(
        "c", "k", F.least("p", "q").alias("i"), F.greatest("p", "q").alias("j"), "fp")
    return linked(cold, ["c", "k"]).unionByName(linked(pairs, ["c", "k", "i", "j"]))


def _rooted(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int, hot: int, rep,
            keys: bool) -> tuple[DataFrame, DataFrame]:
    """``(rows, best)``, both stored tables: the rows of ``fingerprints``, and
    per distinct fingerprint its component's least ``rep`` (a column of the
    rows) as ``best``."""
    spark = docs.sparkSession
    bounded = bound_batches(spark)  # whole texts go to Python here
    try:
        rows = stage(fingerprints(docs, id_col, text_col, shingle, keys), "simhash-rows")
    finally:
        if bounded:
            spark.conf.unset(BATCH_BYTES[0])
    reps = stage(rows.groupBy("fp").agg(F.min(rep).alias("rep")), "simhash-reps")
    # a fingerprint is once in either table: no partition to split, nothing to store between
    comps = connected_components(fingerprint_links(reps.select("fp"), max_bits, hot))
    roots = reps.join(comps, reps["fp"] == comps["node"], "left").select(
        "fp", "rep", F.coalesce("component", "fp").alias("root"))
    roots = stage(roots, "simhash-roots")
    best = stage(roots.groupBy("root").agg(F.min("rep").alias("best")), "simhash-best")
    named = stage(roots.join(best, "root").select("fp", "best"), "simhash-named")
    unstage(reps, roots, best)
    return rows, named


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = 4, max_bits: int = 4, hot: int = HOT) -> DataFrame:
    """One row per document: ``id_col``, ``fingerprint`` (16 hex digits) and
    ``component_id`` (smallest id reachable by links, itself included)."""
    rows, named = _rooted(docs, id_col, text_col, shingle, max_bits, hot, F.col("id"), keys=False)
    # both sides are stored tables: AQE splits the partition of a hot fingerprint
    return rows.join(named, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("best").alias("component_id"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` (all its columns) with one row per component: the one with the
    smallest id, nulls last, and of several texts with that id the one with the
    smallest hash. Rows are told apart by id and text, so null ids and an id on
    different texts lose nothing; a row that is repeated (same id and text)
    stays once."""
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "h1", "h2")
    rows, named = _rooted(docs, id_col, text_col, shingle, max_bits, HOT, order, keys=True)
    best = F.col("best")
    stays = (F.col("id").eqNullSafe(best["id"]) & (F.col("h1") == best["h1"]) & (F.col("h2") == best["h2"]))
    # both sides are stored tables: AQE splits the partition of a hot fingerprint
    marked = stage(rows.join(named, "fp").select(
        F.col("id").alias("__id"), F.col("h1").alias("__g1"), F.col("h2").alias("__g2"), stays.alias("__stays")),
        "simhash-marked")
    unstage(rows, named)
    keys = ["__id", "__g1", "__g2"]
    gone = stage(marked.where("not __stays").select(*keys).distinct(), "simhash-gone")
    again = stage(marked.where("__stays").groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                  .select(*keys), "simhash-again")
    unstage(marked)
    h1, h2 = text_keys(text_col)
    tagged = docs.withColumns({"__h1": h1, "__h2": h2})
    same = (F.col(id_col).cast("long").eqNullSafe(F.col("__id")) & (F.col("__h1") == F.col("__g1"))
            & (F.col("__h2") == F.col("__g2")))
    # a broadcast of few keys moves no text; otherwise a hash join on the narrow
    # side, so the texts are not sorted
    side = sized_broadcast(gone, SMALL_KEYS)
    left = tagged.join(side if side is not gone else gone.hint("shuffle_hash"), same, "left_anti")
    if again.isEmpty():
        return left.select(*docs.columns)
    return left.join(again, same, "left_anti").unionByName(
        left.join(again, same, "left_semi").dropDuplicates([id_col, "__h1", "__h2"])).select(*docs.columns)


def op9_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))
