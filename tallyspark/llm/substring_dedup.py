r"""Substring deduplication by Rabin-Karp hashes of fixed-length word windows.

A window is ``length`` consecutive words (``[^\x20\x09-\x0D]+``) of one document.
Every word covered by a window whose words also start anywhere else, in the
same document or another, is removed; repeated windows merge into maximal
removal intervals. Windows are judged on the input.

Every window gets a polynomial rolling hash (two of 64 bits where windows are
compared one by one). Spark does the counting, in two steps, so that it need
not move a row per window:

1. Every window has an anchor: the ``length // 3`` words in it with the lowest
   hash, the leftmost of equals. Equal windows have equal anchors at the same
   place, and neighbouring windows mostly share theirs; a run of windows with
   one anchor is one row (about one per twelve windows), named by its anchor
   and by the hashes of its first and last window, which cover all its words.
   Anchors that occur once belong to windows that occur once: their runs go.
   A run that occurs twice as a whole has repeated windows only.
2. Where an anchor has several different runs, these are compared window by
   window (one row per window, one run of each kind), and counted.

That equals counting every window: a window occurs again exactly if its anchor
does, at the same place in it, and then either its whole run occurs again (step
1) or it lies in two kinds of runs of that anchor (step 2).

Rows that are counted are combined map-side. Joins on anchors, runs and windows
read stored tables on both sides, so AQE splits the partition of a passage that
a third of all documents share. A document's removals are gathered in one row as a
set, which rows with the same id and text share (bounded by the document). Texts travel compressed, once to hash the windows of
step 2 and once for the removal.

Cases: null and empty texts have no words; very long texts are read whole; texts shorter than a window lose
nothing. Repeated rows are occurrences of their own: their windows repeat. A
document is known by 128 bits of hash of its id and text, so null and repeated
ids are safe. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import map_batches, table
from tallyspark.llm.pretokens import Memo
from tallyspark.session import stage, unstage

LENGTH = 35
MEMO = 100_000  # word hashes kept per worker
# Odd multipliers of the two rolling hashes and of the final mixing.
BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
RUN = "k1 long, k2 long, i1 int, i2 int"
ARROW_RUN = [("k1", pa.int64()), ("k2", pa.int64()), ("i1", pa.int32()), ("i2", pa.int32())]

_words = Memo(xxhash.xxh64_intdigest, b"", MEMO)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * MIX[0]
    h = (h ^ (h >> np.uint64(27))) * MIX[1]
    return h ^ (h >> np.uint64(31))


@lru_cache(8)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n + 1, base, np.uint64)
    down = np.full(n + 1, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def rolling(values: np.ndarray, width: int, base: int) -> np.ndarray:
    """Polynomial hashes modulo 2^64 of every ``width`` neighbours, from one
    running sum, mixed."""
    n = len(values)
    if n < width:
        return np.zeros(0, np.uint64)
    up, down = _powers(base, 1 << max(10, n.bit_length()))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * up[:n])))
    return mixed((sums[width:] - sums[:-width]) * down[:n - width + 1])


def word_hashes(text: bytes | None) -> np.ndarray:
    words = (text or b"").split()  # bytes: ASCII white space only
    return np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))


def runs(words: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """``(anchor, content, i1, i2)`` of the runs of windows of one text;
    ``i1`` and ``i2`` are the first and last window."""
    first = rolling(words, length, BASES[0])
    if not len(first):
        return (first, first, *[np.zeros(0, np.int32)] * 2)
    span = max(1, length // 3)
    grams = rolling(words, span, BASES[1])
    views = np.lib.stride_tricks.sliding_window_view(grams, length - span + 1)
    at = np.arange(len(first)) + views.argmin(axis=1)
    i1 = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    i2 = np.concatenate((i1[1:], [len(first)])) - 1
    place = (at[i1] - i1).astype(np.uint64) << np.uint64(32) | (i2 - i1).astype(np.uint64)
    content = mixed(first[i1] * MIX[0] + mixed(first[i2] + place))
    return grams[at[i1]], content, i1.astype(np.int32), i2.astype(np.int32)


def _signed(a: np.ndarray) -> np.ndarray:
    return a.astype(np.uint64).view(np.int64)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(k1, k2, id, t)``: rows share ``k1`` and ``k2``, hashes of different
    seeds, only if they have the same id and text."""
    id_, text = F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    no_id = id_.isNull()  # hashed too: a null adds nothing to a hash
    return docs.select(F.xxhash64(no_id, id_, text).alias("k1"), F.xxhash64(F.lit(1), no_id, id_, text).alias("k2"),
                       id_.alias("id"), text.alias("t"))


def _packed(keyed: DataFrame) -> DataFrame:
    """The texts compressed, for a shuffle."""
    def run(k1, k2, ids, texts):
        pack = zstandard.ZstdCompressor(level=1).compress
        return [k1, k2, ids, [pack(t) for t in texts]]

    return map_batches(keyed, run, "k1 long, k2 long, id long, z binary",
                       [("k1", pa.int64()), ("k2", pa.int64()), ("id", pa.int64()), ("z", pa.binary())])


def _unpack(z: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(z)


def _join_docs(keyed: DataFrame, found: DataFrame, how: str) -> DataFrame:
    return _packed(keyed).join(found, ["k1", "k2"], how)


def repeated_windows(keyed: DataFrame, length: int) -> DataFrame:
    """``(k1, k2, i1, i2)``: ranges of windows that occur elsewhere too."""
    def find(k1, k2, texts):
        _words.trim()
        found = [runs(word_hashes(t), length) for t in texts]
        n = [len(f[0]) for f in found]
        cat = [np.concatenate(c) if found else np.zeros(0) for c in zip(*found)]
        at = np.repeat(np.arange(len(texts)), n)
        pick = pa.array(at)
        return [pa.array(k1, pa.int64()).take(pick), pa.array(k2, pa.int64()).take(pick), cat[2], cat[3],
                _signed(cat[0]), _signed(cat[1])]

    every = stage(map_batches(keyed.select("k1", "k2", "t"), find, RUN + ", a long, c long",
                              [*ARROW_RUN, ("a", pa.int64()), ("c", pa.int64())]), "runs")
    shared = stage(every.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a"), "runs-shared")
    some = stage(every.join(shared, "a", "left_semi"), "runs-some")
    unstage(every, shared)
    # of equal runs one stands for all in step 2: the one with the lowest hash
    row = F.xxhash64("k1", "k2", "i1")
    kinds = stage(some.groupBy("a", "c").agg(F.count(F.lit(1)).alias("n"), F.min(row).alias("least")), "runs-kinds")
    mixed_anchor = stage(kinds.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a"), "runs-mixed")
    # step 1: whole runs; a run of a kind of its own is left for step 2
    multiple = stage(kinds.where("n > 1").select("a", "c"), "runs-multiple")
    whole = some.join(multiple, ["a", "c"], "left_semi").select("k1", "k2", "i1", "i2")
    stands = kinds.join(mixed_anchor, "a", "left_semi").select("a", "c", "least", (F.col("n") == 1).alias("single"))
    stands = stage(stands, "runs-stand")
    compare = (some.withColumn("least", row).join(stands, ["a", "c", "least"])
               .groupBy("k1", "k2").agg(F.collect_set(F.struct("i1", "i2", "single")).alias("runs")))

    def windows(k1, k2, texts, lists):
        _words.trim()
        cols, n = [], []
        for z, found in zip(texts, lists):
            w = word_hashes(_unpack(z))
            hashes = [rolling(w, length, BASES[0]), rolling(mixed(w), length, BASES[1])]
            at = np.concatenate([np.arange(r["i1"], r["i2"] + 1, dtype=np.int32) for r in found])
            single = np.repeat([r["single"] for r in found], [r["i2"] - r["i1"] + 1 for r in found])
            cols.append((at, single, *[_signed(h[at]) for h in hashes]))
            n.append(len(at))
        pick = pa.array(np.repeat(np.arange(len(texts)), n))
        return [pa.array(k1, pa.int64()).take(pick), pa.array(k2, pa.int64()).take(pick),
                *[np.concatenate(c) for c in zip(*cols)]]

    listed = stage(map_batches(
        _join_docs(keyed, compare, "inner").drop("id"), windows, "k1 long, k2 long, i int, single boolean, h1 long, h2 long",
        [("k1", pa.int64()), ("k2", pa.int64()), ("i", pa.int32()), ("single", pa.bool_()),
         ("h1", pa.int64()), ("h2", pa.int64())]), "windows")
    again = stage(listed.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h1", "h2"),
                  "windows-again")
    one_by_one = listed.where("single").join(again, ["h1", "h2"], "left_semi").select(
        "k1", "k2", F.col("i").alias("i1"), F.col("i").alias("i2"))
    out = stage(whole.unionByName(one_by_one), "windows-repeated")
    unstage(some, kinds, mixed_anchor, multiple, stands, listed, again)
    return out


def covered(n_words: int, ranges: list, length: int) -> np.ndarray:
    """Which words lie in a repeated window."""
    step = np.zeros(n_words + 1, np.int64)
    if ranges:
        i1 = np.array([r["i1"] for r in ranges])
        i2 = np.array([r["i2"] for r in ranges])
        np.add.at(step, i1, 1)
        np.add.at(step, i2 + length, -1)
    return np.cumsum(step[:n_words]) > 0


def intervals(gone: np.ndarray) -> list[list[int]]:
    """Maximal intervals ``[from, to)`` of the removed words."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
    return edge.reshape(-1, 2).tolist()


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH) -> DataFrame:
    """Per row of ``docs``: ``id_col, n_words, n_removed, intervals`` (maximal
    removal intervals ``[from, to)`` in words) and ``kept_text`` (the kept
    words joined by one space)."""
    keyed = _keyed(docs, id_col, text_col)
    found = repeated_windows(keyed, length).groupBy("k1", "k2").agg(F.collect_set(F.struct("i1", "i2")).alias("runs"))

    def cut(ids, texts, lists):
        n, gone_n, spans, kept = [], [], [], []
        for z, ranges in zip(texts, lists):
            words = _unpack(z).split()
            gone = covered(len(words), ranges, length)
            n.append(len(words))
            gone_n.append(int(gone.sum()))
            spans.append(intervals(gone))
            kept.append(b" ".join([w for w, g in zip(words, gone.tolist()) if not g] if ranges else words).decode("utf-8", "replace"))
        return [ids, n, gone_n, spans, kept]

    return map_batches(
        _join_docs(keyed, found, "left").select("id", "z", "runs"), cut,
        f"`{id_col}` long, n_words long, n_removed long, intervals array<array<int>>, kept_text string",
        [(id_col, pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
         ("intervals", pa.list_(pa.list_(pa.int32()))), ("kept_text", pa.string())])


def op10_substring_dedup(spark, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))
