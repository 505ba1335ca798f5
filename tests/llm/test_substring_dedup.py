"""Substring dedup against a brute-force count of windows."""

from __future__ import annotations

import hashlib
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyspark.llm.substring_dedup import remove_repeats

SCHEMA = "doc_id long, text string, n_words string, intervals string"


def brute(rows, length):
    words = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i:i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for (d, _), w in zip(rows, words):
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i:i + length])] > 1:
                gone[i:i + length] = [True] * length
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, length):
    df = spark.createDataFrame([(d, t, "x", None) for d, t in rows], SCHEMA)
    out = remove_repeats(df, length=length)
    return sorted([tuple(r) for r in out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256)).collect()], key=repr)


def corpus(seed, vocabulary, length):
    rnd = random.Random(seed)
    text = lambda n: [f"w{rnd.randrange(vocabulary)}é" for _ in range(n)]
    passages = [text(rnd.randrange(length, 3 * length)) for _ in range(6)]
    rows = []
    for d in range(120):
        words = text(rnd.randrange(0, 6 * length))
        for _ in range(rnd.randrange(3)):
            at = rnd.randrange(len(words) + 1)
            words[at:at] = rnd.choice(passages)[rnd.randrange(length // 2):]
        rows.append((d, rnd.choice([" ", "\n", "\t "]).join(words)))
    rows += [(200 + i, rows[i][1]) for i in range(15)]            # exact copies
    rows += [(300 + i, rows[i][1].replace("w1", "v1")) for i in range(30)]  # edited copies
    return rows


@pytest.mark.parametrize("seed, vocabulary, length", [(1, 500, 8), (2, 3, 6), (3, 5000, 35), (4, 2, 35), (5, 1, 4)])
def test_against_brute_force(spark, seed, vocabulary, length):
    rows = corpus(seed, vocabulary, length)
    assert run(spark, rows, length) == brute(rows, length)


def test_edge_cases(spark):
    long = " ".join(f"a{i}" for i in range(3000))
    rows = [(None, "a b c d e"), (None, None), (1, ""), (2, " \n\t"), (3, "a b c d e"), (3, "a b c d e"), (4, "a b c"),
            (5, "x x x x x x x"), (6, "no break b c d e"), (7, long), (8, long + " end"), (9, "a b c d")]
    assert run(spark, rows, 4) == brute(rows, 4)
    assert run(spark, [(1, None), (2, "a b")], 4) == brute([(1, None), (2, "a b")], 4)
    assert run(spark, [], 4) == []


def test_intervals_are_maximal(spark):
    df = spark.createDataFrame([(1, "p q a b c d e z"), (2, "a b c d e y")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in remove_repeats(df, length=3).collect()}
    assert got[1]["intervals"] == [[2, 7]] and got[1]["kept_text"] == "p q z"
    assert got[2]["intervals"] == [[0, 5]] and got[2]["kept_text"] == "y"


def test_texts_that_share_a_32_bit_hash(spark):
    rows = [(d, t) for d in (None, 7) for t in ("p q r s t 45278", "u v w x y z u v w 33363")] + [(1, "p q r s t")]
    same = [r["h"] for r in spark.createDataFrame(rows, "doc_id long, text string").select(F.hash("text").alias("h")).collect()]
    assert same[0] == same[1]
    assert run(spark, rows[2:], 3) == brute(rows[2:], 3)
    assert run(spark, rows, 3) == brute(rows, 3)


@pytest.mark.parametrize("id_", [7, None])
def test_many_equal_rows(spark, id_):
    """Thousands of rows with one id (or none) and one text: linear in them."""
    rnd = random.Random(11)
    text = " ".join(f"w{rnd.randrange(5000)}" for _ in range(600))
    other = text.split()[100:180] + [f"v{i}" for i in range(50)]
    rows = [(1, " ".join(other), "x", None), *[(id_, text, "x", None)] * 5000]
    began = time.monotonic()
    out = remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(8)).groupBy("doc_id", "n_words", "n_removed").count().collect()
    assert {tuple(r) for r in out} == {(1, 130, 80, 1), (id_, 600, 600, 5000)}
    assert time.monotonic() - began < 90
