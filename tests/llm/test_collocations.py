"""Collocations against a plain count in Python; automata against dicts."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from tallyspark.llm import collocations
from tallyspark.llm.count_automaton import Lookup, Trie


def plain(rows, least, top, longest=4):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    cand = {g: a for g, a in f.items() if len(g[1]) > 1 and a >= least}
    gone = {(lang, w[i:j]) for (lang, w), a in cand.items() for i in range(len(w)) for j in range(i + 2, len(w) + 1)
            if j - i < len(w) and 100 * a >= 80 * f[lang, w[i:j]]}
    out = {}
    for (lang, w), a in cand.items():
        if (lang, w) not in gone:
            score, k = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((lang, rank, p.decode(), -a, left, right, n[lang], -s)
                  for lang, found in out.items() for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1))


def random_rows(seed, n=150, words=12):
    rnd = random.Random(seed)
    vocab = [rnd.choice(["the", "of", "Ab", "é", "x\x01", "日本", "don't", "-"]) + str(rnd.randrange(words // 3)) for _ in range(words)]
    rows = []
    for _ in range(n):
        text = "".join(rnd.choice(vocab) + rnd.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", " the "]) for _ in range(rnd.randrange(60)))
        rows.append((rnd.choice(["en", "en", "en", "d e", None]), text))
    return [*rows, *rows[:20], ("en", None), ("en", ""), (None, " .,\n"), ("en", "the " * 500)]


def frame(spark, rows):
    return spark.createDataFrame([(i, lang, t, 7, "x") for i, (lang, t) in enumerate(rows)],
                                 "doc_id long, lang string, text string, a int, phrase string")


@pytest.mark.parametrize("sizes", [{}, {"shard_words": 300, "range_bytes": 400, "asked_by_task": 5, "group": 20}])
def test_against_a_plain_count(spark, monkeypatch, sizes):
    rows = random_rows(1 + len(sizes))
    monkeypatch.setattr(collocations, "UNION_NODES", 200)
    out = collocations.collocations(frame(spark, rows).repartition(5), least=4, top=25, **sizes)
    want = plain(rows, 4, 25)
    assert len(want) > 50
    assert sorted(map(tuple, out.collect())) == want


def test_empty(spark):
    assert collocations.collocations(frame(spark, [])).collect() == []
    assert collocations.collocations(frame(spark, [("en", "a b c"), (None, None)])).collect() == []


def grams(trie):
    paths, out = [()], {}
    for parent, word, weight in trie.levels:
        paths = [(*paths[p], trie.labels[w]) for p, w in zip(parent.tolist(), word.tolist())]
        assert paths == sorted(set(paths))
        out.update(zip(paths, weight.tolist()))
    return out


def random_trie(rnd):
    shard = collocations.Shard()
    for _ in range(rnd.randrange(1, 8)):
        shard.add(rnd.choice([b"en", b"de"]), b" ".join(rnd.choice([b"a", b"b", b"c", b"dd", b"."]) for _ in range(rnd.randrange(30))))
    return shard.trie(4) if shard.size else random_trie(rnd)


def test_automata():
    rnd = random.Random(4)
    for _ in range(150):
        tries = [random_trie(rnd) for _ in range(rnd.randrange(1, 5))]
        sums = Counter()
        for t in tries:
            held = grams(t)
            sums.update(held)
            data = t.pack()
            assert grams(Trie.unpack(data)) == held
            asked = [*held, (b"en", b"zz"), (b"zz",), (b"en", b"a", b"a", b"a", b"a", b"a")]
            assert Lookup(data).weights(asked).tolist() == [held.get(g, 0) for g in asked]
        whole = Trie.union(tries)
        assert grams(whole) == sums
        bounds = sorted({tuple(rnd.choice([b"a", b"bb", b"c", b"dd", b"en", b"de", b"zz"]) for _ in range(rnd.randrange(1, 6)))
                         for _ in range(rnd.randrange(7))} | set(rnd.sample(sorted(sums), min(len(sums), 3))))
        back = Counter()
        for number, part in whole.cut(bounds):
            low, high = ([(), *bounds][number], [*bounds, (b"\xff",)][number])
            own = {g: n for g, n in grams(part).items() if n}
            assert all(low <= g < high for g in own)
            back.update(own)
        assert back == sums
        heavy = {g: n for g, n in grams(whole.at_least(3, 1)).items() if n}
        assert heavy == {g: n for g, n in sums.items() if n >= 3 or len(g) == 1}


def test_equal_tails_are_one_state():
    shard = collocations.Shard()
    for i in range(200):
        shard.add(b"en", b"w%d over the hill." % i)
    trie = shard.trie(4)
    from tallyspark.llm.count_automaton import unpack_states
    states = sum(len(s[0]) for s in unpack_states(trie.pack())[1])
    assert trie.nodes > 800 and states < 30
