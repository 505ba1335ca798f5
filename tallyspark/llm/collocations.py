r"""Phrase collocations by weighted acyclic automata of n-gram counts.

Texts are lower-cased (A-Z) and split in pieces and words; everything is counted
per language. A candidate is a phrase of two to ``LONGEST`` words that occurs
at least ``least`` times; its score compares that with its parts' counts at the
worst place to cut it.

1. Every task collects its documents' words into shards, sorts a shard's
   n-grams and builds their count automaton (``count_automaton``): prefixes and
   tails are stored once. The automaton is cut at given n-grams into prefix
   ranges; a block per shard and range goes through the shuffle.
2. The blocks of a range are united and their weights added up. N-grams below
   ``least`` go: no part of a candidate can be among them.
3. Every candidate asks for the counts of its parts. A prefix is met on the
   candidate's own path. The others are asked from the automaton of their range,
   by composing it with the asked phrases. A range that is asked much (a very
   common word is part of very many phrases) is dealt to several tasks with a
   copy of its automaton each.

The places of the cuts come from a bounded sample of n-grams; they balance the
ranges and change no result. A cut may lie inside the n-grams of one first word,
so a word that holds a third of the corpus is spread too; repeated n-grams of a
shard are one entry. A shard has ``shard_words`` words, a range about
``range_bytes`` of text. Blocks number shards times ranges, so for a corpus of
many terabytes both sizes should be raised with the executors' memory.

Scores are whole numbers, worked out in decimals. The first phrases of a
language are found by rounds over groups of bounded size.

Cases: null and empty texts have no words; a null language is ``und``. Repeated
rows count as often as they come; equal scores are ordered by count, then by
phrase in UTF-8 byte order. Long texts are read whole (the words of one document
must fit a task). An empty table, or one without candidates, gives an empty
result. Extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import give_back, table
from tallyspark.llm.count_automaton import Lookup, Trie
from tallyspark.session import stage, unstage

LONGEST = 4             # words of a phrase
LEAST = 30
TOP = 2000
SHARE = (100, 80)       # a longer phrase absorbs a shorter one at 80 of 100 of its count
SCALE = 2_000_000
SHARD_WORDS = 2_000_000
RANGE_BYTES = 12_000_000
UNION_NODES = 1_000_000  # nodes of blocks taken together before they are united
SAMPLE_ROWS, SAMPLE_GRAMS = 2_000, 48
ASKED = 50_000          # parts looked up by one task in one range
GROUP = 100_000         # rows of a group when the first phrases are sought
# A-Z to lower case, tab to space, ``.,;:!?`` and line ends to the sign between pieces
BREAK = b"\xff"
SIGNS = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r",
                        b"abcdefghijklmnopqrstuvwxyz " + BREAK * 10)
BLOCK = "range int, data binary"
ARROW_BLOCK = pa.schema([("range", pa.int32()), ("data", pa.binary())])


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words, ``BREAK`` standing between pieces."""
    return text.translate(SIGNS).replace(BREAK, b" " + BREAK + b" ").split()


class Shard:
    """Words of documents, numbered as they come."""

    def __init__(self):
        self.numbers = _Numbers()
        self.parts: list[np.ndarray] = []
        self.langs: list[tuple[bytes, int]] = []
        self.size = 0

    def add(self, lang: bytes, text: bytes) -> None:
        words = words_of(text)
        if not words:
            return
        words.append(BREAK)
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words)))
        self.langs.append((lang, len(words)))
        self.size += len(words)

    def trie(self, longest: int) -> Trie:
        found = [w for w in self.numbers if w != BREAK]
        labels = sorted({*found, *[lang for lang, _ in self.langs]})
        place = {w: i for i, w in enumerate(labels)}
        rank = np.full(len(self.numbers) + 1, -1, np.int64)  # the last place is the break's
        for w in found:
            rank[self.numbers[w]] = place[w]
        groups = np.repeat([place[lang] for lang, _ in self.langs], [n for _, n in self.langs])
        return Trie.of_words(labels, groups, rank[np.concatenate(self.parts)], longest)


class _Numbers(dict):
    def __init__(self):
        super().__init__({BREAK: -1})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self) - 1
        return n


def _valid(text: bytes | None) -> bytes:
    return (text or b"").decode("utf-8", "replace").encode()


def _pairs(batch: pa.RecordBatch):
    """``(lang, text)`` as bytes in UTF-8."""
    for i in range(0, batch.num_rows, 512):
        part = batch.slice(i, 512)
        langs, texts = (part.column(k).cast(pa.large_binary()).to_pylist() for k in (0, 1))
        yield from zip(map(_valid, langs), map(_valid, texts))


def _spoken(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.col(text_col).cast("string").alias("text"))


def sample_bounds(docs: DataFrame, range_bytes: int, longest: int) -> list[tuple[bytes, ...]]:
    """N-grams (the language first) that cut all of them in even ranges."""
    rows, size = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    ranges = -(-(size or 0) // range_bytes)
    if ranges < 2:
        return []

    def grams(batches):
        rnd = np.random.default_rng(7)
        for batch in batches:
            out = []
            for lang, text in _pairs(batch):
                words = words_of(text)
                for at in rnd.integers(0, max(len(words), 1), SAMPLE_GRAMS).tolist():
                    piece = words[at:at + int(rnd.integers(1, longest + 1))]
                    if piece and BREAK not in piece:
                        out.append([lang, *piece])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.binary()))], names=["gram"])

    wide = max(1, ranges // 1000)  # more rows for very many ranges
    found = docs.sample(min(1.0, SAMPLE_ROWS * wide / rows), seed=3).mapInArrow(grams, "gram array<binary>").distinct()
    keys = sorted(tuple(map(bytes, r["gram"])) for r in found.toLocalIterator())
    return sorted({keys[len(keys) * k // ranges] for k in range(1, ranges)}) if keys else []


def count_blocks(docs: DataFrame, bounds: list[tuple[bytes, ...]], longest: int, shard_words: int) -> DataFrame:
    """One automaton per shard and prefix range."""
    def run(batches):
        shard = Shard()

        def blocks():
            for r, part in shard.trie(longest).cut(bounds):
                yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([part.pack()], pa.binary())],
                                                 schema=ARROW_BLOCK)

        for batch in batches:
            for lang, text in _pairs(batch):
                shard.add(lang, text)
                if shard.size >= shard_words:
                    yield from blocks()
                    shard = Shard()
        if shard.size:
            yield from blocks()
        del shard
        give_back()

    return docs.mapInArrow(run, BLOCK)


def _rows(batches):
    """``(range, data)``."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.column(0)[i].as_py(), batch.column(1)[i].as_py()


def united(blocks: DataFrame, least: int) -> DataFrame:
    """One automaton per range: the n-grams of at least ``least`` and the
    languages' word counts."""
    def run(batches):
        own, tries, nodes = None, [], 0

        def result():
            whole = Trie.union(tries).at_least(least, 1)
            return pa.RecordBatch.from_arrays([pa.array([own], pa.int32()), pa.array([whole.pack()], pa.binary())],
                                              schema=ARROW_BLOCK)

        for r, data in _rows(batches):
            if r != own and tries:
                yield result()
                tries, nodes = [], 0
            own = r
            tries.append(Trie.unpack(data))
            nodes += tries[-1].nodes
            if nodes > UNION_NODES:
                tries = [Trie.union(tries)]
                nodes = 0
        if tries:
            yield result()
        give_back()

    return blocks.repartition(F.col("range")).sortWithinPartitions("range").mapInArrow(run, BLOCK)


def _parts(size: int) -> list[tuple[int, int]]:
    """The parts ``[from, to)`` of a phrase whose counts it needs: all at its
    ends, and those of two words and more inside."""
    return [(i, j) for i in range(size) for j in range(i + 1, size + 1)
            if (i, j) != (0, size) and (i == 0 or j == size or j - i > 1)]


ASK = "range int, lang string, phrase string, a long, start int, stop int, f long"
ARROW_ASK = [("range", pa.int32()), ("lang", pa.string()), ("phrase", pa.string()), ("a", pa.int64()),
             ("start", pa.int32()), ("stop", pa.int32()), ("f", pa.int64())]


def asked_parts(frequent: DataFrame, bounds: list[tuple[bytes, ...]]) -> DataFrame:
    """``ASK``: a row per candidate and part; ``f`` is known for prefixes that
    lie in the candidate's range, ``range`` is the part's. Rows without a phrase
    hold the words of a language in ``a``."""
    def run(batches):
        for _, data in _rows(batches):
            trie = Trie.unpack(data)
            text = [w.decode("utf-8", "replace") for w in trie.labels]
            paths: list[tuple] = [((), ())]
            out: list[tuple] = []
            for depth, (parent, word, weight) in enumerate(trie.levels):
                grown = []
                for p, w, n in zip(parent.tolist(), word.tolist(), weight.tolist()):
                    gram, counts = paths[p]
                    gram, counts = (*gram, w), (*counts, n)
                    grown.append((gram, counts))
                    if depth == 0:
                        if n:
                            out.append((None, text[w], None, n, None, None, None))
                    elif depth > 1 and n:
                        lang, phrase = text[gram[0]], " ".join([text[i] for i in gram[1:]])
                        head, own = trie.labels[gram[0]], [trie.labels[i] for i in gram[1:]]
                        for i, j in _parts(depth):
                            known = counts[j] if i == 0 and counts[j] else None
                            to = None if known else bisect_right(bounds, (head, *own[i:j]))
                            out.append((to, lang, phrase, n, i, j, known))
                paths = grown
            for i in range(0, len(out), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out[i:i + 10_000]), ARROW_ASK)],
                                                 schema=pa.schema(ARROW_ASK))
        give_back()

    return frequent.mapInArrow(run, ASK)


def answered(asked: DataFrame, frequent: DataFrame, asked_by_task: int) -> DataFrame:
    """``lang, phrase, a, start, stop, f`` of all asked parts."""
    open_ = asked.where("range is not null")
    dealt = open_.groupBy("range").agg(F.ceil(F.count(F.lit(1)) / F.lit(asked_by_task)).cast("int").alias("pieces"))
    dealt = stage(dealt, "phrase-pieces")
    none = F.lit(None)
    questions = (open_.join(dealt, "range")
                 .select("range", F.pmod(F.xxhash64("lang", "phrase", "start", "stop"), F.col("pieces")).cast("int").alias("piece"),
                         F.lit(1).alias("kind"), none.cast("binary").alias("data"),
                         "lang", "phrase", "a", "start", "stop"))
    copies = (frequent.join(dealt, "range")
              .select("range", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), F.lit(0).alias("kind"),
                      "data", none.cast("string").alias("lang"), none.cast("string").alias("phrase"),
                      none.cast("long").alias("a"), none.cast("int").alias("start"), none.cast("int").alias("stop")))

    def run(batches):
        automaton = None
        for batch in batches:
            kinds = batch.column(2).to_numpy()
            edges = [0, *(np.flatnonzero(kinds == 0)).tolist(), batch.num_rows]
            for low, high in zip(edges, edges[1:]):
                if low < high and kinds[low] == 0:
                    automaton = Lookup(batch.column(3)[low].as_py())
                    low += 1
                part = batch.slice(low, high - low)
                if not part.num_rows:
                    continue
                langs, phrases, starts, stops = (part.column(k).to_pylist() for k in (4, 5, 7, 8))
                grams = [(lang.encode(), *phrase.encode().split(b" ")[i:j])
                         for lang, phrase, i, j in zip(langs, phrases, starts, stops)]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(k) for k in (4, 5, 6, 7, 8)], pa.array(automaton.weights(grams))],
                    names=["lang", "phrase", "a", "start", "stop", "f"])
        give_back()

    found = (copies.unionByName(questions).repartition("range", "piece").sortWithinPartitions("range", "piece", "kind")
             .mapInArrow(run, "lang string, phrase string, a long, start int, stop int, f long"))
    known = asked.where("f is not null").select("lang", "phrase", "a", "start", "stop", "f")
    out = stage(found.unionByName(known), "phrase-answers")
    unstage(dealt)
    return out


def scored(answers: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of all candidates: the cut of the lowest
    score, of ties the one after fewer words."""
    def count(i, j):
        return F.max(F.when((F.col("start") == F.lit(i)) & (F.col("stop") == j), F.col("f")))

    size = F.size(F.split("phrase", " "))
    cuts = range(1, LONGEST)
    one = answers.groupBy("lang", "phrase", "a").agg(
        *[count(0, F.lit(k)).alias(f"l{k}") for k in cuts], *[count(k, size).alias(f"r{k}") for k in cuts])
    best = F.array_min(F.array(*[
        F.when(F.col(f"l{k}").isNotNull() & F.col(f"r{k}").isNotNull(),
               F.struct(F.expr(f"cast({SCALE} * cast(a as decimal(20,0)) div (cast(l{k} as decimal(20,0)) + r{k}) as long)").alias("score"),
                        F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))) for k in cuts]))
    return one.select("lang", "phrase", "a", best.alias("b")).select("lang", "phrase", "a", "b.l", "b.r", "b.score")


def absorbed(answers: DataFrame) -> DataFrame:
    """``lang, phrase`` of candidates that lie in a longer one which occurs
    almost as often."""
    whole, share = SHARE
    part = F.expr("array_join(slice(split(phrase, ' '), start + 1, stop - start), ' ')")
    big = lambda c: F.col(c).cast("decimal(20,0)")
    return (answers.where((F.col("stop") - F.col("start") > 1) & (big("a") * whole >= big("f") * share))
            .select("lang", part.alias("phrase")).distinct())




def _ranked(df: DataFrame, top: int, *groups) -> DataFrame:
    order = Window.partitionBy("lang", *groups).orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())
    return df.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)


def first_phrases(df: DataFrame, top: int, group: int = GROUP) -> DataFrame:
    """A staged ``df`` with ``rank``, its first ``top`` rows per language.
    Rounds over groups of about ``group`` rows leave the first of each, so no
    task sorts a whole language."""
    rows = df.count()
    while rows > group:
        part = F.pmod(F.xxhash64("phrase"), F.lit(-(-rows // group)))
        left = stage(_ranked(df.withColumn("part", part), top, "part").drop("rank", "part"), "phrase-first")
        unstage(df)
        df, before, rows = left, rows, left.count()
        if rows * 2 > before:  # few rows a language: nothing to thin out
            break
    out = stage(_ranked(df, top), "phrase-ranked")
    unstage(df)
    return out


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, top: int = TOP,
                 shard_words: int = SHARD_WORDS, range_bytes: int = RANGE_BYTES, asked_by_task: int = ASKED,
                 group: int = GROUP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``top``
    phrases."""
    spoken = _spoken(docs, lang_col, text_col)
    bounds = sample_bounds(spoken, range_bytes, LONGEST)
    frequent = stage(united(count_blocks(spoken, bounds, LONGEST, shard_words), least), "phrase-counts")
    asked = stage(asked_parts(frequent, bounds), "phrase-asked")
    answers = answered(asked, frequent, asked_by_task)
    words = asked.where("phrase is null").select("lang", F.col("a").alias("n"))
    kept = stage(scored(answers).join(absorbed(answers), ["lang", "phrase"], "left_anti"), "phrase-scores")
    unstage(frequent, answers)
    best = first_phrases(kept, top, group)
    out = stage(best.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "phrase-top")
    unstage(asked, best)
    return out


# Pieces and words are numbered, phrases of 2 to 4 words made by hand.
ORACLE = r"""
with pieces as (
  select coalesce(lang, 'und') as lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
lists as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
grams as (
  select lang, k as size, array_to_string(w[i:i + k - 1], ' ') as phrase
  from (select lang, w, k, unnest(generate_series(1, len(w) - k + 1)) as i
        from lists, (values (1), (2), (3), (4)) as sizes(k) where len(w) >= k)),
counts as (select lang, size, phrase, count(*)::hugeint as f from grams group by all),
totals as (select lang, sum(f) as n from counts where size = 1 group by lang),
cand as (select lang, size, phrase, string_split(phrase, ' ') as w, f as a from counts where size > 1 and f >= 30),
cuts as (
  select c.lang, c.size, c.phrase, c.a, k, l.f as l, r.f as r, 2000000 * c.a // (l.f + r.f) as score
  from cand c, (values (1), (2), (3)) as ks(k)
  join counts l on l.lang = c.lang and l.phrase = array_to_string(c.w[:k], ' ') and l.size = k
  join counts r on r.lang = c.lang and r.phrase = array_to_string(c.w[k + 1:], ' ') and r.size = c.size - k
  where k < c.size),
worst as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inside as (
  select distinct b.lang, array_to_string(b.w[i:i + k - 1], ' ') as phrase, b.a
  from cand b, (values (2), (3)) as ks(k), (values (1), (2), (3)) as starts(i)
  where k < b.size and i + k - 1 <= b.size),
gone as (
  select distinct c.lang, c.phrase from cand c join inside i on i.lang = c.lang and i.phrase = c.phrase
  where 100 * i.a >= 80 * c.a),
ranked as (
  select lang, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank, phrase, a, l, r, score
  from worst anti join gone using (lang, phrase))
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
from ranked join totals using (lang) where rank <= 2000
"""


def op13_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
