r"""Token counts under a unigram vocabulary, by dynamic programming shared in a
trie.

A text is cut into pre-tokens (matches of the pattern). The distinct pre-tokens
of a task are inserted in a trie; every trie node keeps the best unigram score
of the bytes from the root to it and the number of tokens of that best
segmentation. The forward step of a node looks back over the pieces that end
there, so it runs once per shared prefix; a pre-token's answer is stored at its
terminal node. A text's count is the sum over its pre-tokens.

Scores: the public vocabulary files hold ranks, not probabilities, so a piece
of rank r scores ``-log(r + RANK_SHIFT)`` (Zipf's law). Equal scores take fewer
tokens. Single bytes are always pieces (the vocabulary holds all 256), so every
text has a segmentation.

Shape at scale: one scan, no shuffle. The trie belongs to a task; beyond
``MAX_NODES`` nodes it is started anew, which costs time only.

Cases: null and empty texts count 0. Very long pre-tokens are inserted whole
like any other (work and nodes are linear in them). Repeated rows get equal results; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from math import log

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.bpe import read_ranks, vocabulary_path
from tallyspark.llm.common import map_task, table
from tallyspark.llm.pretokens import Memo, Splitter, cut

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
RANK_SHIFT = 10
MAX_NODES = 2_000_000
MAX_PIECES = 400_000


class UnigramTrie:
    """Forward scores per node. A node is its number; ``up`` leads back to the
    root, so the nodes of the path are at hand for the look-back."""

    def __init__(self, ranks: dict[bytes, int]):
        self.score = {p: -log(r + RANK_SHIFT) for p, r in ranks.items()}
        self.longest = max(map(len, self.score))
        # backwards prefixes: a look-back stops once no piece ends this way
        self.tails = {p[i:] for p in self.score for i in range(len(p))}
        self._reset()

    def _reset(self) -> None:
        self.child: dict[int, int] = {}
        self.best: list[float] = [0.0]
        self.tokens: list[int] = [0]
        self.terminals: dict[bytes, int] = {}

    def _forward(self, word: bytes, end: int, best: list[float], tokens: list[int]) -> tuple[float, int]:
        """Best score and its tokens for ``word[:end]`` from those of the
        shorter prefixes."""
        top, count = float("-inf"), 0
        score, tails = self.score, self.tails
        for start in range(end - 1, max(0, end - self.longest) - 1, -1):
            piece = word[start:end]
            if piece not in tails:
                break
            s = score.get(piece)
            if s is not None:
                s += best[start]
                n = tokens[start] + 1
                if s > top or (s == top and n < count):
                    top, count = s, n
        return top, count

    def count(self, word: bytes) -> int:
        """Tokens of one pre-token; inserts it."""
        stored = self.terminals.get(word)
        if stored is not None:
            return stored
        if len(self.best) > MAX_NODES:
            self._reset()
        node, best, tokens = 0, [0.0], [0]
        for end, byte in enumerate(word, 1):
            at = node << 8 | byte
            node = self.child.get(at)
            if node is None:
                b, n = self._forward(word, end, best, tokens)
                node = self.child[at] = len(self.best)
                self.best.append(b)
                self.tokens.append(n)
            else:
                b, n = self.best[node], self.tokens[node]
            best.append(b)
            tokens.append(n)
        self.terminals[word] = tokens[-1]
        return tokens[-1]


PRE = 1 << 40  # pre-tokens are counted in the upper bits of a piece's number


class Counter:
    def __init__(self, path: str, pattern: str):
        self.trie = UnigramTrie(read_ranks(path))
        self.split = Splitter(pattern)
        self.first = Memo(self._count, "", MAX_PIECES // 8)
        self.later = Memo(self._count, " ", MAX_PIECES)

    def _count(self, text: str) -> int:
        words = self.split(text)
        return PRE * len(words) + sum(self.trie.count(w.encode()) for w in words)

    def count(self, text: str) -> tuple[int, int]:
        """``(pre-tokens, tokens)`` of a whole text."""
        self.first.trim()
        self.later.trim()
        pieces = cut(text)
        return divmod(self.first[pieces[0]] + sum(map(self.later.__getitem__, pieces[1:])), PRE)


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``doc_id, n_pretokens, n_tokens`` per row of ``docs``."""
    def make():
        own = Counter(vocabulary_path(vocabulary), pattern)

        def run(ids, texts):
            found = [own.count((t or b"").decode("utf-8", "replace")) for t in texts]
            return [ids, [a for a, _ in found], [b for _, b in found]]
        return run

    return map_task(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), make,
                    "doc_id long, n_pretokens long, n_tokens long",
                    [("doc_id", pa.int64()), ("n_pretokens", pa.int64()), ("n_tokens", pa.int64())])


def op1_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
