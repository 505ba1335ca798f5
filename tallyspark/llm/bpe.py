r"""Byte-level BPE by a lazily determinised finite-state transducer.

A token sequence is the encoding of its bytes exactly when every token encodes
itself and every two neighbours encode as themselves when put together. So the
merges compile to a transducer: its nondeterministic states are (token before,
node in the byte trie of the vocabulary), and a token may end where the trie
has one and its pair with the token before is stable. Read as sets of states
with their pending tokens, it is deterministic; sets are built when met, and
each new path leaves its first ones behind for the paths after it. Tokens that all members agree on are emitted at once, so output lags
the input by a bounded number of bytes (members end within one longest token of
each other). Each prefix has one encoding, so at the end one member is left.

Pieces are the matches of the pre-token pattern; a piece that is itself a token
is that token. What pieces encode to is kept in a bounded table per worker and stage.

Decoding joins the tokens' bytes; ``Utf8Stream`` turns them into text piece by
piece, its state being the bytes of an unfinished character.

Cases: a null or empty text has no token. Long texts are read whole; work is
linear in them. Repeated rows and ties get equal results; an empty table gives
an empty result; extra columns are ignored. Byte sequences that are not UTF-8
decode to U+FFFD.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import map_task, shared, table
from tallyspark.llm.pretokens import Memo, Splitter, cut

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
MAX_STATES = 400_000    # sets of states kept before starting anew
LEARNED = 8             # steps kept of each path that leads beyond the kept ones
MAX_PAIRS = 300_000     # tested pairs of tokens kept before starting anew
MAX_PIECES = 1_800_000  # cut pieces and words whose ids are kept before starting anew
TOKEN_BITS = 24
TOKEN_MASK = (1 << TOKEN_BITS) - 1
CHUNK = 1 << 14         # tokens decoded at a time


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """Plain merging of one short piece: the lowest rank first, then the
    leftmost."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, i = min((ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank == 1 << 60:
            break
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts


def halves(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """What the last merge of a token joins; null for a single byte or a token
    that its own bytes do not merge to."""
    limit = ranks[token]
    parts = merge(token, {k: r for i in range(len(token)) for j in range(i + 1, len(token) + 1)
                          if (r := ranks.get(k := token[i:j])) is not None and r < limit})
    return (parts[0], parts[1]) if len(parts) == 2 else None


class Vocabulary:
    """What depends on the vocabulary file only: its tokens, their byte trie
    and the parts of their merges."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.digits = {i: str(i) for i in self.bytes_of}
        # (node << 8 | byte) -> (node << TOKEN_BITS | 1 + the token that ends there, or 0)
        if max(self.bytes_of) + 2 >> TOKEN_BITS:
            raise ValueError("too many tokens")
        self.trie: dict[int, int] = {}
        n = 1
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                at = node << 8 | byte
                found = self.trie.get(at)
                if found is None:
                    found = self.trie[at] = n << TOKEN_BITS
                    n += 1
                node = found >> TOKEN_BITS
            self.trie[at] |= rank + 1
        self.edges: dict[int, tuple] = {}  # filled when asked: at most one entry per token


class Transducer:
    """Encodes pieces of bytes; states are determinised when first met."""

    def __init__(self, vocabulary: Vocabulary, states: int = MAX_STATES, learned: int = LEARNED):
        self.most, self.learned = states, learned
        self.ranks, self.bytes_of = vocabulary.ranks, vocabulary.bytes_of
        self.trie, self.edges = vocabulary.trie, vocabulary.edges
        self.pairs: dict[int, bool] = {}  # token before << TOKEN_BITS | token -> stable
        self._reset()

    def _reset(self) -> None:
        # a set of states is kept packed: (before, node, length, pending...) of every member
        start = np.array([-1, 0, 0], np.int32).tobytes()
        self.ids: dict[bytes, int] = {start: 0}
        self.sets: list[bytes] = [start]
        # state << 8 | byte -> next state, or ~index in ``emits`` if tokens become certain
        self.steps: dict[int, int] = {}
        self.emits: list[tuple[int, tuple]] = []
        self.finals: dict[int, tuple] = {}

    def trim(self) -> None:
        if len(self.sets) > self.most:
            self._reset()
        if len(self.pairs) > MAX_PAIRS:
            self.pairs.clear()

    def _spines(self, token: int) -> tuple:
        """``(left, right)``: the parts of a token that touch its left and its
        right end while it is merged, from the single byte to the token, each
        with the rank that made it. None if the merges never build it."""
        found = self.edges.get(token, 0)
        if found == 0:
            data = self.bytes_of[token]
            if len(data) == 1:
                found = ([(-1, data)], [(-1, data)])
            elif cut := halves(data, self.ranks):
                a, b = self._spines(self.ranks[cut[0]]), self._spines(self.ranks[cut[1]])
                found = ([*a[0], (token, data)], [*b[1], (token, data)]) if a and b else None
            else:
                found = None
            self.edges[token] = found
        return found

    def _stable(self, before: int, token: int) -> bool:
        """No merge joins the two tokens' touching parts before both are
        whole: the parts are followed in the order of their ranks."""
        ends = self._spines(token)
        if before < 0 or ends is None:
            return ends is not None
        left, right = self._spines(before)[1], ends[0]
        i = j = 0
        ok, get = True, self.ranks.get
        while True:
            grow_left = left[i + 1][0] if i + 1 < len(left) else 1 << 60
            grow_right = right[j + 1][0] if j + 1 < len(right) else 1 << 60
            joined = get(left[i][1] + right[j][1], 1 << 60)
            # the lowest rank goes first; of equal ranks the leftmost
            if joined < grow_left and joined <= grow_right and joined < 1 << 60:
                ok = False
                break
            if grow_left == grow_right == 1 << 60:
                break
            if grow_left <= grow_right:
                i += 1
            else:
                j += 1
        self.pairs[before << TOKEN_BITS | token] = ok
        return ok

    def _members(self, state: int) -> list[tuple]:
        flat, members, at = memoryview(self.sets[state]).cast("i").tolist(), [], 0
        while at < len(flat):
            to = at + 3 + flat[at + 2]
            members.append((flat[at], flat[at + 1], tuple(flat[at + 3:to])))
            at = to
        return members

    def _advance(self, members: list[tuple], byte: int) -> tuple[list[tuple], tuple]:
        """The set of states after one more byte, and the tokens that have
        become certain."""
        out, trie, stable = [], self.trie.get, self.pairs.get
        for before, node, pending in members:
            found = trie(node << 8 | byte)
            if found is None:
                continue
            token = found & TOKEN_MASK
            out.append((before, found >> TOKEN_BITS, pending))
            if token:
                token -= 1
                ok = stable(before << TOKEN_BITS | token)
                if self._stable(before, token) if ok is None else ok:
                    out.append((token, 0, (*pending, token)))
        if not out:
            raise ValueError("the vocabulary lacks a byte of this text")
        first = out[0][2]
        n = len(first)  # pending tokens on which all members agree
        if n:
            for _, _, p in out:
                if p is not first and p[:n] != first[:n]:
                    n = next((i for i, (x, y) in enumerate(zip(p, first)) if x != y), min(n, len(p)))
                    if not n:
                        return out, ()
            return [(before, node, p[n:]) for before, node, p in out], first[:n]
        return out, ()

    def _keep(self, state: int, byte: int, members: list[tuple], certain: tuple) -> int:
        """Keeps a step of the deterministic machine and where it leads."""
        flat = []
        for before, node, pending in members:
            flat += (before, node, len(pending), *pending)
        key = array("i", flat).tobytes()
        to = self.ids.get(key)
        if to is None:
            to = self.ids[key] = len(self.sets)
            self.sets.append(key)
        self.steps[state << 8 | byte] = ~len(self.emits) if certain else to
        if certain:
            self.emits.append((to, certain))
        return to

    def stream(self, data: Iterable[int]) -> Iterator[int]:
        """Token ids of one piece, each as soon as it is certain. Kept steps
        are followed as far as they go; of those beyond them only the first
        ``learned`` are kept, so that what comes once leaves little behind."""
        state, get, emits, members, new = 0, self.steps.get, self.emits, None, self.learned
        for byte in data:
            step = get(state << 8 | byte)
            if step is not None:
                if step < 0:
                    step, certain = emits[~step]
                    yield from certain
                state, members = step, None
                continue
            members, certain = self._advance(members or self._members(state), byte)
            if new:
                state = self._keep(state, byte, members, certain)
                new -= 1
            else:
                state = -1  # not kept: no step leads on from it
            yield from certain
        last = self.finals.get(state)
        if last is None:
            last = self._final(members or self._members(state))
            if state >= 0:
                self.finals[state] = last
        yield from last

    @staticmethod
    def _final(members: list[tuple]) -> tuple:
        ends = [pending for _, node, pending in members if node == 0]
        if len(ends) != 1:
            raise ValueError("the vocabulary lacks a byte of this text")
        return ends[0]

    def encode(self, piece: bytes) -> tuple[int, ...]:
        whole = self.ranks.get(piece)
        return tuple(self.stream(piece)) if whole is None else (whole,)


class Tokenizer:
    """Encoder and decoder of one vocabulary file. What a piece encodes to is
    kept as its ids, packed in 32 bits each."""

    def __init__(self, vocabulary: Vocabulary, pattern: str, kept: int = MAX_PIECES, states: int = MAX_STATES,
                 learned: int = LEARNED):
        self.transducer = Transducer(vocabulary, states, learned)
        self.digits = vocabulary.digits
        self.split = Splitter(pattern)
        self.first = Memo(self._piece, "", kept // 16)
        self.later = Memo(self._piece, " ", kept // 8 * 7)
        self.words = Memo(self._word, "", kept // 16)

    def _word(self, text: str) -> bytes:
        return array("i", self.transducer.encode(text.encode())).tobytes()

    def _piece(self, text: str) -> bytes:
        words = self.split(text)
        if len(words) == 1:
            return self._word(text)  # kept as a piece already
        # letters after a space are one match wherever they stand, so they share the table of pieces
        later, others = self.later, self.words
        return b"".join([later[w[1:]] if w[0] == " " and w[1:].isalpha() else others[w] for w in words])

    def encode(self, text: str) -> list[int]:
        """Token ids of a whole text."""
        return self.packed(text).tolist()

    def packed(self, text: str) -> np.ndarray:
        """Token ids of a whole text, as 32-bit numbers."""
        self.first.trim()
        self.later.trim()
        self.words.trim()
        self.transducer.trim()
        pieces = cut(text)
        return np.frombuffer(b"".join([self.first[pieces[0]], *map(self.later.__getitem__, pieces[1:])]), np.int32)

    def decimal(self, ids: list[int]) -> str:
        """The ids as decimal numbers joined by commas."""
        return ",".join(map(self.digits.__getitem__, ids))

    def decode_bytes(self, ids: list[int]) -> Iterator[bytes]:
        """The bytes of the ids, chunk by chunk."""
        for i in range(0, len(ids), CHUNK):
            yield b"".join(map(self.transducer.bytes_of.__getitem__, ids[i:i + CHUNK]))

    def decode(self, ids: list[int]) -> Iterator[str]:
        """The text of the ids, chunk by chunk, never splitting a character."""
        stream = Utf8Stream()
        for data in self.decode_bytes(ids):
            yield stream.feed(data)
        yield stream.end()


class Utf8Stream:
    """Incremental UTF-8 decoding. The state is the start of a character whose
    continuation bytes have not come yet: none, or one to three bytes."""

    def __init__(self):
        self.open = b""

    def feed(self, data: bytes) -> str:
        data = self.open + data
        cut = len(data)
        for back in range(1, min(3, len(data)) + 1):
            lead = data[-back]
            if lead & 0xC0 != 0x80:  # not a continuation byte
                needs = 1 + (lead >= 0xC2) + (lead >= 0xE0) + (lead >= 0xF0)
                if back < needs <= 4 and lead < 0xF5:
                    cut -= back
                break
        self.open = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def end(self) -> str:
        rest, self.open = self.open, b""
        return rest.decode("utf-8", "replace")


def read_vocabulary(path: str) -> Vocabulary:
    """One per worker and stage, as the tokenizers' growing tables: nothing
    lies beside the stages after it in a reused worker."""
    return shared(path, lambda: Vocabulary(read_ranks(path)))


def tokenizer(path: str, pattern: str, kept: int = MAX_PIECES, states: int = MAX_STATES, learned: int = LEARNED) -> Tokenizer:
    """One per worker and stage, so that its tasks share what they have learned."""
    return shared((path, pattern, kept, states, learned), lambda: Tokenizer(read_vocabulary(path), pattern, kept, states, learned))


def vocabulary_path(name: str) -> str:
    return public_tokenizers.path(name)


def _text(t: bytes | None) -> str:
    return (t or b"").decode("utf-8", "replace")


def encode_documents(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``doc_id, ids array<int>`` per row of ``docs``."""
    def make():
        tok = tokenizer(vocabulary_path(vocabulary), pattern)
        return lambda ids, texts: [ids, [tok.packed(_text(t)) for t in texts]]

    return map_task(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), make,
                    "doc_id long, ids array<int>", [("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])


def decode_documents(encoded: DataFrame, vocabulary: str = VOCABULARY, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``."""
    def make():
        tok = tokenizer(vocabulary_path(vocabulary), pattern)
        return lambda doc_ids, ids: [doc_ids, ["".join(tok.decode(i or [])) for i in ids]]

    return map_task(encoded.select("doc_id", "ids"), make, "doc_id long, text string",
                    [("doc_id", pa.int64()), ("text", pa.string())])


def round_trip(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = public_tokenizers.PATTERN,
               with_ids: bool = False, kept: int = MAX_PIECES, states: int = MAX_STATES, learned: int = LEARNED) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_tokens, ids_sha256, decoded_sha256,
    round_trip`` (the streamed text equals the input) and, if asked for,
    ``ids array<int>``. ``kept`` and ``states`` bound the tables of pieces and
    of the transducer in a worker, ``learned`` what a new path adds to it; they
    change memory and time only."""
    def make():
        tok = tokenizer(vocabulary_path(vocabulary), pattern, kept, states, learned)

        def run(ids, texts):
            # the tables hold no cycles, and walking them again and again
            # takes a third of the time
            gc.disable()
            try:
                return measure(ids, texts)
            finally:
                gc.enable()

        def measure(ids, texts):
            n, a, b, same, every = [], [], [], [], []
            for t in texts:
                text = _text(t)
                packed = tok.packed(text)
                found = packed.tolist()
                n.append(len(found))
                a.append(hashlib.sha256(tok.decimal(found).encode()).hexdigest())
                digest, stream, out = hashlib.sha256(), Utf8Stream(), []
                for data in tok.decode_bytes(found):
                    digest.update(data)
                    out.append(stream.feed(data))
                out.append(stream.end())
                b.append(digest.hexdigest())
                same.append("".join(out) == text)
                if with_ids:
                    every.append(packed)
            return [ids, n, a, b, same, *([every] if with_ids else [])]
        return run

    return map_task(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), make,
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean"
        + (", ids array<int>" if with_ids else ""),
        [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
         ("decoded_sha256", pa.string()), ("round_trip", pa.bool_()),
         *([("ids", pa.list_(pa.int32()))] if with_ids else [])])


def op7_byte_bpe(spark, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
