r"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The characters of many words lie in one flat numpy array of symbols, with the
word of each symbol beside it. A round looks at every pair of neighbours of a
word, takes the smallest rank per word (a segmented minimum), merges all pairs
of that rank from left to right at once, and compacts the array; words without
a mergeable pair leave it. Rounds go on until no pair remains.

Merging all pairs of a rank at once equals merging one at a time unless a merge
makes a neighbouring pair of the same or a smaller rank, which would have to go
first. A round sees that in the ranks of the new pairs, and then stops in that
word after the merge that made it.

Words: the model escapes a space as U+2581 and puts one in front of the text. No
piece holds that sign after another character, so a merge never crosses the
place before it; texts are cut there. Inside the rounds a word is cut again
wherever no piece holds the two neighbouring characters. What a word encodes to
is kept in a table per task, bounded by ``MAX_WORDS`` short words; it is given
back when the task ends.

Decoding puts the pieces' text together, runs of byte pieces as UTF-8 with
U+FFFD for what is not, and drops the sign put in front.

The model file must be a BPE model with the identity normaliser, without
user-defined or unused pieces; others raise a ValueError.

Cases: a null or empty text has the end id only. Long texts and words without
spaces are read whole. Repeated rows and ties get equal results; an empty table
gives an empty result; extra columns are ignored. Bytes that are not UTF-8 are
read as U+FFFD.
"""

from __future__ import annotations

import codecs
import hashlib
import re
import struct
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import map_task, table

MODEL = "piece_bpe_32k.model"
MAX_WORDS = 400_000     # encoded words kept per task before starting anew (about 250 bytes each)
LONGEST = 48            # characters of a word that is kept
FLAT = 1 << 19          # characters merged together at a time
NONE = np.int64(1) << 40  # rank of a pair that is no piece
# Fixed values of the model format: the sign of a space, and the piece types.
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2
UNKNOWN_TEXT = " ⁇ "


def _fields(data: bytes):
    """``(number, value)`` of the fields of one serialised message."""
    i, n = 0, len(data)

    def number() -> int:
        nonlocal i
        out = shift = 0
        while True:
            byte = data[i]
            i += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while i < n:
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
        else:
            size = number() if kind == 2 else 4 if kind == 5 else 8
            yield tag >> 3, data[i:i + size]
            i += size


class Model:
    """The tables of one model file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            message = list(_fields(f.read()))
        trainer = dict(next((_fields(v) for k, v in message if k == 2), ()))
        normalizer = dict(next((_fields(v) for k, v in message if k == 3), ()))
        if trainer.get(3, 1) != BPE or normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(3, 1):
            raise ValueError("a BPE model with the identity normaliser and a leading space is needed")
        pieces = []
        for piece in (dict(_fields(v)) for k, v in message if k == 1):
            pieces.append((piece[1].decode(), struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0], piece.get(3, NORMAL)))
        kinds = {kind for _, _, kind in pieces}
        if kinds & {USER_DEFINED, UNUSED} or BYTE not in kinds:
            raise ValueError("a model with byte pieces and without user-defined or unused pieces is needed")
        self.end = trainer.get(42, 2)
        self.kinds = [kind for _, _, kind in pieces]
        self.text = [p for p, _, _ in pieces]
        byte_ids = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == BYTE}
        self.byte_ids = [byte_ids[b] for b in range(256)]
        self.byte_of = {i: bytes([b]) for b, i in byte_ids.items()}
        self.digits = [str(i) for i in range(len(pieces))]
        self.plain = [p.replace(SPACE, " ") for p in self.text]
        self.special = frozenset(i for i, kind in enumerate(self.kinds) if kind != NORMAL)
        normal = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == NORMAL}
        if any(SPACE in p.lstrip(SPACE) for p in normal):
            raise ValueError("a piece holds a space after another character")
        scores = sorted({pieces[i][1] for i in normal.values()}, reverse=True)
        rank_of = {s: r for r, s in enumerate(scores)}
        # symbols: the ids of pieces, then characters that are part of pieces only
        symbol = dict(normal)
        for c in sorted({c for p in normal for c in p} - symbol.keys()):
            symbol[c] = len(pieces) + len(symbol) - len(normal)
        self.symbols = len(pieces) + len(symbol) - len(normal)
        self.outside = {i: s for s, i in symbol.items() if i >= len(pieces)}
        self.char = np.full(0x110000, -1, np.int32)
        for s, i in symbol.items():
            if len(s) == 1:
                self.char[ord(s)] = i
        pairs: dict[int, int] = {}
        touching = set()
        for p, i in normal.items():
            touching.update((ord(a) << 32 | ord(b)) for a, b in zip(p, p[1:]))
            for k in range(1, len(p)):
                a, b = symbol.get(p[:k]), symbol.get(p[k:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = i
        self.pairs = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k] for k in self.pairs.tolist()], np.int64)
        self.ranks = np.array([rank_of[pieces[i][1]] for i in self.merged.tolist()], np.int64)
        self.touching = np.array(sorted(touching), np.int64)

    def look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(rank, merged symbol)`` of pairs of symbols; ``NONE`` and -1 of
        those that make no piece."""
        key = left << 32 | right
        at = np.searchsorted(self.pairs, key)
        at[at == len(self.pairs)] = 0
        hit = self.pairs[at] == key
        return np.where(hit, self.ranks[at], NONE), np.where(hit, self.merged[at], -1)


def _starts(word: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))


def merge_rounds(model: Model, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(symbols, word)`` after all merges. ``word`` numbers the symbols'
    words, rising."""
    done: list[tuple[np.ndarray, np.ndarray]] = []
    n = len(sym)
    rank, made = np.full(n, NONE), np.full(n, -1, np.int64)  # of the pair with the next symbol
    at = np.flatnonzero(word[1:] == word[:-1])
    rank[at], made[at] = model.look(sym[at], sym[at + 1])
    while len(sym):
        start = _starts(word)
        size = np.diff(np.append(start, len(sym)))
        least = np.minimum.reduceat(rank, start)
        open_ = least < NONE
        if not open_.all():  # words without a mergeable pair leave
            stays = np.repeat(open_, size)
            done.append((sym[~stays], word[~stays]))
            sym, word, rank, made = sym[stays], word[stays], rank[stays], made[stays]
            if not len(sym):
                break
            size, least = size[open_], least[open_]
            start = np.concatenate(([0], np.cumsum(size)[:-1]))
        best = rank == np.repeat(least, size)
        # of overlapping pairs every second one, from the left
        pos = np.arange(len(sym))
        fresh = best & ~np.concatenate(([False], best[:-1]))
        run_start = np.maximum.accumulate(np.where(fresh, pos, 0))
        take = np.flatnonzero(best & ((pos - run_start) % 2 == 0))
        # new neighbours, as they are when pairs further left are merged
        taken = np.zeros(len(sym) + 2, bool)
        taken[take] = True
        new = made[take]
        own = word[take]
        low = rank[take]
        before = np.maximum(take - 1, 0)
        has = (take > 0) & (word[before] == own)
        merged_before = has & (take > 1) & taken[take - 2]
        left = np.where(merged_before, made[np.maximum(take - 2, 0)], sym[before])
        after = np.minimum(take + 2, len(sym) - 1)
        has_after = (take + 2 < len(sym)) & (word[after] == own)
        early = (has & (model.look(left, new)[0] <= low)) | (has_after & (model.look(new, sym[after])[0] <= low))
        if early.any():
            seen = np.cumsum(early) - early
            first = _starts(own)
            seen -= np.repeat(seen[first], np.diff(np.append(first, len(own))))
            take = take[seen == 0]
        sym[take] = made[take]
        keep = np.ones(len(sym), bool)
        keep[take + 1] = False
        moved = np.cumsum(keep) - 1
        touched = moved[take]
        sym, word, rank, made = sym[keep], word[keep], rank[keep], made[keep]
        near = np.zeros(len(sym), bool)
        near[touched] = True
        near[touched[touched > 0] - 1] = True
        touched = np.flatnonzero(near)
        rank[touched], made[touched] = NONE, -1
        touched = touched[touched + 1 < len(sym)]
        touched = touched[word[touched] == word[touched + 1]]
        rank[touched], made[touched] = model.look(sym[touched], sym[touched + 1])
    if not done:
        return sym, word
    sym, word = np.concatenate([d[0] for d in done]), np.concatenate([d[1] for d in done])
    order = np.argsort(word, kind="stable")
    return sym[order], word[order]


def encode_words(model: Model, words: list[str]) -> list[list[int]]:
    """Ids of escaped words, merged together."""
    if not words:
        return []
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    sizes = np.array([len(w) for w in words])
    of = np.repeat(np.arange(len(words)), sizes)
    # cut where no piece holds the two characters
    key = codes[:-1] << 32 | codes[1:]
    at = np.searchsorted(model.touching, key)
    at[at == len(model.touching)] = 0
    cut = np.concatenate(([True], (of[1:] != of[:-1]) | (model.touching[at] != key)))
    sym = model.char[codes].astype(np.int64)
    unknown = sym < 0
    sym[unknown] = model.symbols + codes[unknown]
    segment = np.cumsum(cut) - 1
    sym, segment = merge_rounds(model, sym, segment)
    owner = of[np.flatnonzero(cut)][segment]
    out: list[list[int]] = [[] for _ in words]
    bounds = np.searchsorted(owner, np.arange(len(words) + 1)).tolist()
    ids = sym.tolist()
    plain = len(model.text)
    for k in range(len(words)):
        own = ids[bounds[k]:bounds[k + 1]]
        if own and max(own) >= plain:
            own = [i for s in own for i in ([s] if s < plain else _as_bytes(model, s))]
        out[k] = own
    return out


def _as_bytes(model: Model, symbol: int) -> list[int]:
    text = model.outside.get(symbol) or chr(symbol - model.symbols)
    return [model.byte_ids[b] for b in text.encode("utf-8", "replace")]


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "\ufffd" * (error.end - error.start), error.end


codecs.register_error("each-byte", _each_byte)


def decode(model: Model, ids: list[int]) -> str:
    """The text of ids, control ids left out; U+FFFD for every byte that is
    not UTF-8."""
    return _text(model, ids, True)


def _text(model: Model, ids: list[int], leading: bool) -> str:
    """``leading``: the space in front of the first piece is the one that
    encoding put there."""
    out, run = [], []
    for i in ids:
        if i in model.byte_of:
            run.append(model.byte_of[i])
            continue
        kind = model.kinds[i]
        if kind == CONTROL:
            piece = ""
        elif kind == UNKNOWN:
            piece = UNKNOWN_TEXT
        else:
            piece = model.text[i]
            if leading and not out and not run and piece.startswith(SPACE):
                piece = piece[1:]
            piece = piece.replace(SPACE, " ")
        if run:
            out.append(b"".join(run).decode("utf-8", "each-byte"))
            run = []
        if kind != CONTROL:
            out.append(piece)
    if run:
        out.append(b"".join(run).decode("utf-8", "each-byte"))
    return "".join(out)


_PIECES = re.compile(f"{SPACE}({SPACE}*[^{SPACE}]*)")


def cut_words(text: str) -> list[str]:
    """Words of a text, each without the escaped space before it."""
    if not text:
        return []
    text = SPACE + text.replace(" ", SPACE)
    return _PIECES.findall(text) if SPACE * 2 in text else text.split(SPACE)[1:]


class Encoder:
    """Encodes texts; keeps what words encode to: ``word -> (ids as text,
    decoded text)``."""

    def __init__(self, model: Model):
        self.model = model
        self.kept: dict[str, tuple[str, str]] = {}

    def _learn(self, words: list[str]) -> None:
        model = self.model
        digits, plain, special = model.digits, model.plain, model.special
        for word, ids in zip(words, encode_words(model, [SPACE + w for w in words])):
            self.kept[word] = (" ".join([digits[i] for i in ids]),
                               "".join([plain[i] for i in ids]) if special.isdisjoint(ids) else _text(model, ids, False))

    def __call__(self, texts: list[str]) -> list[tuple[str, str]]:
        """``(ids joined by spaces, decoded text)`` per text, the end id
        included."""
        cut = [cut_words(t) for t in texts]
        group, size, long = [], 0, []
        for word in set().union(*cut) - self.kept.keys():
            group.append(word)
            size += len(word) + 1
            if len(word) > LONGEST:
                long.append(word)
            if size >= FLAT:
                self._learn(group)
                group, size = [], 0
        self._learn(group)
        get, end = self.kept.__getitem__, self.model.digits[self.model.end]
        out = []
        for words in cut:
            pairs = list(map(get, words))
            ids = [i for i, _ in pairs]
            ids.append(end)
            out.append((" ".join(ids), "".join([t for _, t in pairs])[1:]))  # without the space in front
        for word in long:
            del self.kept[word]
        if len(self.kept) > MAX_WORDS:
            self.kept = {}
        return out


@lru_cache(1)
def read_model(path: str) -> Model:
    """One per worker process: its tables have the size of the vocabulary."""
    return Model(path)


def model_path(name: str) -> str:
    return public_tokenizers.path(name)


def _ids(text: str) -> np.ndarray:
    return np.array(text.split(" "), np.int32)


def encode_documents(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids array<int>`` (the end id last) per row of ``docs``."""
    def make():
        encoder = Encoder(read_model(model_path(model)))
        return lambda ids, texts: [ids, [_ids(i) for i, _ in encoder([(t or b"").decode("utf-8", "replace") for t in texts])]]

    return map_task(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), make,
                    "doc_id long, ids array<int>", [("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])


def decode_documents(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null ids give an empty text."""
    def make():
        own = read_model(model_path(model))
        return lambda doc_ids, ids: [doc_ids, [decode(own, i or []) for i in ids]]

    return map_task(encoded.select("doc_id", "ids"), make, "doc_id long, text string",
                    [("doc_id", pa.int64()), ("text", pa.string())])


def round_trip(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_tokens`` (all ids), ``ids_sha256`` (ids
    joined by a space), ``decoded_sha256``, ``round_trip`` (the decoded text
    equals the input; not so where the input holds U+2581 itself)."""
    def make():
        encoder = Encoder(read_model(model_path(model)))

        def run(ids, texts):
            texts = [(t or b"").decode("utf-8", "replace") for t in texts]
            found = encoder(texts)
            return [ids, [i.count(" ") + 1 for i, _ in found],
                    [hashlib.sha256(i.encode()).hexdigest() for i, _ in found],
                    [hashlib.sha256(t.encode()).hexdigest() for _, t in found],
                    [t == given for (_, t), given in zip(found, texts)]]
        return run

    return map_task(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), make,
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean",
        [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
         ("decoded_sha256", pa.string()), ("round_trip", pa.bool_())])


def op12_sentencepiece(spark, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
