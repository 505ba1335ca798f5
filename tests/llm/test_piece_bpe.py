"""SentencePiece BPE against the sentencepiece library and plain merging."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from tallyspark.llm import piece_bpe

LIB = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(piece_bpe.MODEL))


@pytest.fixture(scope="module")
def model():
    return piece_bpe.read_model(public_tokenizers.path(piece_bpe.MODEL))


def same(model, texts):
    for text, (ids, decoded) in zip(texts, piece_bpe.Encoder(model)(texts), strict=True):
        want = LIB.encode(text, add_eos=True)
        assert ids == " ".join(map(str, want)), text[:80]
        assert decoded == LIB.decode(want), text[:80]


def test_random_texts(model):
    rnd = random.Random(5)
    kinds = ["abcdefghij", "aab ", "▁ a", "éß日本語 ", "\n\t\r  ", "😀🏽‍ a", "0123456789.,- ", "the ing tion er ", "\x00\x1f  "]
    same(model, ["".join(rnd.choice(k) for _ in range(rnd.randint(0, 50))) for k in kinds for _ in range(200)])
    pieces = [p.replace("▁", " ") for p in model.text[259:]]
    same(model, ["".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 12))) for _ in range(3000)])


def test_long_words_and_spaces(model):
    rnd = random.Random(6)
    same(model, ["", " ", " " * 999, "a" * 30_000, "ab" * 9000 + " " + "9" * 999,
                 "".join(rnd.choice("etaoinshrdlu") for _ in range(20_000)), " " * 70 + "x" + " " * 33, "日本" * 5000])


def test_table_of_words_starts_anew(model, monkeypatch):
    monkeypatch.setattr(piece_bpe, "MAX_WORDS", 3)
    monkeypatch.setattr(piece_bpe, "LONGEST", 4)
    monkeypatch.setattr(piece_bpe, "FLAT", 7)
    encoder = piece_bpe.Encoder(model)
    for text in ["one two three fourteen", "fourteen one", "two two two fourteen"]:
        want = LIB.encode(text, add_eos=True)
        assert encoder([text]) == [(" ".join(map(str, want)), text)]
        assert len(encoder.kept) <= 3 and all(len(w) <= 4 for w in encoder.kept)


def test_a_merge_that_makes_a_smaller_rank_goes_first():
    """Two equal pairs in one word, the first merge of which makes a pair of a
    smaller rank: ``ab`` is worse than ``abc``, so it may not be merged twice
    at once."""
    class Toy(piece_bpe.Model):
        def __init__(self, order):
            names = sorted({c for p in order for c in p})
            self.names = names + [p for p in order if len(p) > 1]
            number = {p: i for i, p in enumerate(self.names)}
            pairs = {}
            for rank, p in enumerate(order):
                for k in range(1, len(p)):
                    if p[:k] in number and p[k:] in number:
                        pairs[number[p[:k]] << 32 | number[p[k:]]] = (rank, number[p])
            np = piece_bpe.np
            self.pairs = np.array(sorted(pairs), np.int64)
            self.ranks = np.array([pairs[k][0] for k in self.pairs.tolist()], np.int64)
            self.merged = np.array([pairs[k][1] for k in self.pairs.tolist()], np.int64)

    def plain(order, parts):
        rank = {p: i for i, p in enumerate(order)}
        while True:
            found = [(rank[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in rank]
            if not found:
                return parts
            i = min(found)[1]
            parts = parts[:i] + [parts[i] + parts[i + 1]] + parts[i + 2:]

    rnd = random.Random(7)
    np = piece_bpe.np
    for _ in range(300):
        order = list(dict.fromkeys("".join(rnd.choice("abc") for _ in range(rnd.randint(2, 5))) for _ in range(rnd.randint(3, 25))))
        toy = Toy(order)
        words = ["".join(rnd.choice("abc") for _ in range(rnd.randint(1, 14))) for _ in range(6)]
        words = ["".join(c for c in w if c in toy.names) for w in words]
        words = [w for w in words if w]
        if not words or not len(toy.pairs):
            continue
        sym = np.array([toy.names.index(c) for w in words for c in w], np.int64)
        of = np.repeat(np.arange(len(words)), [len(w) for w in words])
        got, owner = piece_bpe.merge_rounds(toy, sym, of)
        for k, w in enumerate(words):
            assert [toy.names[i] for i in got[owner == k]] == plain(order, list(w)), (order, w)


def test_decoding_any_ids(model):
    rnd = random.Random(8)
    for _ in range(5000):
        ids = [rnd.choice([0, 1, 2, 28705, 259, rnd.randint(3, 258), rnd.randint(3, 258), rnd.randint(0, 31999)])
               for _ in range(rnd.randint(0, 8))]
        assert piece_bpe.decode(model, ids) == LIB.decode(ids), ids


def test_documents(spark):
    texts = [None, "", "  two  spaces ", "again", "again", "x" * 50_000, "naïve ﬁ\x0b日本\U0001f600"]
    docs = spark.createDataFrame([(i if i != 3 else None, t, "x", 1) for i, t in enumerate(texts)],
                                 "doc_id long, text string, ids string, n_tokens int")
    rows = {(r.doc_id, r.ids_sha256): r for r in piece_bpe.round_trip(docs).collect()}
    for i, t in enumerate(texts):
        ids = LIB.encode(t or "", add_eos=True)
        sha = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        row = rows[i if i != 3 else None, sha]
        assert row.n_tokens == len(ids) and row.round_trip
        assert row.decoded_sha256 == hashlib.sha256(LIB.decode(ids).encode()).hexdigest()
    encoded = piece_bpe.encode_documents(docs)
    assert {tuple(r.ids) for r in encoded.collect()} == {tuple(LIB.encode(t or "", add_eos=True)) for t in texts}
    assert sorted(r.text for r in piece_bpe.decode_documents(encoded).collect()) == sorted(t or "" for t in texts)
    assert piece_bpe.round_trip(docs.limit(0)).collect() == []


def test_other_models_are_refused(tmp_path):
    def field(number, data):
        return bytes([number << 3 | 2, len(data)]) + data
    unigram = field(1, field(1, b"<unk>") + bytes([3 << 3, 2])) + field(2, bytes([3 << 3, 1])) + field(3, bytes([4 << 3, 0]))
    path = tmp_path / "m.model"
    path.write_bytes(unigram)
    with pytest.raises(ValueError):
        piece_bpe.Model(str(path))
