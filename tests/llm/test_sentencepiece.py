import hashlib
import random

import plain
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewater.llm import queries
from tidewater.llm.sentencepiece_codec import Merger, tokenize

MODEL = sentencepiece.SentencePieceProcessor(model_file=queries.model_path())
MERGER = Merger(MODEL)


def encode(*texts, merger=MERGER):
    normal = [MODEL.normalize(t) if t else "" for t in texts]
    return [x.tolist() for x in merger.encode_all(normal)]


def test_query_equals_the_library(spark, sf_dir, texts):
    rows = queries.op10_sentencepiece(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = MODEL.encode(texts[r.doc_id], add_eos=True)
        assert r.agrees and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == plain.sha(MODEL.decode(ids))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    assert encode(text) == [MODEL.encode(text)]


def test_signs_spaces_and_line_ends():
    rng = random.Random(4)
    parts = [" ", "  ", "\n", "a", "é", "the", "▁", "\t", "\U0001f600", "12", ".", ",", "\x00", "ing", "<s>", "\r\n", "”.", "².", "_x", "(_"]
    for _ in range(2000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 30)))
        assert encode(text) == [MODEL.encode(text)]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abcdefinorst▁é\n.", min_size=1, max_size=40))
def test_heap_and_matrix_agree(text):
    normal = MODEL.normalize(text).replace("▁", " ")
    by_heap = [i for s in MERGER.merged(normal) for i in MERGER._ids_of(s)]
    assert by_heap == MODEL.encode(text)


def test_long_parts_and_many_texts():
    texts = ["x" * 1000, "internationalization" * 40, "", "a b", "é" * 33, "\U0001f600" * 50, "ab" * 16]
    assert encode(*texts) == [MODEL.encode(t) for t in texts]
    assert encode() == [] and encode("", "") == [[], []]


def test_cache_stays_bounded(monkeypatch):
    from tidewater.llm import sentencepiece_codec

    monkeypatch.setattr(sentencepiece_codec, "CACHED_PARTS", 10)
    merger = Merger(MODEL)
    for k in range(3):
        texts = [" ".join(f"word{k}{i}" for i in range(200))]
        assert encode(*texts, merger=merger) == [MODEL.encode(t) for t in texts]
        assert len(merger.known) <= 250


class Tiny:
    """A vocabulary without bytes: unknown characters have one id, and runs of them one piece."""

    pieces = [("<unk>", 0.0), ("▁", -9.0), ("a", -8.0), ("b", -7.0), ("ab", -2.0), ("▁ab", -3.0), ("ba", -2.0)]

    def get_piece_size(self):
        return len(self.pieces)

    def id_to_piece(self, i):
        return self.pieces[i][0]

    def get_score(self, i):
        return self.pieces[i][1]

    def piece_to_id(self, piece):
        return next((i for i, (p, _) in enumerate(self.pieces) if p == piece), 0)

    def unk_id(self):
        return 0

    def is_unknown(self, i):
        return i == 0

    def is_control(self, i):
        return False

    is_unused = is_byte = is_control


def test_ties_and_unknown_runs_without_bytes():
    merger = Merger(Tiny())
    out = [x.tolist() for x in merger.encode_all(["▁aba", "▁abab", "xyz", "axxb", "▁ba"])]
    # "ab" and "ba" score alike, so the one further left is merged first.
    assert out == [[5, 2], [5, 4], [0], [2, 0, 3], [1, 6]]


def test_blocks_hold_all_texts(monkeypatch):
    import pyarrow as pa

    from tidewater.llm import sentencepiece_codec

    monkeypatch.setattr(sentencepiece_codec, "TEXTS", 3)
    monkeypatch.setattr(sentencepiece_codec, "BLOCK_BYTES", 10)
    texts = ["a", "", "bb", "c" * 50, "d" * 9, "e", "ff", "g", "h", "i", "j"]
    blocks = [b.to_pylist() for b in sentencepiece_codec._blocks(pa.array(texts))]
    assert [t for b in blocks for t in b] == texts
    assert [len(b) for b in blocks] == [3, 1, 2, 3, 2]
    assert list(sentencepiece_codec._blocks(pa.array([], pa.string()))) == []


def test_odd_rows(odd, nothing):
    clashing = odd.withColumns({c: F.lit("x") for c in ("ids", "_coded", "agrees")})
    rows = tokenize(clashing, queries.model_path()).collect()
    assert len(rows) == odd.count() and all(r.agrees for r in rows)
    for r in rows:
        assert r["ids"] == MODEL.encode(r.text or "", add_eos=True)
        assert r.decoded == MODEL.decode(r["ids"]) and r._coded == "x"
    assert tokenize(nothing, queries.model_path()).count() == 0


def test_other_vocabularies_are_refused():
    class Unused(Tiny):
        def is_unused(self, i):
            return True

    with pytest.raises(ValueError):
        Merger(Unused())
