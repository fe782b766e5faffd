"""Round trips and memories under generated inputs."""

import numpy as np
import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from contigforge.llm import bpe, chunks, common, licenses, suffixes, tokenfiles

TEXTS = st.text(st.sampled_from(list(" \n\tabcSTréÀ²1'.,!| ́日🙂\x00\x85ŉİ")) | st.characters(exclude_categories=["Cs"]), max_size=80)
RANKS = bpe.read_ranks(common.tokenizer_path("byte_bpe_50k.tiktoken"))
OWN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXTS, max_size=6))
def test_bpe_is_tiktoken(texts):
    coder = bpe.coder(*bpe.public_coder())
    ids = [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)]
    assert ids == [OWN.encode_ordinary(t) for t in texts]
    assert [coder.decode(x) for x in ids] == [t.encode() for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(TEXTS, max_size=6), st.booleans())
def test_chunks_are_the_library(texts, words):
    path = common.tokenizer_path("word_bpe_49k.json" if words else "byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    got = [np.frombuffer(x, "<u4").tolist() for x in chunks.library(path, words).encode(texts)]
    assert got == [whole.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=50, deadline=None)
@given(st.lists(TEXTS, max_size=6), st.sampled_from([1, 9, 60]))
def test_words_in_blocks_are_the_library(texts, most):
    path, whole = common.tokenizer_path("word_bpe_49k.json"), chunks.BLOCK_BYTES
    texts = [*texts, " ".join(texts), "", "it'S 3.14,\tVoilà×2 “no”\r\n"]
    chunks.BLOCK_BYTES = most
    try:
        got = [np.frombuffer(x, "<u4").tolist() for x in chunks.library(path, True).encode(texts)]
    finally:
        chunks.BLOCK_BYTES = whole
    assert got == [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


def test_words_are_asked_for_once_a_block(monkeypatch):
    """Case, white space and marks beside a word make no other chunk, and what comes again in a block isn't looked up again."""
    asked = []

    class Asked(chunks.Known):
        def __getitem__(self, string):
            asked.append(string)
            return super().__getitem__(string)

    monkeypatch.setattr(chunks, "Known", Asked)
    path, texts = common.tokenizer_path("word_bpe_49k.json"), ["The cat, the Cat.\nTHE\tcat the,"] * 500
    got = chunks.library(path, True, (11, 11)).encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [Tokenizer.from_file(path).encode(texts[0], add_special_tokens=False).ids] * 500
    assert sorted(asked) == [b",", b".", b"cat", b"the"]


def test_pieces_of_numbers_are_remembered():
    """Numbers are many different chunks of few different pieces; each piece is encoded once."""
    made = []
    words = chunks.Words(lambda texts: [], chunks._WORD_LEVEL, lambda p: made.append(p) or p.encode().ljust(4))
    assert words.encode(["3.14 it's 41.3", "1431.4"]) == [b"3   .   1   4   it  's  4   1   .   3   ", b"1   4   3   1   .   4   "]
    assert sorted(made) == ["'s", ".", "1", "3", "4", "it"]


def test_a_full_memory_still_encodes(monkeypatch):
    monkeypatch.setattr(chunks, "REMEMBERED", 3)
    monkeypatch.setattr(chunks, "REMEMBERED_PIECES", 3)
    coder = bpe.ByteBpe(*bpe.public_coder())
    texts = ["many different words in a text, more than three of them"] * 3
    assert [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)] == [OWN.encode_ordinary(t) for t in texts]
    assert max(len(coder.chunks.first), len(coder.chunks.later), len(coder.chunks.pieces)) <= 3


def test_a_worker_keeps_one_thing():
    kept = common.worker_state("a", dict)
    kept["x"] = 1
    assert common.worker_state("a", dict) is kept
    common.worker_state("b", object)
    assert kept == {} and common.worker_state("a", dict) is not kept


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=400))
def test_blocks(values):
    x = np.array(values, np.uint32)
    assert (tokenfiles.Blocks(tokenfiles.encode_blocks(x)).all() == x).all()


@settings(max_examples=100, deadline=None)
@given(st.text("MITGPL-2.0() ORANDWITHorandwith", max_size=40))
def test_expressions_never_fail(text):
    postfix = licenses.to_postfix(text)
    if postfix is not None:
        labels, free = licenses.evaluate(postfix)
        assert labels and 0 <= free <= 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=0, max_size=160), max_size=5))
def test_runs_cover_every_window_once(raws):
    runs = suffixes.Runs(raws)
    seen = sorted((d, f + k) for d, f, n in zip(runs.doc.tolist(), runs.first.tolist(), runs.windows.tolist(), strict=True) for k in range(n))
    assert seen == [(d, p) for d, raw in enumerate(raws) for p in range(len(raw) - suffixes.LENGTH + 1)]
