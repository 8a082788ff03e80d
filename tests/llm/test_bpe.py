import hashlib
import json
import time

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rollcall.llm import bpe
from rollcall.llm.bpe import WordBpe, encode_documents

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
with open(PATH, encoding="utf-8") as _file:
    OWN = WordBpe(_file.read())


def same(text):
    ids, decoded = OWN.encode(text)
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ids, "<u4").tolist() == want, text
    assert decoded == OWN.decode(ids) == LIBRARY.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("text", [
    "", " ", "Hello, world's 42nd don't WE'LL!!", "É un café naïve x y z\x85q", "ΟΔΟΣ ΣΑΣ", "İstanbul ß ẞ", "a<|endoftext|>b <|startoftext|>", "<|endoftext",
    "égalité", "日本語テスト 한국어", "🙂👍🏽 ok", "a" * 300, "x\x00y\x1cz", "﻿bom", "Ǆ ǅ ﬁ", "it's 'tis 'S", "１２३ Ⅷ ½",
])
def test_as_the_library(text):
    same(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_as_the_library_on_any_text(text):
    same(text)


def test_forced_boundaries_cut_and_join():
    pieces = ["the", "thqzxjv", "zzzqqq", "ingestion"]
    cut = [sum((a, b) not in OWN.inside for s in [[*p[:-1], p[-1] + OWN.end]] for a, b in zip(s, s[1:])) for p in pieces]
    assert max(cut) > 0 and cut[0] == 0
    for p in pieces:
        same(p)


def test_documents(spark):
    rows = [(1, "The cat", 5), (2, None, 6), (3, "", 7), (4, "word " * 50_000, 8), (4, "again", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    out = {(r.doc_id, r.text): r for r in encode_documents(docs, PATH, outputs=("n_tokens", "ids_sha256", "decoded_sha256")).collect()}
    assert len(out) == 5
    for (_, text), r in out.items():
        want = LIBRARY.encode(text or "", add_special_tokens=False).ids
        assert r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(LIBRARY.decode(want, skip_special_tokens=False).encode()).hexdigest()
    assert encode_documents(docs.limit(0), PATH).count() == 0


def test_long_words_take_no_square_of_time():
    for word in ("a" * 1_000_000, "abcabd" * 100_000, "=-" * 200_000, "".join(map(chr, range(97, 123))) * 8_000):
        started = time.process_time()
        same(f"so {word} it is")
        assert time.process_time() - started < 60


def test_more_pieces_than_are_kept(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 50)
    texts = [f"word{i} the number {i % 7} of {chr(97 + i % 26) * 60} ends" for i in range(300)]
    found = [x for at in range(0, 300, 20) for x in OWN.all_ids(texts[at : at + 20])]
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]


def test_files_with_a_decoder_are_refused():
    with open(PATH, encoding="utf-8") as file:
        spec = json.load(file)
    with pytest.raises(ValueError, match="without decoder"):
        WordBpe(json.dumps(spec | {"decoder": {"type": "BPEDecoder", "suffix": "</w>"}}))
