import numpy as np
import pyarrow.parquet as pq
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chatpulse.llm.tokens import TextTokens, in_slices

TRICKY = [
    "", " ", "  ", "\n", " a", "a  b", "a \n b", "a\n\nB", "it's we'll 'tis", "x²½", "a×b ×÷! ÷", "été́ é", "naïve　 x",
    "<|endoftext|>", "a  <|endoftext|> b", "tab\tx\t y", "1a2 b3!!!***", "日本語 テキスト", "ñandú,ñ. \r\nÑu", "  z", "a\x1c b\x1f", "ab" * 40 + " " + "q" * 90,
    "\x85 \xa0x", "a" * 5000,
]


@pytest.fixture(scope="module")
def tokens():
    return TextTokens(public_tokenizers.path("byte_bpe_50k.json"))


def wanted(tokenizer, texts):
    return [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_tricky_texts(tokens):
    assert tokens.quick and tokens.ids(TRICKY) == wanted(tokens.tokenizer, TRICKY)


def test_a_whole_table(tokens):
    for table in ("documents", "pages"):
        column = "text" if table == "documents" else "html"
        texts = pq.read_table(f"/root/testdata/sf0.01/{table}.parquet", columns=[column]).column(0).to_pylist()
        assert tokens.ids(texts) == wanted(tokens.tokenizer, texts)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n.,'s!abZé×÷ñ1²\t<|>"), st.characters(max_codepoint=0x24F), st.characters(codec="utf-8")), max_size=60), max_size=4))
def test_any_text(tokens, texts):
    assert tokens.ids(texts) == wanted(tokens.tokenizer, texts)


def test_other_tokenizers_go_to_the_library():
    words = TextTokens(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["Hello there, World", " two  words"]
    assert words.quick is None and words.ids(texts) == wanted(words.tokenizer, texts)


def test_slices_cover_all():
    assert list(in_slices([])) == []
    assert list(in_slices(["aa", "b", "ccc"], 3)) == [(0, 2), (2, 3)]
