"""Encoding through distinct words and decoding through the piece table, against the library."""

import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chatpulse.llm import bpe
from chatpulse.llm.queries import op13_bpe_round_trip
from chatpulse.llm.vocabulary import squeeze, unsqueeze

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
CUTTER = bpe.WordCutter(PATH, bpe.added_tokens(PATH))
SF = "/root/testdata/sf0.001"
TEXTS = [
    "a <|endoftext|> b<|endoftext|>　漢字かな 한국어 ࢠ", None, "", "  \n\n x\u0085y 's 'S can't‍👩‍👩‍👧 é ١٢٣ 𞤀𞤁 Ა", "x\x00y\r\n\t z",
    "the same text", "the same text", " ".join(f"word{i % 977}" for i in range(60_000)), "<|endoftext|>", "   x",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(None if i == 2 else min(i, 8), t, 1, "x", [1]) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, block int, words string, ids array<int>").repartition(3)


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("block_chars", [1, 300_000])
def test_ids_equal_the_library(spark, docs, block_chars):
    found = bpe.encode_texts(docs, PATH, block_chars).collect()
    wanted = [(r["doc_id"], library_ids(r["text"])) for r in docs.collect()]
    assert sorted(((r["doc_id"], list(r["ids"])) for r in found), key=str) == sorted(wanted, key=str)
    assert bpe.encode_texts(docs.where("false"), PATH).count() == 0


def test_decoding_equals_the_library(spark):
    rows = [[50256, 64, 65], [], [200, 101, 60_000, 101], None, list(range(0, 50257, 7)), [188], [64, None, 65]]
    frame = spark.createDataFrame([(i, ids, "own") for i, ids in enumerate(rows)], "n long, ids array<int>, text string")
    for size in (1, 4_000_000):
        found = {r["n"]: r["text"] for r in bpe.decode_ids(frame, PATH, size).collect()}
        for i, ids in enumerate(rows):
            known = [x for x in ids or [] if x is not None and x < 50257]
            assert found[i] == (None if ids is None else LIBRARY.decode(known, skip_special_tokens=False))
    assert bpe.decode_ids(frame.where("false"), PATH).count() == 0


def test_query_over_the_whole_table(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    wanted = set()
    for r in table:
        ids = library_ids(r["text"])
        text = LIBRARY.decode(ids, skip_special_tokens=False)
        wanted.add((r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    found = [tuple(r) for r in op13_bpe_round_trip(spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()]
    assert len(found) == len(table) and set(found) == wanted


def test_each_distinct_word_is_encoded_once(spark, docs):
    blocks = bpe.word_blocks(docs, PATH, 1, "doc_id", "text")
    words = blocks.select("block", F.posexplode("words").alias("place", "word"))
    coded = bpe.encode_words(words, PATH).collect()
    assert sum(len(unsqueeze(r["sizes"])) for r in coded) == words.count() == words.distinct().count()
    again = bpe.encode_words(words, PATH, held_words=1).collect()
    assert sum(int(unsqueeze(r["sizes"]).sum()) for r in again) == sum(len(unsqueeze(r["ids"])) for r in coded)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", " ", "  ", "'s", "'", "\n", "\t", "é", "1", "٣", "漢", "!", "<|endoftext|>", " ", "ǅ", "T", "👩", "-"]), max_size=14))
def test_words_are_encoded_alone_as_in_their_text(parts):
    text = "".join(parts)
    words = CUTTER.words(text)
    assert "".join(words) == text
    assert [i for w in words for i in library_ids(w)] == library_ids(text)


def test_places_and_other_tokenizers():
    import numpy as np

    for numbers in ([], [0], [1, 2**32 - 1, 7], list(range(70_000))):
        assert unsqueeze(squeeze(np.array(numbers, np.uint32))).tolist() == numbers
    with pytest.raises(ValueError):
        bpe.added_tokens(public_tokenizers.path("word_bpe_49k.json"))


def test_a_block_comes_in_rows_of_bounded_size(spark, docs, monkeypatch):
    monkeypatch.setattr(bpe, "PLACED_WORDS", 20_000)
    monkeypatch.setattr(bpe, "ROW_WORDS", 100)
    many = docs.union(docs.select((F.col("doc_id") + 100).alias("doc_id"), F.concat("text", F.lit(" and more")).alias("text"), *docs.columns[2:]))
    rows = bpe.word_blocks(many.coalesce(1), PATH, 10_000_000, "doc_id", "text").collect()
    assert len({r["block"] for r in rows}) == 1 and len(rows) > 3
    assert max(len(r["words"]) for r in rows) == 100 and sum(len(r["doc_ids"]) for r in rows) == many.count()
    assert all(sum(r["lengths"][1:]) <= 20_000 for r in rows)
    found = bpe.encode_texts(many.coalesce(1), PATH).collect()
    wanted = [(r["doc_id"], library_ids(r["text"])) for r in many.collect()]
    assert sorted(((r["doc_id"], list(r["ids"])) for r in found), key=str) == sorted(wanted, key=str)
