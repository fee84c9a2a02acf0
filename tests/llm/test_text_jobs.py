"""Counting, packing, fingerprints and archives against brute force."""

import hashlib
import io
import zlib
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from chatpulse.llm import simhash, warc
from chatpulse.llm.common import connected_components, new_folder
from chatpulse.llm.packing import pack_documents
from chatpulse.llm.token_counts import count_tokens, read_cache, tokenizer_digest
from chatpulse.llm.tokens import TextTokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
# Extra columns have names that the operators use themselves.
SCHEMA = "doc_id long, text string, start int, tokens string, content string, fp int, n int"
TEXTS = [(1, "one two three four"), (2, None), (3, ""), (4, " ".join(f"w{i}" for i in range(9000))), (4, "one two three four"),
         (None, "a null id"), (7, "one two three four"), (8, "<|endoftext|> x")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, 0, "x", "y", 1, 2) for i, t in TEXTS], SCHEMA).repartition(2)


def roots_of(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_components(spark):
    random = np.random.default_rng(1)
    links = [tuple(map(int, x)) for x in random.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(400, 440)] + [(500, 500)]
    found = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    nodes = {n for link in links if link[0] != link[1] for n in link}
    assert len(found) == len(nodes) and {r["node"]: r["root"] for r in found} == roots_of(nodes, [x for x in links if x[0] != x[1]])
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def check_packing(pieces, texts, capacity=1024):
    tokens = TextTokens(PATH)
    whole = sorted((np.frombuffer(ids + bytes(4), "<u4").tolist() for ids in tokens.ids([t or "" for _, t in texts])))
    rows = [r.asDict() for r in pieces.collect()]
    fill, parts = {}, {}
    for r in rows:
        assert 0 < r["length"] == len(r["tokens"]) // 4
        fill.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        parts.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], np.frombuffer(bytes(r["tokens"]), "<u4").tolist()))
    padding = 0
    for spans in fill.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= capacity
        padding += 0 if end & (end - 1) == 0 else capacity - end
    rebuilt = []
    for (_, total), spans in parts.items():
        own, at = [], 0
        # Repeated rows of one document give every piece as often.
        for start, ids in sorted(spans, key=lambda s: s[0]):
            if start == at:
                own += ids
                at += len(ids)
        assert len(own) == total
        rebuilt.append(own)
    assert sum(r["length"] for r in rows) == sum(map(len, whole))
    assert {tuple(x) for x in rebuilt} == {tuple(x) for x in whole}
    return padding


def test_packing(spark, docs):
    check_packing(pack_documents(docs, PATH), TEXTS)
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [(r["doc_id"], r["text"]) for r in table.collect()]
    pieces = pack_documents(table, PATH)
    assert check_packing(pieces, texts) < 0.005 * sum(r["length"] for r in pieces.collect())
    assert pack_documents(docs.where("false"), PATH).count() == 0
    with pytest.raises(ValueError):
        pack_documents(docs, PATH, grain=48)


def test_token_counts_through_the_cache(spark, docs):
    cache = new_folder(spark, "cache")
    tokens = TextTokens(PATH).tokenizer
    wanted = sorted((i or -1, len((t or "").encode()), len(tokens.encode(t or "", add_special_tokens=False).ids)) for i, t in TEXTS)
    folder = f"{cache}/{tokenizer_digest(PATH)}"
    for _ in range(2):  # the second time all are hits
        found = sorted((r[0] or -1, r[1], r[2]) for r in count_tokens(docs, PATH, cache).collect())
        assert found == wanted
        assert spark.read.parquet(folder).count() == len({t or "" for _, t in TEXTS})
    more = spark.createDataFrame([(9, "new"), (1, "one two three four")], "doc_id long, text string")
    assert count_tokens(more, PATH, cache).count() == 2 and read_cache(spark, folder).count() == len({t or "" for _, t in TEXTS}) + 1
    assert count_tokens(docs.where("false"), PATH, new_folder(spark, "cache")).count() == 0


def naive_fingerprint(text):
    words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")]
    parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(spark, docs):
    texts = [t for _, t in TEXTS] + ["Ä B\x0bc", "A", "a b", "x\xa0y z w", "to be or not to be or not to be"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["fp"] % 2**64 for r in simhash.fingerprints(rows).collect()}
    assert found == {i: naive_fingerprint(t) for i, t in enumerate(texts)}
    own = rows.where("text is not null").select("text", F.xxhash64("text").alias("h")).collect()
    assert all(r["h"] % 2**64 == xxhash.xxh64_intdigest(r["text"].encode(), 42) for r in own)


def test_masks_cover_all_pairs_of_bits():
    masks = simhash.covering_masks(2)
    assert len(masks) == 7
    for a, b in combinations(range(64), 2):
        assert any(not m >> a & 1 and not m >> b & 1 for m in masks)


@pytest.mark.parametrize("pairwise", [2, 48])
def test_near_links_join_what_brute_force_joins(spark, pairwise):
    random = np.random.default_rng(2)
    values = {0, 1, 3, 2**63, 2**63 | 1}
    for _ in range(6):
        centre = int(random.integers(0, 2**63))
        for _ in range(40):
            value = centre
            for bit in random.integers(0, 64, int(random.integers(0, 5))):
                value ^= 1 << int(bit)
            values.add(value)
    signed = [v - 2**64 if v >> 63 else v for v in values]
    rows = spark.createDataFrame([(v,) for v in signed], "fp long")
    links = [(r["a"], r["b"]) for r in simhash.near_links(rows, 2, pairwise).collect()]
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 2 for a, b in links)
    wanted = [(a, b) for a, b in combinations(signed, 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= 2]
    assert roots_of(signed, links) == roots_of(signed, wanted)


def test_simhash_components(docs):
    found = [(r["doc_id"], r["component_id"]) for r in simhash.simhash_components(docs).collect()]
    copies = [c for i, c in found if i in (1, 7)]
    assert len(found) == len(TEXTS) and copies == [1, 1] and (4, 1) in found and (4, 4) in found
    assert (2, 2) in found and (3, 2) in found
    assert simhash.simhash_components(docs.where("false")).count() == 0
    kept = simhash.keep_one_each(docs)
    assert kept.columns == docs.columns and kept.count() == len({naive_fingerprint(t) for _, t in TEXTS})


BIG = "<p>é</p>" * 300


def test_archives(spark):
    pages = [(1, "http://a/\r\nx", BIG, 1), (5, None, BIG, 1), (5, "u", BIG, 1), (None, "n", BIG, 1), (2, "b", "short", 1), (3, "c", "short", 1), (4, "d", None, 1)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string, keeper int").repartition(3)
    got = sorted((r[0] or -1, *r[1:]) for r in warc.round_trip(frame).select("page_id", "record_type", "refers_to", "payload_bytes", "payload_digest").collect())
    def row(i, kind, to, html):
        data = (html or "").encode()
        return (i, kind, to, len(data), hashlib.sha1(data).hexdigest())
    wanted = [row(-1, "revisit", 5, BIG), row(1, "revisit", 5, BIG), row(2, "response", None, "short"), row(3, "response", None, "short"),
              row(4, "response", None, None), row(5, "response", None, BIG), row(5, "response", None, BIG)]
    assert got == wanted
    assert warc.round_trip(frame.where("false")).count() == 0
    manifest = warc.write_archives(frame, new_folder(spark, "warc"), archive_bytes=100)
    assert manifest.count() == len(pages)
    payloads = [bytes(r["payload"]).decode() for r in warc.read_archives(spark, manifest).where("record_type = 'response'").collect()]
    assert sorted(payloads) == sorted(["", "short", "short", BIG, BIG])


def test_damaged_archives_are_told():
    good = warc.make_record(1, "u", b"x" * 500_000) + warc.make_record(2, "u", b"y")
    assert [r["payload_bytes"] for r in warc.records_of(io.BytesIO(good))] == [500_000, 1]
    assert [r["error"] for r in warc.records_of(io.BytesIO(good[:-3]))][1].startswith("EOFError")
    inside = zlib.decompress(warc.make_record(3, "u", b"abc"), 31).replace(b"abc\r\n", b"abd\r\n")
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    assert [r["error"] for r in warc.records_of(io.BytesIO(squeeze.compress(inside) + squeeze.flush()))] == ["block digest differs"]
    assert list(warc.records_of(io.BytesIO(b""))) == []
