"""Byte-level BPE of whole texts through a table of distinct words, and back through an id-to-piece join."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatpulse.llm.common import map_arrow, text_or_empty, write_buckets
from chatpulse.llm.tokens import LATIN, PATTERN, TextTokens, byte_alphabet, merge_ranks
from chatpulse.llm.vocabulary import LocalCodes, gather, squeeze, unsqueeze
from chatpulse.session import small_batches

BLOCK = "block long, first int, doc_ids array<long>, text_of array<int>, lengths array<long>, places binary, words array<string>"
#: Words of a block whose places lie in one of its rows and are set in place at a time; distinct words in one of its rows.
PLACED_WORDS, ROW_WORDS = 500_000, 50_000


def added_tokens(path: str) -> list[str]:
    """Strings of the tokenizer's added tokens. ValueError for tokenizers whose words can't be encoded one by one."""
    from tokenizers import Tokenizer

    parts = json.loads(Tokenizer.from_file(path).to_str())
    odd = ("single_word", "lstrip", "rstrip")
    if merge_ranks(parts) is None or any(t[x] for t in parts["added_tokens"] for x in odd):
        raise ValueError("words are encoded one by one for plain byte-level BPE only")
    return [t["content"] for t in parts["added_tokens"]]


class WordCutter:
    """Cuts a text into the words that the tokenizer encodes one by one; joined they are the text.

    Strings of added tokens are words of their own. Latin texts are cut by the pattern, whose
    classes are the same there in every Unicode version; other texts by the library, which is
    loaded when the first of them comes.
    """

    def __init__(self, path: str, added: list[str]):
        import regex

        longest_first = sorted(added, key=len, reverse=True)
        self.added = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if added else None
        self.latin = regex.compile(PATTERN)
        self.path, self.library = path, None

    def _plain(self, text: str) -> list[str]:
        if text.isascii() or LATIN.fullmatch(text):
            return self.latin.findall(text)
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path).pre_tokenizer
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]

    def words(self, text: str) -> list[str]:
        if not self.added or not self.added.search(text):
            return self._plain(text)
        parts = self.added.split(text)
        return [w for i, part in enumerate(parts) for w in ([part] if i % 2 else self._plain(part))]


def word_blocks(docs: DataFrame, tokenizer_path: str, block_chars: int, id_column: str, text_column: str) -> DataFrame:
    """Blocks of a task's texts: their distinct words, the most frequent first, and the places of all words.

    A block holds ``block_chars`` characters or the text that goes beyond; equal texts of a block are kept once. It comes
    in several rows, so that none is large: each has some of the block's texts with their documents, and the words from number ``first`` on.
    """

    added = added_tokens(tokenizer_path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = WordCutter(tokenizer_path, added)
        number = TaskContext.get().partitionId() << 32

        def block() -> Iterator[pa.RecordBatch]:
            nonlocal number
            lengths = np.array([len(p) for p in places])
            cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(lengths) // PLACED_WORDS)) + 1).tolist(), len(places)]
            stretches = []
            counts = np.zeros(len(table), np.int64)
            for a, b in zip(cuts, cuts[1:]):
                stretches.append(np.concatenate(places[a:b]))
                places[a:b] = [None] * (b - a)  # a block's parts are let go as soon as they are packed
                counts += np.bincount(stretches[-1], minlength=len(table))
            order = np.argsort(-counts, kind="stable")
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            words = list(table)
            table.clear()
            by_text = np.argsort(text_of, kind="stable")
            sorted_texts = np.array(text_of)[by_text]
            rows = max(len(stretches), -(-len(order) // ROW_WORDS))
            for i in range(rows):
                a, b = cuts[i : i + 2] if i < len(stretches) else (0, 0)
                own = slice(*np.searchsorted(sorted_texts, (a, b)).tolist())
                packed = squeeze(rank[stretches[i]] if i < len(stretches) else np.empty(0, np.uint32))
                if i < len(stretches):
                    stretches[i] = None
                first = i * ROW_WORDS
                held = [words[k] for k in order[first : first + ROW_WORDS].tolist()]
                row = [number, first, [ids[k] for k in by_text[own].tolist()], sorted_texts[own] - a, lengths[a:b], packed, held]
                types = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.string())]
                names = ["block", "first", "doc_ids", "text_of", "lengths", "places", "words"]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)
            number += 1

        ids, text_of, places, table, seen, size = [], [], [], LocalCodes(), {}, 0
        for batch in batches:
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = value.as_py()
                digest = hashlib.sha256(text.encode("utf-8")).digest()
                if digest not in seen:
                    seen[digest] = len(places)
                    places.append(table.of(cutter.words(text)))
                ids.append(doc)
                text_of.append(seen[digest])
                size += len(text)
                if size >= block_chars:
                    yield from block()
                    ids, text_of, places, table, seen, size = [], [], [], LocalCodes(), {}, 0
        if ids:
            yield from block()

    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text"))
    return map_arrow(narrow, work, BLOCK)


def encode_words(words: DataFrame, tokenizer_path: str, held_words: int = 500_000) -> DataFrame:
    """(word, block, place) -> rows of (block, places, sizes, ids): each distinct word is encoded once.

    Rows are brought together by word and sorted, so that the rows of a word follow each
    other; a word has one row a block, however often a block holds it. What goes back to a block
    is packed, up to ``held_words`` words of a task at a time.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, last, last_ids = TextTokens(tokenizer_path), None, b""
        held: list[tuple[np.ndarray, np.ndarray, list[bytes]]] = []

        def packed() -> pa.RecordBatch:
            blocks, places = (np.concatenate([h[i] for h in held] or [np.empty(0, np.int64)]) for i in (0, 1))
            ids = [x for h in held for x in h[2]]
            order = np.lexsort((places, blocks))
            cuts = np.flatnonzero(np.diff(blocks[order])) + 1
            rows = []
            for own in np.split(order, cuts) if len(order) else []:
                sizes = np.array([len(ids[i]) // 4 for i in own], np.uint32)
                joined = np.frombuffer(b"".join(ids[i] for i in own), "<u4")
                steps = np.diff(places[own], prepend=0).astype(np.uint32)
                rows.append((int(blocks[own[0]]), squeeze(steps), squeeze(sizes), squeeze(joined)))
            held.clear()
            columns = list(zip(*rows)) or [()] * 4
            types = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["block", "places", "sizes", "ids"])

        for batch in batches:
            found = batch.column(0).to_pylist()
            fresh = [w for i, w in enumerate(found) if w != (found[i - 1] if i else last)]
            encoded = dict(zip(fresh, encoder.ids(fresh)))
            if last is not None:
                encoded[last] = last_ids
            if found:
                last, last_ids = found[-1], encoded[found[-1]]
                held.append((batch.column(1).to_numpy(), batch.column(2).to_numpy().astype(np.int64), [encoded[w] for w in found]))
            if sum(len(h[0]) for h in held) >= held_words:
                yield packed()
        yield packed()

    together = words.select("word", "block", "place").repartition("word").sortWithinPartitions("word")
    return map_arrow(together, work, "block long, places binary, sizes binary, ids binary")


def _ids_of_block(block: pa.Table, words: pa.Table) -> pa.Table:
    """The ids of every document of a block, from its places and the ids of its words, some documents at a time."""
    parts = []
    coded = [[unsqueeze(words[n][i].as_py()) for n in ("places", "sizes", "ids")] for i in range(words.num_rows)]
    known = np.concatenate([np.cumsum(c[0], dtype=np.int64) for c in coded] or [np.empty(0, np.int64)])
    sizes = np.concatenate([c[1] for c in coded] or [np.empty(0, np.uint32)]).astype(np.int64)
    pieces = np.concatenate([c[2] for c in coded] or [np.empty(0, np.uint32)]).view(np.int32)
    coded.clear()
    size_of, at = np.zeros(len(known), np.int64), np.zeros(len(known), np.int64)
    size_of[known], at[known] = sizes, np.cumsum(sizes) - sizes
    for i in range(block.num_rows):
        row = {name: block[name][i] for name in ("doc_ids", "text_of", "lengths", "places")}
        places = unsqueeze(row["places"].as_py())
        text_of = row["text_of"].values.to_numpy().astype(np.int64)
        lengths = row["lengths"].values.to_numpy()
        begins = np.cumsum(lengths) - lengths
        group = np.cumsum(lengths[text_of]) // PLACED_WORDS
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(text_of)]
        for a, b in zip(cuts, cuts[1:]):
            own = text_of[a:b]
            found = gather(places, begins[own], lengths[own])
            before = np.concatenate(([0], np.cumsum(size_of[found])))
            offsets = before[np.concatenate(([0], np.cumsum(lengths[own])))].astype(np.int32)
            ids = pa.array(gather(pieces, at[found], size_of[found]), pa.int32())
            parts.append(pa.table({"doc_id": row["doc_ids"].values.slice(a, b - a), "ids": pa.ListArray.from_arrays(pa.array(offsets), ids)}))
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
    return pa.concat_tables([t.cast(schema) for t in parts]) if parts else schema.empty_table()


def encode_texts(
    docs: DataFrame,
    tokenizer_path: str,
    block_chars: int = 32_000_000,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, ids array<int>) of whole texts, as the ``tokenizers`` library gives them without special tokens.

    Tasks cut their texts into words and store, block by block, each distinct word once and the
    places of all words, in buckets by block. The distinct words meet in one table, are encoded once each, and
    their ids return to the blocks, where they are set in place. What moves is one row for each distinct word
    of a block and its ids, packed; the places stay in their buckets. A word that is in every text costs one row a block.

    Null text counts as empty and gives no ids. Null and repeated ids keep their rows; an empty table gives
    none; other columns are ignored. Of any length a text is whole in one block. Tokenizers that
    aren't plain byte-level BPE raise ValueError, since their words can't be encoded one by one.
    """
    cut = word_blocks(docs, tokenizer_path, block_chars, id_column, text_column)
    with small_batches(docs.sparkSession):
        blocks = write_buckets(cut, "bpe_blocks", "block")
    words = blocks.select("block", "first", F.posexplode("words").alias("place", "word"))
    coded = encode_words(words.withColumn("place", F.col("first") + F.col("place")), tokenizer_path)
    places = blocks.select("block", "doc_ids", "text_of", "lengths", "places")
    return (
        places.groupBy("block").cogroup(coded.groupBy("block")).applyInArrow(_ids_of_block, "doc_id long, ids array<int>")
    )


def piece_table(tokenizer_path: str) -> pa.LargeBinaryArray:
    """Bytes of the piece of each id; its size is bounded by the tokenizer file. Ids without a piece are empty."""
    from tokenizers import Tokenizer

    tokenizer, alphabet = Tokenizer.from_file(tokenizer_path), byte_alphabet()
    pieces = []
    for i in range(max(tokenizer.get_vocab(True).values(), default=-1) + 1):
        token = tokenizer.id_to_token(i) or ""
        plain = all(c in alphabet for c in token)
        pieces.append(bytes(alphabet[c] for c in token) if plain else token.encode())
    return pa.array(pieces, pa.large_binary())


def decode_ids(encoded: DataFrame, tokenizer_path: str, slice_ids: int = 500_000) -> DataFrame:
    """``encoded`` with a column ``text``, the ids' pieces one after the other, read as UTF-8.

    The ids of a batch are joined by number with the table of pieces, which every task holds: it is no
    larger than the tokenizer file, so nothing is shuffled. Bytes that are no UTF-8 become U+FFFD
    as the library has it, ids without a piece add nothing, and null ids give a null text.
    """
    pieces = piece_table(tokenizer_path)

    def text_of(ids: pa.ListArray) -> list[str | None]:
        lengths = ids.value_lengths().fill_null(0).to_numpy()
        flat = ids.flatten().to_numpy(zero_copy_only=False)
        known = np.nan_to_num(flat, nan=-1).astype(np.int64)
        wanted = pa.array(known, mask=(known < 0) | (known >= len(pieces)))
        joined = pieces.take(wanted).fill_null(b"")
        ends = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset : joined.offset + len(joined) + 1]
        data = joined.buffers()[2]
        data = data.to_pybytes() if data else b""
        cuts = ends[np.concatenate(([0], np.cumsum(lengths)))].tolist()
        whole = zip(cuts, cuts[1:], ids.is_valid().to_pylist())
        return [data[a:b].decode("utf-8", "replace") if valid else None for a, b, valid in whole]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("ids"))
            lengths = ids.value_lengths().fill_null(0).to_numpy()
            group = np.cumsum(lengths) // slice_ids
            cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(ids)]
            for a, b in zip(cuts, cuts[1:]):
                if b > a:
                    part = batch.slice(a, b - a)
                    texts = pa.array(text_of(ids.slice(a, b - a)), pa.string())
                    yield pa.RecordBatch.from_arrays([*part.columns, texts], names=[*part.schema.names, "text"])

    fields = encoded.drop("text")
    return map_arrow(fields, work, fields.schema.simpleString()[len("struct<") : -1] + ",text:string")
