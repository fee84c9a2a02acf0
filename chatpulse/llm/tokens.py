"""Token ids of whole texts as the ``tokenizers`` library gives them."""

from __future__ import annotations

import json
import os
import re

import numpy as np

#: Texts of these characters are cut into words alike by both libraries, whatever their Unicode version.
LATIN = re.compile("[\x00-ɏ]*")
#: How the pre-tokenizer of this kind cuts a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it prints, else one from 256 on."""
    prints = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(rest)}


def merge_ranks(parts: dict) -> dict[bytes, int] | None:
    """Bytes -> id of a byte-level BPE whose ids are in the order of its merges; None for any other tokenizer."""
    model, cutter = parts["model"], parts["pre_tokenizer"] or {}
    plain = cutter.get("type") == "ByteLevel" and not cutter.get("add_prefix_space") and cutter.get("use_regex", True)
    odd = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    if parts["normalizer"] or not plain or model.get("type") != "BPE" or any(model.get(x) for x in odd):
        return None
    vocabulary, alphabet = model["vocab"], byte_alphabet()
    for i, merge in enumerate(model["merges"]):
        joined = "".join(merge if isinstance(merge, list) else merge.split(" "))
        if vocabulary.get(joined) != 256 + i:
            return None
    added = {token["content"] for token in parts["added_tokens"]}
    ranks = {bytes(alphabet[c] for c in token): i for token, i in vocabulary.items() if token not in added}
    return ranks if sorted(ranks.values()) == list(range(256 + len(model["merges"]))) else None


class TextTokens:
    """Ids as little-endian 32-bit bytes, equal to ``Tokenizer.encode(text, add_special_tokens=False)``.

    For a byte-level BPE the ids of Latin texts come from ``tiktoken`` on the merges of the same
    file, in a third of the time. Other texts, those that hold the string of an added
    token, and all texts of other tokenizers go to ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.quick = None
        if ranks := merge_ranks(json.loads(self.tokenizer.to_str())):
            import tiktoken

            self.quick = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _is_plain(self, text: str) -> bool:
        return (text.isascii() or LATIN.fullmatch(text)) and not any(token in text for token in self.added)

    def ids(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        rest = []
        for i, text in enumerate(texts):
            if self.quick and self._is_plain(text):
                out[i] = self.quick.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
            else:
                rest.append(i)
        if rest:
            found = self.tokenizer.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False)
            for i, encoding in zip(rest, found):
                out[i] = np.array(encoding.ids, "<u4").tobytes()
        return out


def in_slices(texts: list[str], characters: int = 2_000_000):
    """Ranges of a batch that hold about so many characters, at least one text each."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= characters:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
