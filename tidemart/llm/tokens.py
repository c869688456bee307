"""Token ids of whole texts.

The vocabulary lies in two files with the same tokens: one for the library that defines the ids, one as ranks
for a faster encoder. The ranks encode; the other library takes the few texts that the faster
one cannot read, those with very long runs of white space or with the string of a special token, which has an
id of its own. Tests hold the two against each other.
"""

from __future__ import annotations

import base64
import json
import re
from array import array

import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

VOCABULARY = "byte_bpe_50k"
# The split of the byte-level vocabulary with repeats that give nothing back: same pieces, no backtracking.
PIECES = (r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s")


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Path of a vocabulary without its ending; `.json` and `.tiktoken` lie side by side."""
    return public_tokenizers.path(f"{name}.json").removesuffix(".json")


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes, as the defining library gives them without added tokens."""

    def __init__(self, path: str):
        with open(f"{path}.tiktoken", "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self._fast = tiktoken.Encoding("ranks", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
        with open(f"{path}.json", encoding="utf-8") as file:
            special = [re.escape(t["content"]) for t in json.load(file)["added_tokens"]]
        self._special = re.compile("|".join([*special, r"\s{400}"]))
        self._path, self._slow = path, None

    def encode(self, text: str | None) -> bytes:
        """Four bytes per token; nothing for a null or empty text."""
        if not text:
            return b""
        if self._special.search(text):
            return array("I", self.defining().encode(text, add_special_tokens=False).ids).tobytes()
        return self._fast.encode_to_numpy(text, disallowed_special=()).tobytes()

    def defining(self) -> Tokenizer:
        if self._slow is None:
            self._slow = Tokenizer.from_file(f"{self._path}.json")
        return self._slow
