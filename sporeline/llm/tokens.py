"""Sizes of texts in tokens of a public tokenizer.

The vocabulary is read on the driver from ``TOKENIZERS`` (a parameter; the files are
never copied into the repository) and sent to the workers once, under a megabyte.
"""

from __future__ import annotations

import base64
import os

import tiktoken

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Fixed value: the public pre-tokenisation pattern of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def load_ranks(folder: str = TOKENIZERS, name: str = VOCABULARY) -> bytes:
    with open(os.path.join(folder, name), "rb") as f:
        return f.read()


class Tokenizer:
    def __init__(self, ranks: bytes):
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self._encode = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=table, special_tokens={}).encode_ordinary

    def count(self, text: str) -> int:
        """Tokens of a text; 0 for an empty one."""
        return len(self._encode(text)) if text else 0
