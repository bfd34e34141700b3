"""The vocabulary of a byte-level BPE tokenizer file, and a fast encoder with its ids.

The path of the file is a parameter; nothing is copied or trained. Files hold a vocabulary
whose ids follow the order of the merges.
"""

from __future__ import annotations

import json
from functools import cache
from typing import NamedTuple

import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


class Vocabulary(NamedTuple):
    tokens: dict[bytes, int]
    merges: list[tuple[bytes, bytes]]
    special: dict[str, int]


def byte_of_char() -> dict[str, int]:
    """Byte-level files print a byte as itself if it is visible in Latin-1, else from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


@cache
def vocabulary(path: str = VOCABULARY) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    byte_of = byte_of_char()

    def raw(token: str) -> bytes:
        return bytes(byte_of[char] for char in token)

    merges = [m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"]]
    special = {token["content"]: token["id"] for token in data["added_tokens"]}
    tokens = {raw(t): i for t, i in data["model"]["vocab"].items() if t not in special}
    return Vocabulary(tokens, [(raw(a), raw(b)) for a, b in merges], special)


@cache
def encoder(path: str = VOCABULARY) -> tiktoken.Encoding:
    """Gives the ids of the tokenizers library for the same file, several times as fast."""
    vocab = vocabulary(path)
    return tiktoken.Encoding(
        path,
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=vocab.tokens,
        special_tokens=vocab.special,
    )


@cache
def tokenizer(path: str = VOCABULARY) -> Tokenizer:
    own = Tokenizer.from_file(path)
    own.no_truncation()
    own.no_padding()
    return own


def encode(text: str | None, path: str = VOCABULARY) -> list[int]:
    """The ids; a text whose runs of blanks are too long for the fast encoder goes to the library."""
    if not text:
        return []
    try:
        return encoder(path).encode(text, allowed_special="all")
    except ValueError:
        return tokenizer(path).encode(text, add_special_tokens=False).ids
