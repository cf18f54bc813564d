"""Public tokenizer vocabularies, loaded once per worker process.

The path of a rank file (base64 token and rank a line) is a parameter of every operator; the file is
read where it lies and never copied.
"""

from __future__ import annotations

import base64
import importlib.util
import os
from functools import lru_cache

BYTE_BPE_50K = "byte_bpe_50k.tiktoken"

#: Fixed value: the pattern that splits text before the merges of the byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def default_vocab(name: str = BYTE_BPE_50K) -> str:
    """The vocabulary's place: $TOKENIZERS_DIR, else the installed package, else /opt/tokenizers."""
    folder = os.environ.get("TOKENIZERS_DIR")
    if not folder:
        spec = importlib.util.find_spec("public_tokenizers")
        folder = os.path.dirname(spec.origin) if spec else "/opt/tokenizers"
    return os.path.join(folder, name)


@lru_cache(maxsize=4)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=4)
def token_bytes(path: str) -> list[bytes]:
    """Token bytes by id."""
    table = ranks(path)
    out = [b""] * (max(table.values()) + 1)
    for token, rank in table.items():
        out[rank] = token
    return out


@lru_cache(maxsize=4)
def encoder(path: str):
    """tiktoken's encoder of the vocabulary without special tokens."""
    import tiktoken

    return tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks(path), special_tokens={})


@lru_cache(maxsize=1)
def splitter():
    import regex

    return regex.compile(PATTERN)


@lru_cache(maxsize=1)
def safe_boundary():
    """Matches one character whose start is a pre-token boundary whatever precedes it.

    No pre-token holds white space after a non-space character, and none goes on from a letter to
    another kind of character.
    """
    import regex

    return regex.compile(r"(?<=\S)\s|(?<=\p{L})[^\p{L}]")


def decode(ids, path: str) -> bytes:
    """The raw bytes of the ids, concatenated."""
    table = token_bytes(path)
    return b"".join([table[i] for i in ids])


def safe_parts(text: str, size: int):
    """The text in parts of about `size` characters, cut only where a pre-token boundary is certain."""
    begin = 0
    while len(text) - begin > size:
        cut = safe_boundary().search(text, begin + size)
        if cut is None:
            break
        yield text[begin : cut.start()]
        begin = cut.start()
    yield text[begin:]
