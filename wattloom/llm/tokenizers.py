"""Public tokenizer vocabularies, read where they lie."""

from __future__ import annotations

import base64
from functools import lru_cache

import tiktoken

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how this vocabulary cuts text into pre-tokens.
PRE_TOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
IDS, END = 50_257, 50_256


@lru_cache(maxsize=2)
def byte_bpe(path: str = BYTE_BPE) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("byte_bpe", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})
