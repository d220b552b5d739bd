"""Byte-pair vocabularies, loaded once per Python worker from a path."""

from __future__ import annotations

import base64
import functools

#: Default place of the vocabulary; every use takes another path as a parameter.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# Fixed value: the published pre-token pattern that this vocabulary is used with.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@functools.lru_cache(maxsize=2)
def encoding(path: str = VOCABULARY):
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(text: str, path: str = VOCABULARY) -> int:
    return len(encoding(path).encode_ordinary(text))
