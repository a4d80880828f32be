"""Byte-level BPE ids; encoders are built once in each Python worker.

``path`` names a vocabulary file of the ``tokenizers`` library. Where a ``.tiktoken`` file
of the same vocabulary lies beside it, the faster library encodes, to the same ids; a
special token's string in a text becomes its id in both, and a text that the faster
library gives up on goes to the other.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Callable
from functools import lru_cache

END_OF_TEXT = "<|endoftext|>"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=4)
def encoder(path: str) -> Callable[[str], list[int]]:
    """text -> ids, without ids that the tokenizer would add."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    held: list = []  # most workers never need the slower library, and it is large

    def slow(text: str) -> list[int]:
        if not held:
            from tokenizers import Tokenizer

            held.append(Tokenizer.from_file(path))
        return held[0].encode(text, add_special_tokens=False).ids

    ranks_file = path.removesuffix(".json") + ".tiktoken"
    if not os.path.exists(ranks_file):
        return slow
    import public_tokenizers
    import tiktoken

    with open(ranks_file, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        if END_OF_TEXT in text:
            return slow(text)
        try:
            return fast.encode_ordinary(text)
        except BaseException as error:  # the library's regular expressions can give up on very long runs
            if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            return slow(text)

    return encode
