"""Token ids of a public byte-level vocabulary, in Arrow batches.

The ids are those of the ``tokenizers`` file as it is, with ``add_special_tokens=False``: the string of an added
token in a text is that token. Its ranks file, which holds the same vocabulary, gives the same ids in a
quarter of the time; texts with such a string, and those outside the common scripts, where the two
libraries' character classes could part, go through ``tokenizers`` itself.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

VOCABULARY = "byte_bpe_50k"
_COMMON = re.compile("[\x00-ɏḀ-ỿ‐-‧‰-⁞₠-₿]*")


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=8)
def _slow(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=8)
def _fast(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def vocabulary_size(json_path: str | None = None) -> int:
    return _slow(json_path or default_path(f"{VOCABULARY}.json")).get_vocab_size()


def encoder(json_path: str | None = None, ranks_path: str | None = None):
    """A function from a text to its list of ids. Paths are looked up where it is called, on executors too."""
    slow = _slow(json_path or default_path(f"{VOCABULARY}.json"))
    fast = _fast(ranks_path or default_path(f"{VOCABULARY}.tiktoken"))
    added = [t.content for t in slow.get_added_tokens_decoder().values()]

    def ids(text: str) -> list[int]:
        if _COMMON.fullmatch(text) and not any(a in text for a in added):
            return fast.encode_ordinary(text)
        return slow.encode(text, add_special_tokens=False).ids

    return ids
