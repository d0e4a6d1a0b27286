"""Token ids of a byte-level BPE vocabulary, inside tasks.

The vocabulary is the JSON file of the ``tokenizers`` library. Ids are made by ``tiktoken`` from
that file, which gives the same ids in a sixth of the time; the tests hold the two against each
other. Its pattern engine backs up over each run of white space and gives up on very long ones, so
texts with such a run are encoded by ``tokenizers`` itself. Strings of special tokens inside a text
become those tokens, as there.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
SAFE_RUN = 100_000  # white space in a row that tiktoken takes; it fails from about 1,000,000
_LONG_RUN = re.compile(rf"(?<!\s)\s{{{SAFE_RUN}}}")  # tried at the first character of a run alone


def _byte_of() -> dict[str, int]:
    """The byte that each character of the vocabulary stands for: printable ones for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in set(plain))
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


@lru_cache(maxsize=4)
def encoder(path: str) -> tiktoken.Encoding:
    """The vocabulary of a file, read once by each worker."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    vocab, byte_of = spec["model"]["vocab"], _byte_of()
    merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
    if merged != sorted(merged):
        raise ValueError(f"{path}: ids must follow the order of merges")
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in vocab.items() if token not in special}
    return tiktoken.Encoding("byte-bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


@lru_cache(maxsize=4)
def slow_encoder(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def encode(text: str, path: str) -> np.ndarray:
    if len(text) > SAFE_RUN and _LONG_RUN.search(text):
        return np.array(slow_encoder(path).encode(text, add_special_tokens=False).ids, np.uint32)
    return encoder(path).encode_to_numpy(text, allowed_special="all")
