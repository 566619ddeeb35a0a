"""Byte-level BPE ids with the vocabulary files of public tokenizers."""

from __future__ import annotations

import array
import base64
import json
import re

import numpy as np
import tiktoken
from public_tokenizers import PATTERN


def rank_file(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes stand
    for themselves, the others follow from code point 256 in order."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def json_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a tokenizer file whose ids follow the order of its merges."""
    with open(path, encoding="utf-8") as file:
        held = json.load(file)
    letters = _byte_letters()
    vocabulary = held["model"]["vocab"]
    special = {t["content"] for t in held.get("added_tokens", ())}
    made = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in held["model"]["merges"]]
    if made != sorted(made):
        raise ValueError(f"{path}: ids do not follow the order of the merges")
    return {bytes(letters[c] for c in token): i for token, i in vocabulary.items() if token not in special}


def json_added(path: str) -> dict[str, int]:
    """Tokens that a tokenizer file adds to its vocabulary, which texts are first split at."""
    with open(path, encoding="utf-8") as file:
        added = json.load(file).get("added_tokens", ())
    odd = [t["content"] for t in added if any(t.get(k) for k in ("single_word", "lstrip", "rstrip", "normalized"))]
    if odd:
        raise ValueError(f"{path}: added tokens with conditions: {odd}")
    return {t["content"]: t["id"] for t in added}


class Encoder:
    """Ids of whole texts. Strings of ``added`` tokens have ids of their own, wherever they
    stand; the text between them is encoded by the ranks."""

    def __init__(self, ranks: dict[bytes, int], added: dict[str, int] | None = None):
        self.added = added or {}
        self.kind = np.dtype("<u2") if max(*ranks.values(), *self.added.values()) < 65536 else np.dtype("<u4")
        self._code = "H" if self.kind.itemsize == 2 else "I"
        self._bpe = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        # The first one in the text, and of those that begin there the longest.
        longest = sorted(self.added, key=len, reverse=True)
        self._split = re.compile(f"({'|'.join(map(re.escape, longest))})") if longest else None

    def encode(self, text: str) -> bytes:
        """The ids as little-endian integers of ``kind``."""
        if self._split is None or not any(t in text for t in self.added):
            ids = self._bpe.encode_ordinary(text)
        else:
            ids = []
            for part in self._split.split(text):
                ids += [self.added[part]] if part in self.added else self._bpe.encode_ordinary(part)
        return array.array(self._code, ids).tobytes()


#: What a worker has loaded, by path.
_LOADED: dict[tuple[str, str], object] = {}


def _ranks(path: str) -> dict[bytes, int]:
    return json_ranks(path) if path.endswith(".json") else rank_file(path)


def _added(path: str) -> dict[str, int]:
    return json_added(path) if path.endswith(".json") else {}


def encoder(path: str) -> Encoder:
    key = ("encoder", path)
    if key not in _LOADED:
        _LOADED[key] = Encoder(_ranks(path), _added(path))
    return _LOADED[key]


def token_bytes(path: str) -> list[bytes]:
    """Bytes of each id."""
    key = ("bytes", path)
    if key not in _LOADED:
        ranks = _ranks(path) | {t.encode(): i for t, i in _added(path).items()}
        table = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            table[i] = token
        _LOADED[key] = table
    return _LOADED[key]
