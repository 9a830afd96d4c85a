"""Token ids of whole texts by a public tokenizer, for use inside Spark tasks."""

from __future__ import annotations

import json
import os
import re
from functools import cached_property, lru_cache

import numpy as np

LONG_SPACE = 100_000
_LONG_SPACE = re.compile(rf"(?<!\s)\s{{{LONG_SPACE}}}")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """Letter → byte of byte-level vocabularies: bytes that print stand for themselves, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes.

    The ids are those of the tokenizers library for the file. A byte-level vocabulary with the usual split of texts runs on
    tiktoken, which gives the same ids in a third of the time (the tests compare them); any other file on tokenizers, and
    so do texts with a run of ``LONG_SPACE`` or more white-space characters, as tiktoken's stack ends at a million or so.
    With ``plain`` the strings of special tokens are text like any other.
    """

    def __init__(self, path: str, plain: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.path, self.plain = path, plain
        allowed = set() if plain else "all"
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        split = spec.get("pre_tokenizer") or {}
        usual = (split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
                 and not spec.get("normalizer") and not spec.get("post_processor"))
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        if usual and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec.get("added_tokens", [])):
            import public_tokenizers
            import tiktoken

            letters = byte_letters()
            ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
            fast = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
            self.one = lambda text: (self._slow(text) if len(text) >= LONG_SPACE and _LONG_SPACE.search(text) else
                                     fast.encode_to_numpy(text, allowed_special=allowed, disallowed_special=()).astype("<u4").tobytes())
        else:
            self.one = self._slow

    @cached_property
    def _model(self):
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(self.path)
        model.encode_special_tokens = self.plain
        return model

    def _slow(self, text: str) -> bytes:
        return np.array(self._model.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        return [self.one(text) for text in texts]


@lru_cache(maxsize=2)
def tokenizer(path: str, plain: bool = False) -> Encoder:
    """One tokenizer per Python worker and vocabulary."""
    return Encoder(path, plain)


def groups(texts: list[str], limit: int = 1 << 21):
    """Consecutive texts of about ``limit`` characters together."""
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= limit:
            yield part
            part, size = [], 0
    if part:
        yield part
