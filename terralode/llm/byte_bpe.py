"""Byte-level BPE by a tokenizer file's own text: ids as the tokenizers library gives them, faster where that is safe."""

from __future__ import annotations

import json
import os
import re
import sys
from functools import cached_property

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The pre-token pattern of byte-level BPE files that set use_regex.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Code points on whose class (letter, number, space) all Unicode versions since 6 agree; tests compare every one.
STABLE = "[\x00-ԯ‐-⁤ぁ-ゖ一-龥가-힣]*"

BATCH = 1024


def read_spec(path: str) -> str:
    """The text of a tokenizer file: some MB whatever the data, so that it can travel with the tasks."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def byte_of_char() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies write for the 256 bytes."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in set(kept)]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(moved)}


class ByteBpe:
    """Ids of texts, special strings inside them taken as the library takes them by default."""

    def __init__(self, spec_text: str):
        # A task has one core: more threads of the library only hold more memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        spec = json.loads(spec_text)
        pre = spec.get("pre_tokenizer") or {}
        if spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError("a byte-level BPE file without normalizer and prefix space is needed")
        added = spec.get("added_tokens") or []
        if any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens that take in their surroundings are not supported")
        self.library = Tokenizer.from_str(spec_text)
        self.special = re.compile("|".join(map(re.escape, sorted((t["content"] for t in added), key=len, reverse=True))) or r"(?!)")
        self.stable = re.compile(STABLE)
        self.pattern = regex.compile(PATTERN)
        self.spec_text = spec_text

    @cached_property
    def direct(self):
        """The same vocabulary for tiktoken, if its ids follow its merges; made when ids are first asked for."""
        import tiktoken

        model = json.loads(self.spec_text)["model"]
        back, vocab = byte_of_char(), model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [vocab.get(a + b, -1) for a, b in pairs]
        if model.get("ignore_merges") or model.get("dropout") or any(x >= y for x, y in zip(made, made[1:])) or min(made, default=0) < 256:
            return None
        ranks = {bytes(back[c] for c in token): i for token, i in vocab.items() if all(c in back for c in token)}
        if len(ranks) != len(pairs) + 256:
            return None
        return tiktoken.Encoding("direct", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if self.direct is not None and self.stable.fullmatch(text) and not self.special.search(text):
            return self.direct.encode_to_numpy(text, disallowed_special=())
        return np.asarray(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def pre_tokens(self, text: str) -> list[str]:
        """Pieces of the text whose ids do not depend on their neighbours; special strings are pieces."""
        found, at = [], 0
        for match in self.special.finditer(text):
            found += self._split(text[at : match.start()])
            found.append(match.group())
            at = match.end()
        return found + self._split(text[at:] if at else text)

    def _split(self, text: str) -> list[str]:
        if self.stable.fullmatch(text):
            return self.pattern.findall(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def lengths(self, pieces: list[str]) -> list[int]:
        parts = (pieces[i : i + BATCH] for i in range(0, len(pieces), BATCH))  # an encoding takes far more room than its length
        return [len(e) for part in parts for e in self.library.encode_batch_fast(part, add_special_tokens=False)]
