"""Exact byte-level BPE ids, by the file's own library or by an engine proven equal at load time.

A fast engine merges any neighbours whose union is in the vocabulary, the library only the pairs of its merge list.
Both agree if ids follow the order of the merges and each token, encoded alone by the library, gives itself: within
the bytes of a token no earlier merge crosses its ends, so whenever a token can form its bytes are in the same state
as when encoded alone, which then is its listed pair. `_proven` checks just that; a file that fails it, or has another
pre-tokenizer, is encoded by the library.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterable

import regex

from tablesift.llm.common import held

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Fixed value: the pre-token pattern of byte-level BPE files with use_regex.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a vocabulary file: itself if printable, else the next one from 256."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in printable}
    hidden = [b for b in range(256) if chr(b) not in letters]
    return letters | {chr(256 + i): b for i, b in enumerate(hidden)}


def _proven(content: dict, library) -> dict[bytes, int] | None:
    """The vocabulary as ranks if the fast engine gives the library's ids, else None."""
    model, split = content["model"], content.get("pre_tokenizer") or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space") and content.get("normalizer") is None
    if not plain or model.get("type") != "BPE" or model.get("ignore_merges") or model.get("dropout"):
        return None
    vocabulary, letters = model["vocab"], _byte_letters()
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    ordered = all(vocabulary.get(a + b) == 256 + i for i, (a, b) in enumerate(pairs)) and len(vocabulary) == 256 + len(pairs)
    if not ordered or any(c not in letters for t in vocabulary for c in t):
        return None
    if any([x.id for x in library.model.tokenize(t)] != [i] for t, i in vocabulary.items()):
        return None
    return {bytes(letters[c] for c in t): i for t, i in vocabulary.items()}


class BpeTokenizer:
    """Ids as the library gives them by default: special strings in a text are their own ids, none are added."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.size = self.library.get_vocab_size(with_added_tokens=True)
        self._cut = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self._split = regex.compile(PRE_TOKEN).findall
        self._fast = None
        with open(path, encoding="utf-8") as f:
            ranks = _proven(json.load(f), self.library)
        if ranks is not None:
            import tiktoken

            self._fast = tiktoken.Encoding("own", pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens={})
            self.library = None  # tens of MB that this worker no longer needs

    @property
    def wide(self) -> str:
        """Type code of the unsigned integers that hold an id."""
        return "H" if self.size <= 1 << 16 else "I"

    def ids(self, text: str) -> list[int]:
        if self._fast is None:
            return self.library.encode(text, add_special_tokens=False).ids
        if self._cut is None or not any(s in text for s in self.special):
            return self._fast.encode_ordinary(text)
        out: list[int] = []
        for part in self._cut.split(text):
            out.extend([self.special[part]] if part in self.special else self._fast.encode_ordinary(part))
        return out

    def packed(self, text: str, end: int | None = None) -> bytes:
        """The ids as bytes of unsigned integers."""
        ids = self.ids(text)
        if end is not None:
            ids.append(end)
        return array(self.wide, ids).tobytes()

    def pieces(self, text: str) -> list[str]:
        """The pre-tokens, each encoded on its own by BPE; a special string is a piece. Of a file that isn't proven, the whole text."""
        if self._fast is None:
            return [text] if text else []
        if self._cut is not None and any(s in text for s in self.special):
            out: list[str] = []
            for part in self._cut.split(text):
                out.extend([part] if part in self.special else self._split(part))
            return out
        return self._split(text)

    def lengths(self, pieces: Iterable[str]) -> list[int]:
        """How many ids each piece has."""
        return [len(self.ids(p)) for p in pieces]


def loaded(path: str) -> BpeTokenizer:
    """One tokenizer for each worker process and file."""
    return held("bpe", f"tokenizer/{path}", lambda: BpeTokenizer(path))
