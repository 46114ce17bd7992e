"""Byte-level BPE vocabularies: reading a tokenizer file, normalising, cutting a text into words.

Shared by encoding (``bpe``) and counting (``token_count``); how a word becomes tokens is theirs.
"""

from __future__ import annotations

import functools
import json
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import regex

# The characters with the Unicode property White_Space, as a class body.
SPACE = r"\t-\r \x85\xa0  -     　"

SPACES = regex.compile(f"[{SPACE}]+")
PLAIN = regex.compile("[!-~]*").fullmatch  # characters that stand for their own bytes


@functools.cache
def byte_symbols() -> tuple[str, ...]:
    """One printable character for each byte: printable Latin-1 as itself, the others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return tuple(chr(b) if b in plain else chr(next(spare)) for b in range(256))


@dataclass(frozen=True)
class Vocabulary:
    """A tokenizer file: ids by token, merge ranks by pair, and how a raw text is cut into words."""

    ids: dict[str, int]
    tokens: list[str]
    ranks: dict[tuple[str, str], int]
    special: dict[str, int]
    suffix: str
    steps: tuple
    word: regex.Pattern
    between: regex.Pattern | None

    def symbols(self, word: str) -> list[str]:
        """A word's first symbols: a character for each UTF-8 byte, the last with the end-of-word mark."""
        out = list(word) if PLAIN(word) else list(map(byte_symbols().__getitem__, word.encode()))
        if out and self.suffix:
            out[-1] += self.suffix
        return out

    def words(self, text: str | None) -> Iterator[tuple[list[str], int | None]]:
        """Words up to each special string of the raw text, then that string's id (None at the end)."""
        at = 0
        if text and self.between:
            for m in self.between.finditer(text):
                yield self._words(text[at:m.start()]), self.special[m[0]]
                at = m.end()
        yield self._words(text[at:] if text else ""), None

    def _words(self, part: str) -> list[str]:
        for step in self.steps:
            part = step(part)
        return self.word.findall(part)


class Remembered(dict):
    """Values by key, worked out on the first lookup. It holds the last ``most`` to twice as many."""

    def __init__(self, work: Callable, most: int = 250_000):
        super().__init__()
        self.work, self.most, self.old = work, most, {}

    def __missing__(self, key: str):
        value = self.old.get(key)
        if value is None:
            value = self.work(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def _lower(text: str) -> str:
    """Each character by itself: a final sigma isn't special."""
    return "".join(map(str.lower, text)) if "Σ" in text else text.lower()


def _steps(spec: dict | None) -> Iterator:
    kind = (spec or {}).get("type")
    if kind == "Sequence":
        for part in spec["normalizers"]:
            yield from _steps(part)
    elif kind == "Lowercase":
        yield _lower
    elif kind == "NFC":
        yield functools.partial(unicodedata.normalize, kind)
    elif kind == "Replace" and spec["pattern"] == {"Regex": "\\s+"} and spec["content"] == " ":
        return  # no word holds white space, so it doesn't matter how much there is
    elif kind:
        raise ValueError(f"normalizer {kind} isn't supported")


def _pattern(spec: dict) -> regex.Pattern:
    parts = spec["pretokenizers"] if spec["type"] == "Sequence" else [spec]
    split = [p for p in parts if p["type"] == "Split" and p["invert"] and p["behavior"] == "Removed"]
    level = [p for p in parts if p["type"] == "ByteLevel" and not p["use_regex"] and not p["add_prefix_space"]]
    if not len(split) == len(level) == len(parts) - 1 == 1:
        raise ValueError("this pre-tokenizer isn't supported")
    word = regex.compile(split[0]["pattern"]["Regex"].replace(r"\s", SPACE))
    if any(SPACES.search(found) for found in word.findall("a b\t c\n d")):
        raise ValueError("only pre-tokenizers whose words hold no white space are supported")
    return word


def _tokens(spec: dict) -> tuple[dict[str, int], dict[str, int], list[str]]:
    """Ids of the special and of all other tokens, and the tokens by id."""
    special, ids = {a["content"]: a["id"] for a in spec["added_tokens"]}, spec["model"]["vocab"]
    tokens = [""] * (max([*ids.values(), *special.values()]) + 1)
    for token, i in [*ids.items(), *special.items()]:
        tokens[i] = token
    return special, ids, tokens


def read_tokens(path: str) -> list[str]:
    """The tokens by id, without what encoding needs."""
    with open(path, encoding="utf-8") as f:
        return _tokens(json.load(f))[2]


def load(path: str) -> Vocabulary:
    """``path`` is a local file that every machine has, as part of an installed package."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    if model["type"] != "BPE" or model["byte_fallback"] or model["continuing_subword_prefix"]:
        raise ValueError("only byte-level BPE files are supported")
    special, ids, tokens = _tokens(spec)
    longest_first = sorted(special, key=len, reverse=True)
    return Vocabulary(
        ids=ids,
        tokens=tokens,
        ranks={tuple(pair): rank for rank, pair in enumerate(model["merges"])},
        special=special,
        suffix=model["end_of_word_suffix"] or "",
        steps=tuple(_steps(spec["normalizer"])),
        word=_pattern(spec["pre_tokenizer"]),
        between=regex.compile("|".join(map(regex.escape, longest_first))) if special else None,
    )
