"""Vocabulary of a word-end BPE tokenizer file, and the split of a text into its pre-tokens.

``read`` takes a file in the JSON form of the tokenizers library whose pipeline is NFC, white space
to blanks, lower case, the split by ``PATTERN``, bytes as characters, and BPE with a word-end suffix.
Other pipelines are refused. The path is read on the driver only.
"""

from __future__ import annotations

import json
import re
import unicodedata
from dataclasses import dataclass

PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# Characters whose treatment the standard library and the tokenizers library share.
_PLAIN_RANGES = [(0, 0x530), (0x1E00, 0x1F00), (0x2000, 0x2070), (0x20A0, 0x20C0), (0x2C60, 0x2C80)]
_PLAIN = [c for a, b in _PLAIN_RANGES for c in range(a, b)]


def _ranges(codes: list[int]) -> str:
    out, start = [], None
    for code, following in zip(codes, [*codes[1:], -1], strict=True):
        start = code if start is None else start
        if following != code + 1:
            out.append(f"{re.escape(chr(start))}-{re.escape(chr(code))}")
            start = None
    return "".join(out)


_LETTERS = _ranges([c for c in _PLAIN if unicodedata.category(chr(c))[0] == "L"])
_NUMBERS = _ranges([c for c in _PLAIN if unicodedata.category(chr(c))[0] == "N"])
_SPACES = _ranges([c for c in _PLAIN if re.match(r"\s", chr(c)) and c not in range(0x1C, 0x20)])
_SPLIT = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{_LETTERS}]+|[{_NUMBERS}]|[^{_SPACES}{_LETTERS}{_NUMBERS}]+")
_UNUSUAL = re.compile("[^" + "".join(f"{re.escape(chr(a))}-{re.escape(chr(b - 1))}" for a, b in _PLAIN_RANGES) + "]")


def byte_characters() -> str:
    """The character that stands for each byte: itself where printable, else one from 256 upwards."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return "".join(chr(b) if b in printable else chr(next(spare)) for b in range(256))


@dataclass(frozen=True)
class Vocabulary:
    """ids: token text to id; merges: pairs of token texts by rank; specials: text to id."""

    ids: dict[str, int]
    merges: list[tuple[str, str]]
    specials: dict[str, int]
    suffix: str

    @property
    def texts(self) -> list[str]:
        out = [""] * (1 + max([*self.ids.values(), *self.specials.values()]))
        for text, number in [*self.ids.items(), *self.specials.items()]:
            out[number] = text
        return out

    def splitter(self) -> Splitter:
        return Splitter(sorted(self.specials, key=len, reverse=True))


def read(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, steps = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
    expected = [x["type"] for x in spec["normalizer"]["normalizers"]] == ["NFC", "Replace", "Lowercase"] \
        and [x["type"] for x in steps] == ["Split", "ByteLevel"] and steps[0]["pattern"] == {"Regex": PATTERN} \
        and model["type"] == "BPE" and model["end_of_word_suffix"] and spec["decoder"] is None \
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "ignore_merges", "byte_fallback"))
    if not expected or any(x["normalized"] or x["single_word"] or x["lstrip"] or x["rstrip"] for x in spec["added_tokens"]):
        raise ValueError(f"{path} is not a word-end BPE tokenizer of the supported form")
    merges = [tuple(x) if isinstance(x, list) else tuple(x.split(" ")) for x in model["merges"]]
    return Vocabulary(model["vocab"], merges, {x["content"]: x["id"] for x in spec["added_tokens"]},
                      model["end_of_word_suffix"])


class Splitter:
    """Text to pre-tokens; special strings come out as they are. Usable on executors (small state)."""

    def __init__(self, specials: list[str]):
        self.specials = frozenset(specials)
        self.heads = tuple(sorted({s[:2] for s in specials}))
        self.parts = re.compile("(" + "|".join(map(re.escape, specials)) + ")") if specials else None

    def words(self, text: str | None) -> list[str]:
        if not text:
            return []
        if self.parts is None or not any(head in text for head in self.heads):
            return self._plain(text)
        out: list[str] = []
        for part in self.parts.split(text):
            out += [part] if part in self.specials else self._plain(part)
        return out

    @staticmethod
    def _plain(text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        if text.isascii() or not _UNUSUAL.search(text):
            return _SPLIT.findall(text)
        return _by_library(text)


def _by_library(text: str) -> list[str]:
    """Scripts beyond the plain ranges: the tokenizers library's own character tables decide."""
    from tokenizers import Regex, normalizers, pre_tokenizers
    text = normalizers.Sequence([normalizers.NFC(), normalizers.Replace(Regex(r"\s+"), " "),
                                 normalizers.Lowercase()]).normalize_str(text)
    split = pre_tokenizers.Split(Regex(PATTERN), "removed", invert=True)
    return [word for word, _ in split.pre_tokenize_str(text)]


def symbols(word: str, table: dict[int, str]) -> str:
    """The word's UTF-8 bytes, a character each."""
    return word.encode().decode("latin-1").translate(table)
