"""Byte-level BPE vocabulary files: merges, labels, and the split of a text into words.

Every path to a file is a parameter; the files are read on the executors from the
public package that holds them, and never copied.
"""

from __future__ import annotations

import json

import regex

#: The split pattern of byte-level BPE (public, as the tokenizer package states it).
WORDS = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
#: Below this code point the regex module and the library hold the same Unicode classes (tested over all of them).
SURE = 0x0530
_UNSURE = regex.compile(f"[{chr(SURE)}-\U0010ffff]")


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary, and the byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Vocabulary:
    """Merges in order, and the bytes of every token."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letter = byte_letters()
        ids = spec["model"]["vocab"]
        self.labels: dict[int, bytes] = {i: bytes(letter[c] for c in t) for t, i in ids.items()}
        self.merges: list[tuple[int, int, int]] = []
        for pair in spec["model"]["merges"]:
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.append((ids[left], ids[right], ids[left + right]))
        self.bytes_to_id = {b: i for i, b in self.labels.items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.labels |= {i: t.encode() for t, i in self.special.items()}
        self._special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self._path, self._library = path, None

    def endings(self) -> tuple[list[int], list[int], dict[bytes, int]]:
        """Of each token: its bytes, and the longest token that is a proper end of it (-1: none). Of three bytes: the longest token that ends with them."""
        ids = self.bytes_to_id
        n = max(ids.values()) + 1
        size, shorter, reach = [1] * n, [-1] * n, {}
        for t, i in ids.items():
            size[i] = len(t)
            reach[t[-3:]] = max(len(t), reach.get(t[-3:], 0))
            shorter[i] = next((ids[t[k:]] for k in range(1, len(t)) if t[k:] in ids), -1)
        return size, shorter, reach

    def has_special(self, text: str) -> bool:
        return any(s in text for s in self.special)

    def segments(self, text: str) -> list[tuple[str, bool]]:
        """The text cut at special tokens: (piece, whether it is one)."""
        if not self.has_special(text):
            return [(text, False)]
        out, at = [], 0
        for m in self._special.finditer(text):
            out += [(text[at : m.start()], False), (m.group(), True)]
            at = m.end()
        return [x for x in [*out, (text[at:], False)] if x[0]]

    def words(self, text: str) -> list[str]:
        """The words that merges may not cross. Texts of rarer scripts are split by the library itself, whose Unicode tables may be older."""
        if text.isascii() or not _UNSURE.search(text):
            return WORDS.findall(text)
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self._path).pre_tokenizer
        return [text[a:b] for _, (a, b) in self._library.pre_tokenize_str(text)]
