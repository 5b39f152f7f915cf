"""Token ids of whole texts with a public tokenizer file; each worker encodes a word once and remembers it."""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np

# Letters of ASCII and Latin-1, which every Unicode letter class has.
_L = "A-Za-zÀ-ÖØ-öø-ÿ"
_MARKS = r"!-&(-@\[-`{-~"  # ASCII marks and digits, but for the apostrophe, which may begin a contraction
#: Pieces that end only where the pre-tokenizer of each kind also cuts.
_PIECES = {
    "byte": re.compile(rf" ?[{_L}]++(?=[\s!-~]|\Z)| ?[{_MARKS}]++(?=[\s{_L}]|\Z)| ?\S+|\s+(?!\S)|\s+"),
    "word": re.compile(rf"[{_L}]++(?=[\s!-~]|\Z)|[{_MARKS}]++(?=[\s{_L}]|\Z)|\S+"),
}
#: Characters that Python holds to be white space and the tokenizers don't.
_UNSURE = re.compile("[\x1c-\x1f]")
#: A piece of one kind of letters, which the pre-tokenizers leave whole.
_LETTERS = re.compile(rf" ?[{_L}]+").fullmatch
#: Latin-1 texts, which normalizing leaves as they are but for their case.
_LATIN = re.compile("[\x00-\xff]*").fullmatch
#: White space but for the space and the line feed.
_OTHER_SPACE = "\t\v\f\r\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Pieces or units of text in each of the two generations that a worker remembers (100 to 200 bytes each), and the longest of them.
REMEMBERED, LONGEST = 400_000, 64


def tokenizer_file(name: str) -> str:
    """A path as it is, or the place of a public tokenizer file on this machine."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class _Remembered(dict):
    """Ids by text, found by `find` when first asked for; those that weren't asked for in two generations are forgotten."""

    def __init__(self, find: Callable[[str], bytes]):
        super().__init__()
        self.find, self.before = find, {}

    def __missing__(self, text: str) -> bytes:
        ids = self.before.get(text) or self.find(text)
        if len(text) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.before = dict(self)
                self.clear()
            self[text] = ids
        return ids


class _Words(_Remembered):
    """What stands between spaces of a lower-cased Latin-1 text, in which the letters are those that Python says are letters.

    Most such units are a word, or a word and the mark that ends its clause, which is cut off by itself.
    """

    def __init__(self, tokenize: Callable[[str], list], code: str, bytes_as: dict[int, str], other: Callable[[str], bytes]):
        super().__init__(self._found)
        self.tokenize, self.code, self.bytes_as, self.other = tokenize, code, bytes_as, other

    def _found(self, unit: str) -> bytes:
        if unit.isalpha():
            text = unit if unit.isascii() else unit.encode("utf-8").decode("latin-1").translate(self.bytes_as)
            return array(self.code, [t.id for t in self.tokenize(text)]).tobytes()
        if unit[-1] in ".,;:!?" and unit[:-1].isalpha():
            return self[unit[:-1]] + self[unit[-1]]
        return self.other(unit)


class Encoder:
    """Ids as little-endian unsigned 16- or 32-bit bytes; equal to encoding each text whole."""

    def __init__(self, name: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        path = tokenizer_file(name)
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.added = [x["content"] for x in spec.get("added_tokens") or []]
        self.kind = self._kind(spec)
        if self.kind:
            self.bytes_as = dict(enumerate(self._byte_characters()))
            self.model_ids = self.tokenizer.model.tokenize
            self.cut = _PIECES[self.kind].findall
            self.pieces = _Remembered(self._piece)
            self.units = _Remembered(self._unit)
            self.words = _Words(self.model_ids, self.code, self.bytes_as, self._joined)

    @staticmethod
    def _kind(spec: dict) -> str | None:
        pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
        if any(x["normalized"] for x in spec.get("added_tokens") or []):
            return None  # may be met in a text only once that is normalized
        if norm is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
            return "byte"
        steps = [x.get("type") for x in (norm or {}).get("normalizers", [])]
        if steps == ["NFC", "Replace", "Lowercase"] and spec["model"].get("end_of_word_suffix") == "</w>":
            return "word"
        return None

    @staticmethod
    def _byte_characters() -> list[str]:
        """What byte-level vocabularies write for each byte: itself where it prints, else the next character from 256."""
        prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        others = iter(range(0x100, 0x200))
        return [chr(b if b in prints else next(others)) for b in range(256)]

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [array(self.code, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _letters(self, text: str) -> bytes:
        """A piece of letters goes straight to the merges, as the steps before them leave it whole."""
        if self.kind == "word":
            text = text.lower()
        return self._merged(text)

    def _merged(self, text: str) -> bytes:
        """Letters, of the case that the model takes, by the merges alone."""
        if not text.isascii():
            text = text.encode("utf-8").decode("latin-1").translate(self.bytes_as)
        elif text[0] == " ":
            text = self.bytes_as[0x20] + text[1:]
        return array(self.code, [t.id for t in self.model_ids(text)]).tobytes()

    def _piece(self, piece: str) -> bytes:
        return self._letters(piece) if _LETTERS(piece) else self._whole([piece])[0]

    def _joined(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.cut(text)))

    def _unit(self, unit: str) -> bytes:
        """What stands between spaces; in byte vocabularies with the space before it, unless a line begins there."""
        text = unit if self.kind == "word" or unit[:1] == "\n" else f" {unit}"
        return self._letters(text) if _LETTERS(text) else self._joined(text)

    def _encode(self, text: str) -> bytes:
        if self.kind == "word":
            if _LATIN(text):
                return b"".join(map(self.words.__getitem__, text.lower().split()))
            return b"".join(map(self.units.__getitem__, text.split()))
        # A space goes with the word after it and a line feed stands alone, unless more white space is next to either.
        if "  " in text or " \n" in text or "\n " in text or "\n\n\n" in text or text.endswith("\n\n") or any(c in text for c in _OTHER_SPACE):
            return self._joined(text)
        units = text.replace("\n", " \n").split(" ")
        return self._joined(units[0]) + b"".join(map(self.units.__getitem__, units[1:]))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Texts that hold an added token's string, or characters that Python takes otherwise, are encoded as they are."""
        if self.kind is None:
            return self._whole(texts)
        whole = [i for i, t in enumerate(texts) if _UNSURE.search(t) or any(x in t for x in self.added)]
        out = dict(zip(whole, self._whole([texts[i] for i in whole]), strict=True))
        return [out[i] if i in out else self._encode(t) for i, t in enumerate(texts)]


@lru_cache(maxsize=2)
def encoder(name: str) -> Encoder:
    """One encoder for each worker process and file."""
    return Encoder(name)
