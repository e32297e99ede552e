"""Token ids of white-space separated words by the tokenizers library, remembered per worker.

The vocabulary's rules drop white space and never look across it, so a text's ids are those of its words
in turn. Most words of a corpus repeat; each worker keeps the ids of the words it has met, up to a limit,
and then starts anew.
"""

from __future__ import annotations

import functools
import unicodedata
from array import array

import numpy as np
import regex
from tokenizers import Tokenizer, models

# Fixed value: the split pattern of this family of vocabularies.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SPLIT = regex.compile(SPLIT)
_MARKS = ".,;:!?#$%&*"
# Characters whose case and normal form are the same in every library: printable ASCII and Latin letters.
_PLAIN = regex.compile(r"[\x21-\x7eÀ-įı-ž]+")


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabets write printable bytes as themselves, the others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def _split(word: str) -> list[str]:
    """Pieces of a lower-cased plain word; most are letters, perhaps with a mark or two at the end."""
    core = word.rstrip(_MARKS)
    if core.isalpha():
        return [core, word[len(core) :]] if len(core) < len(word) else [core]
    return _SPLIT.findall(word)


class _Pieces(dict):
    """Maps a piece to its packed ids; words share most of their pieces."""

    def __init__(self, model: models.BPE | None, code: str, limit: int):
        super().__init__()
        self.model, self.code, self.limit = model, code, limit
        self.letters = _byte_letters()

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        spelt = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        packed = array(self.code, [token.id for token in self.model.tokenize(spelt)]).tobytes()
        self[piece] = packed
        return packed


class WordTokens(dict):
    """Maps a word's bytes to its ids, packed as little-endian unsigned integers of ``width`` bytes.

    Strings of special tokens in a text are what the library makes of them: such a text is encoded by it as a whole.
    """

    def __init__(self, path: str, limit: int = 400_000):
        super().__init__()
        self.full = Tokenizer.from_file(path)
        special = [t.content for t in self.full.get_added_tokens_decoder().values()]
        # Whether a token is looked for before or after letters are made small differs by vocabulary.
        self.special = regex.compile("|".join(map(regex.escape, special)).encode(), regex.IGNORECASE) if special else None
        self.limit = limit
        self.kind = np.dtype("<u2" if self.full.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = {2: "H", 4: "I"}[self.kind.itemsize]
        # The short way is taken only for files whose rules are the ones written out above.
        self.model = self.full.model if self._has_known_rules() else None
        self.pieces = _Pieces(self.model, self.code, limit)

    def _has_known_rules(self) -> bool:
        rules = f"{self.full.normalizer!r} {self.full.pre_tokenizer!r}"
        plain = SPLIT.replace("\\", "\\\\")
        return isinstance(self.full.model, models.BPE) and (plain in rules or SPLIT in rules) and "Lowercase" in rules

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        text = word.decode("utf-8", "replace")
        if self.model is not None and ((text.isascii() and text.isprintable()) or _PLAIN.fullmatch(text)):
            packed = b"".join(map(self.pieces.__getitem__, _split(unicodedata.normalize("NFC", text).lower())))
        else:
            packed = array(self.code, self.full.encode(text, add_special_tokens=False).ids).tobytes()
        self[word] = packed
        return packed

    def ids(self, text: bytes) -> bytes:
        """Packed ids of a whole text."""
        if self.special is not None and self.special.search(text):
            return array(self.code, self.full.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.__getitem__, text.split()))


@functools.lru_cache(2)
def word_tokens(path: str) -> WordTokens:
    """One table per worker and file."""
    return WordTokens(path)
