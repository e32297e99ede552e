"""Two tokenizers side by side: ids, bytes behind each id, and where their tokens end together."""

from __future__ import annotations

import functools
import json
from typing import NamedTuple

import numpy as np
import regex
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from churnkit.llm.word_tokens import _byte_letters

# How byte-level vocabularies cut a text, and the sign that pieces have for a space.
CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE = "▁"
# Characters of at most two bytes that every library has known for long; texts with others go the libraries' own way.
_PLAIN = regex.compile("[\t\n\r -~\xa1-ɏΑ-Ωα-ωА-я]*")
# No piece of B goes on after a space or a line end but for runs of spaces at its start, so texts can be cut there.
_STRETCHES = r" *[^ \n]+| +|\n"

Ids = np.ndarray


class TokenPair:
    """Vocabulary A (byte-level BPE, a ``tokenizers`` file) and B (a ``sentencepiece`` file with byte pieces).

    A encodes a space and the text, B the text, to which it adds a space itself. Special tokens are neither added nor found.
    """

    def __init__(self, a_path: str, b_path: str):
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte_of = {letter: byte for byte, letter in _byte_letters().items()}
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.a_bytes = [bytes(byte_of[c] for c in n) if all(c in byte_of for c in n) else n.encode() for n in names]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)
        ]
        self.a_kind, self.b_kind = (np.dtype("<u2" if len(x) <= 1 << 16 else "<u4") for x in (names, pieces))
        self.a_lengths, self.b_lengths = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        whole = {}
        for i, spelt in enumerate(self.b_bytes):
            if not self.b.is_control(i) and not self.b.is_unknown(i):
                whole.setdefault(spelt, i) if self.b.is_byte(i) else whole.update({spelt: i})
        # Fast path: the B id with the same bytes as each A id, -1 where there is none.
        self.same = np.array([whole.get(x, -1) for x in self.a_bytes], np.int64)
        self.a_ranked, self.b_ranked = self._a_ranked(a_path), None
        self.b_of_rank = np.zeros(0, self.b_kind)
        self._rank_b(pieces)

    def _a_ranked(self, path: str) -> tiktoken.Encoding | None:
        """A by ranks, five times as fast, if its ids are in the order of its merges, as ranks are, and it cuts texts as written above."""
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        model, before = rules["model"], rules["pre_tokenizer"] or {}
        merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model.get("merges", [])]
        in_order = all(model["vocab"].get(m) == 256 + i for i, m in enumerate(merged))
        cut_so = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        if not (in_order and cut_so) or rules["normalizer"] or model.get("ignore_merges"):
            return None
        ranks = {self.a_bytes[i]: i for i in range(256 + len(merged))}
        return tiktoken.Encoding("a", pat_str=CUT, mergeable_ranks=ranks, special_tokens={})

    def _rank_b(self, pieces: list[str]) -> None:
        """B by ranks, twice as fast: pieces are merged in the order of their scores, which is what ranks say.

        Merging starts from bytes instead of characters. Characters of two bytes are merged first, those without a piece stay the
        two bytes that stand for them.
        """
        normal = [i for i in range(len(pieces)) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))]
        meet = {x + y for i in normal for x, y in zip(pieces[i], pieces[i][1:])}
        if any(y == SPACE != x or "\n" in x + y for x, y in meet) or self.b.encode("\n a\u0301") != [
            i for part in ("", "\n", " a", "\u0301") for i in self._alone(part)
        ]:
            return
        of_byte = {self.b_bytes[i][0]: i for i in range(len(pieces)) if self.b.is_byte(i)}
        single = {self.b_bytes[i]: i for i in normal if len(pieces[i]) == 1}
        first = [(bytes([x]), single.get(bytes([x]), of_byte.get(x))) for x in range(256)]
        first += [(spelt, i) for spelt, i in single.items() if len(spelt) == 2]
        # Runs of spaces share a score; texts with one go the library's way.
        rest = sorted((i for i in normal if len(pieces[i].lstrip(SPACE)) and len(pieces[i]) > 1), key=lambda i: -self.b.get_score(i))
        order = first + [(self.b_bytes[i], i) for i in rest]
        scores = {self.b.get_score(i) for i in rest}
        # A piece must not hold a character that is no piece: its bytes would not be merged first.
        lone = {c for i in rest for c in pieces[i].replace(SPACE, " ") if len(c.encode()) == 2 and c.encode() not in single}
        if lone or any(i is None for _, i in order) or len(dict(order)) < len(order) or len(scores) < len(rest):
            return
        ranks = {spelt: rank for rank, (spelt, _) in enumerate(order)}
        self.b_of_rank = np.array([i for _, i in order], self.b_kind)
        self.b_ranked = tiktoken.Encoding("b", pat_str=_STRETCHES, mergeable_ranks=ranks, special_tokens={})

    def _alone(self, part: str) -> list[int]:
        """Ids of a part as it would be inside a text; of the added space for no part."""
        return self.b.encode("\n" + part)[2:] if part else self.b.encode("\n")[:1]

    def encode(self, text: str) -> tuple[Ids, Ids]:
        """Ids of A and of B; none if the text is empty or either's bytes differ from a space and the text."""
        none = np.zeros(0, self.a_kind), np.zeros(0, self.b_kind)
        if not text:
            return none
        spaced, plain = " " + text, _PLAIN.fullmatch(text)
        if plain and self.b_ranked is not None and "  " not in spaced:
            b = self.b_of_rank[self.b_ranked.encode_to_numpy(spaced)]
        else:
            b = self.b.encode(text)
            if b"".join(map(self.b_bytes.__getitem__, b)) != spaced.encode():
                return none
        if plain and self.a_ranked is not None:
            a = self.a_ranked.encode_to_numpy(spaced)
        else:
            a = self.a.encode(spaced, add_special_tokens=False).ids
            if b"".join(map(self.a_bytes.__getitem__, a)) != spaced.encode():
                return none
        return np.asarray(a, self.a_kind), np.asarray(b, self.b_kind)


@functools.lru_cache(2)
def token_pair(a_path: str, b_path: str) -> TokenPair:
    """One pair per worker and files."""
    return TokenPair(a_path, b_path)


class Alignment(NamedTuple):
    """Tokens of adjacent texts side by side."""

    a: Ids
    b: Ids
    a_ends: np.ndarray  # bytes up to the end of each token, all texts counted
    b_ends: np.ndarray
    text_ends: np.ndarray
    text_of_a: np.ndarray  # the text of each A token
    common: np.ndarray  # where tokens of both end: the ends of groups

    def groups(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each group: its text, and the number of A and of B tokens up to its end."""
        upto = (np.searchsorted(ends, self.common, "right") for ends in (self.a_ends, self.b_ends))
        return np.searchsorted(self.text_ends, self.common), *upto

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each link: its text, A id and B id.

        Between two neighbouring ends of any tokens lies one token of each, and every two that overlap meet in one such stretch.
        """
        ends = np.concatenate([self.a_ends, self.b_ends])
        order = np.argsort(ends, kind="stable")  # merges two runs
        ends, of_a = ends[order], order < len(self.a_ends)
        last = np.flatnonzero(np.append(ends[1:] != ends[:-1], True)) if len(ends) else np.zeros(0, np.int64)
        first = np.append(0, last[:-1] + 1)[: len(last)]
        upto_a = np.cumsum(of_a)[last]
        # Where ends are equal, that of A comes first.
        i = upto_a - of_a[first]
        j = last + 1 - upto_a - ~of_a[last]
        return self.text_of_a[i], self.a[i], self.b[j]


def align(pair: TokenPair, a: list[Ids], b: list[Ids]) -> Alignment:
    """Alignment of texts given by the ids of their tokens; texts without tokens have none of either."""
    none = np.zeros(0, np.int64)
    ids_a, ids_b = (np.concatenate([none, *x]) for x in (a, b))
    a_ends, b_ends = np.cumsum(pair.a_lengths[ids_a]), np.cumsum(pair.b_lengths[ids_b])
    counts = np.array([len(x) for x in a], np.int64)
    text_ends = np.append(0, a_ends)[np.cumsum(counts)]
    texts = np.repeat(np.arange(len(a)), counts)
    return Alignment(ids_a, ids_b, a_ends, b_ends, text_ends, texts, np.intersect1d(a_ends, b_ends, assume_unique=True))


@functools.lru_cache(2)
def _numerals(n: int) -> tuple[np.ndarray, np.ndarray]:
    """ASCII digits of the numbers below n, a row each with room for a sign after them, and their lengths."""
    words = [str(i).encode() for i in range(n)]
    width = len(words[-1]) + 1
    return np.frombuffer(b"".join(w.ljust(width) for w in words), np.uint8).reshape(n, width), np.array([len(w) for w in words])


def groups_as_text(pair: TokenPair, found: Alignment) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3`` of each text, as bytes and their offsets; empty without tokens.

    All tokens of the batch are put in the order of the texts, each with the sign that follows it; the last sign of a text is left out.
    """
    digits, lengths = _numerals(max(len(pair.a_bytes), len(pair.b_bytes)))
    text, upto_a, upto_b = found.groups()
    n_a, n_b = np.diff(upto_a, prepend=0), np.diff(upto_b, prepend=0)
    place_a = np.arange(len(found.a)) + np.repeat(upto_b - n_b, n_a)
    place_b = np.arange(len(found.b)) + np.repeat(upto_a, n_b)
    ids = np.empty(len(found.a) + len(found.b), np.int64)
    ids[place_a], ids[place_b] = found.a, found.b
    signs = np.full(len(ids), ord(","), np.uint8)
    signs[place_a[upto_a - 1]], signs[place_b[upto_b - 1]] = ord("|"), ord(";")
    size = lengths[ids]
    closing = np.append(text[1:] != text[:-1], True)[: len(text)]
    drawn = size + 1
    drawn[place_b[upto_b[closing] - 1]] -= 1
    rows = digits[ids]
    rows[np.arange(len(ids)), size] = signs
    flat = rows[np.arange(digits.shape[1]) < drawn[:, None]]
    ends = np.append(0, np.cumsum(drawn))
    tokens = np.zeros(len(found.text_ends) + 1, np.int64)
    np.add.at(tokens, text + 1, n_a + n_b)
    return flat, ends[np.cumsum(tokens)]
