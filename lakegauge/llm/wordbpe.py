"""BPE by forced-boundary splitting, for vocabularies whose words end in a suffix.

A pair of neighbouring bytes that occurs inside no token of the vocabulary can
never be merged over, so the place between them is a certain cut: white space
always is one, the ends of the tokenizer's words are, and so is every byte pair
inside a word that no token holds. The fragments between the cuts are encoded
independently, each distinct piece of text once per task, and concatenated.
The merges of all new fragments of a batch run side by side on arrays. This
holds for every script: the tokenizer's own normalizer composes letters and makes
them small where they are beyond Latin ones, its special tokens are single marks,
and words, cuts and merges are worked out here.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

from lakegauge.llm.common import LONG_WORD, digest, ragged

_PLAIN = 0x250  # letters below need no composing and, but for a few, have one small letter each
_SPACE, _LETTER, _NUMBER, _SIGN, _SPECIAL, _UNKNOWN = range(6)
_MARK = 0xD800  # stands for the first special token; no text holds a surrogate
_SLOTS = 21  # remembered words: 2^21 slots of 12 bytes; a newer word takes an older one's slot
_BLANKS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# where a block may end: at a blank, or between a sign and a letter, which no word spans and no composing crosses
_CERTAIN = re.compile(f"(?=[{_BLANKS}])|(?<=[.,;:!?。、，；：！？])(?=[A-Za-z\u0400-\u04ff\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3])")
# fixed value: the pattern of the tokenizer's words
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NONE = np.int32(2**31 - 1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes for themselves, the others from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(others)) for b in range(256)]


class WordBpe:
    """Encodes and decodes with a tokenizer file; at most ``known`` pieces and four ids for each are remembered beyond a block."""

    def __init__(self, path: str, known: int = 2_000_000) -> None:
        from tokenizers import Regex, Tokenizer
        from tokenizers.pre_tokenizers import Split

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, split = spec["model"], spec["pre_tokenizer"]["pretokenizers"][0]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or not model["end_of_word_suffix"] or kinds != ["NFC", "Replace", "Lowercase"] or split["behavior"] != "Removed":
            raise ValueError(f"{path} is not a lower-casing word BPE")
        if split["pattern"]["Regex"] != _WORDS or any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError(f"{path} parts words or special tokens in another way")
        self.normal, self.known = Tokenizer.from_file(path).normalizer, known
        self.parted = Split(Regex(_WORDS), "removed", invert=True)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.marks = {t: chr(_MARK + k) for k, t in enumerate(self.special)}
        self._letter_tables()
        vocabulary, end, letters = model["vocab"], model["end_of_word_suffix"], byte_letters()
        self.inner = np.array([vocabulary[c] for c in letters], np.int32)
        self.final = np.array([vocabulary[c + end] for c in letters], np.int32)
        self.tokens = [""] * (1 + max([*vocabulary.values(), *(t["id"] for t in spec["added_tokens"])]))
        for token, number in [*vocabulary.items(), *((t["content"], t["id"]) for t in spec["added_tokens"])]:
            self.tokens[number] = token
        self._forced_cuts(vocabulary, end, {c: b for b, c in enumerate(letters)})
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self._pair_table(np.array([vocabulary[a] << 16 | vocabulary[b] for a, b in pairs], np.uint32), np.array([vocabulary[a + b] for a, b in pairs], np.int32))
        self._forget()

    def _letter_tables(self) -> None:
        """What each letter is to the tokenizer, found out when it is first met, its small letter, and its salt."""
        self.kinds = np.full(0x110000, _UNKNOWN, np.uint8)
        self.kinds[_MARK : _MARK + len(self.special)] = _SPECIAL
        self._ask(np.arange(_PLAIN))
        small = [chr(c).lower() for c in range(_PLAIN)]
        simple = [len(x) == 1 and x < chr(_PLAIN) for x in small]
        self.lower = np.arange(0x110000, dtype=np.uint32)
        self.lower[:_PLAIN] = [ord(x) if ok else c for c, (x, ok) in enumerate(zip(small, simple, strict=True))]
        self.first_kinds, self.first_lower = self.kinds[:256].tobytes(), self.lower[:256].astype(np.uint8).tobytes()
        self.composed = re.compile(f"[^\\x00-{chr(_PLAIN - 1)}]|[{''.join(chr(c) for c, ok in enumerate(simple) if not ok)}]")
        # words are known by a hash; its key is drawn anew by each process, and no text can be made to fit it
        self.secret = os.urandom(16)
        self.salt = np.random.default_rng(list(self.secret)).integers(1, 2**63, 0x110000, np.uint64)
        self.salt[self.kinds == _SPACE] = 0
        self._powers_of(0)

    def _powers_of(self, size: int) -> None:
        """Powers of the hash's base for as many letters, and their inverses."""
        self.powers, self.inverses = (np.cumprod(np.append(np.uint64(1), np.full(size, x, np.uint64))) for x in (_BASE, _INVERSE))

    def _ask(self, codes: np.ndarray) -> np.ndarray:
        """Kinds of letters, by how the tokenizer's pattern parts each from a letter before it and a sign behind it; those that are blanks."""
        of = {(2, 1): _LETTER, (1, 1, 1): _NUMBER, (1, 2): _SIGN, (1, 1): _SPACE}
        for c in codes.tolist():
            self.kinds[c] = of[tuple(len(piece) for piece, _ in self.parted.pre_tokenize_str(f"a{chr(c)}!"))]
        return codes[self.kinds[codes] == _SPACE]

    def _plain(self, part: str) -> str:
        """A part of a text in composed small letters, with one mark for each special token; what ``lower`` can do is left to it."""
        if not any(t in part for t in self.special):
            return self.normal.normalize_str(part) if not part.isascii() and self.composed.search(part) else part
        return "".join(self.marks.get(x) or self.normal.normalize_str(x) for x in self.specials.split(part) if x)

    def _forced_cuts(self, vocabulary: dict[str, int], end: str, byte: dict[str, int]) -> None:
        """``cut[e, a, b]``: no token holds byte a before b, with b at the end of a word if e."""
        self.cut = np.ones((2, 256, 256), bool)
        for token in vocabulary:
            last = token.endswith(end)
            inside = [byte[c] for c in token.removesuffix(end)]
            for k, (a, b) in enumerate(zip(inside, inside[1:], strict=False)):
                self.cut[int(last and k == len(inside) - 2), a, b] = False

    def _pair_table(self, keys: np.ndarray, made: np.ndarray) -> None:
        """A hash table from a pair of ids to its rank; slots without a pair hold 0 and the key of no pair."""
        self.bits = 32 - 19
        self.slot_key, self.slot_rank = np.zeros(1 << 19, np.uint32), np.full(1 << 19, _NONE, np.int32)
        self.made = made
        slots = self._slot(keys)
        for rank, (key, slot) in enumerate(zip(keys.tolist(), slots.tolist(), strict=True)):
            while self.slot_rank[slot] != _NONE:
                slot = slot + 1 & (1 << 19) - 1
            self.slot_key[slot], self.slot_rank[slot] = key, rank

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint32(2654435769)) >> np.uint32(self.bits)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.uint32) << np.uint32(16) | right.astype(np.uint32)
        slot = self._slot(keys)
        rank = self.slot_rank[slot]
        todo = np.flatnonzero((self.slot_key[slot] != keys) & (rank != _NONE))
        while len(todo):
            slot[todo] = slot[todo] + np.uint32(1) & np.uint32((1 << 19) - 1)
            rank[todo] = self.slot_rank[slot[todo]]
            todo = todo[(self.slot_key[slot[todo]] != keys[todo]) & (rank[todo] != _NONE)]
        return rank

    def _merge(self, symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number per fragment; ``starts`` are the fragments' first positions."""
        lengths = np.diff(np.append(starts, len(symbols)))
        number = np.arange(len(starts))
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(symbols):
            rank = self._ranks(symbols, np.append(symbols[1:], 0))
            ends = np.cumsum(lengths)
            rank[ends - 1] = _NONE
            best = np.minimum.reduceat(rank, ends - lengths)
            alive = best != _NONE
            if not alive.all():
                keep = np.repeat(alive, lengths)
                done.append((number[~alive], lengths[~alive], symbols[~keep]))
                symbols, rank, best, lengths, number = symbols[keep], rank[keep], best[alive], lengths[alive], number[alive]
                if not len(symbols):
                    break
                ends = np.cumsum(lengths)
            at = rank == np.repeat(best, lengths)
            if (at[1:] & at[:-1]).any():  # a pair of equal ids in a row: every second place, from the left
                place = np.arange(len(at))
                first = at & ~np.append(False, at[:-1])
                at &= (place - np.maximum.accumulate(np.where(first, place, 0))) % 2 == 0
            symbols[at] = self.made[rank[at]]
            lengths = lengths - np.add.reduceat(at, ends - lengths, dtype=np.int64)
            symbols = symbols[~np.append(False, at[:-1])]
        if not done:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        numbers, lengths, ids = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(numbers)
        return ids[ragged((np.cumsum(lengths) - lengths)[order], lengths[order])], lengths[order]

    def _forget(self) -> None:
        special = list(self.special.values())
        self.pieces = self.ids = 0  # the arrays have room for more
        self.flat, self.begin, self.count = np.zeros(1 << 12, np.int32), np.zeros(1 << 10, np.int64), np.zeros(1 << 10, np.int64)
        self._remember(np.array(special, np.int32), np.ones(len(special), np.int64))
        self.key, self.piece = np.zeros(1 << _SLOTS, np.uint64), np.zeros(1 << _SLOTS, np.int32)

    def _remember(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Numbers of new pieces with these ids."""
        first, at = self.pieces, self.ids
        self.pieces, self.ids = first + len(counts), at + len(ids)
        self.flat, self.begin, self.count = _roomy(self.flat, self.ids), _roomy(self.begin, self.pieces), _roomy(self.count, self.pieces)
        self.flat[at : self.ids] = ids
        self.begin[first : self.pieces] = at + np.cumsum(counts) - counts
        self.count[first : self.pieces] = counts
        return np.arange(first, self.pieces)

    def _units(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of a text's pieces, learned where they are new, and the place where each begins."""
        try:
            raw = text.encode("latin-1")
            codes = letters = np.frombuffer(raw.translate(self.first_lower), np.uint8)
            kind = np.frombuffer(raw.translate(self.first_kinds), np.uint8)
        except UnicodeEncodeError:
            codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
            kind, letters = self.kinds[codes], self.lower[codes]
            if (kind == _UNKNOWN).any():
                self.salt[self._ask(np.unique(codes[kind == _UNKNOWN]))] = 0
                kind = self.kinds[codes]
        blank = kind == _SPACE
        before = np.append(np.uint8(_SPACE), kind[:-1])
        opens = ~blank & ((kind != before) | (kind == _NUMBER) | (kind == _SPECIAL))
        if "'" in text:
            self._shortened(letters, before, opens, blank)
        starts = np.flatnonzero(opens)
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        closes = np.append(opens[1:] | blank[1:], True)
        closes &= ~blank
        lengths = np.flatnonzero(closes) - starts + 1
        if len(letters) >= len(self.powers):
            self._powers_of(2 * len(letters))
        # blanks add nothing; the power a word begins at is divided out
        keys = self.salt[letters]
        keys *= self.powers[: len(letters)]
        keys = np.add.reduceat(keys, starts)
        keys *= self.inverses[starts]
        # the sum of a long word can be led to one value whatever the salt, by patterns of its letters
        for i in np.flatnonzero(lengths > LONG_WORD).tolist():
            keys[i] = digest(letters[starts[i] : starts[i] + lengths[i]].astype(np.uint32).tobytes(), self.secret)
        keys ^= keys >> np.uint64(29)
        keys *= np.uint64(0xBF58476D1CE4E5B9)
        keys |= np.uint64(1)
        slot = keys >> np.uint64(64 - _SLOTS)
        numbers = self.piece[slot].astype(np.int64)
        new = self.key[slot] != keys
        special = kind[starts] == _SPECIAL
        if special.any():
            numbers[special] = codes[starts[special]] - _MARK
            new &= ~special
        new = np.flatnonzero(new)
        if len(new):
            distinct, example, which = np.unique(keys[new], return_index=True, return_inverse=True)
            example = new[example]
            learned = self._learn(letters[ragged(starts[example], lengths[example])], lengths[example])
            numbers[new] = learned[which]
            slot = distinct >> np.uint64(64 - _SLOTS)
            self.key[slot], self.piece[slot] = distinct, learned
            lost = self.key[slot] != distinct  # two new pieces for one slot: whichever was written last keeps it
            self.piece[slot[~lost]] = learned[~lost]
        return numbers, starts

    def _shortened(self, letters: np.ndarray, before: np.ndarray, opens: np.ndarray, blank: np.ndarray) -> None:
        """Ends of words like 's and 'll are words of their own where no sign stands ahead of the apostrophe; sets ``opens`` so."""
        at = np.flatnonzero((letters == ord("'")) & (before != _SIGN))
        if not len(at):
            return
        behind = np.append(letters, [0, 0])
        one, two = behind[at + 1], behind[at + 2]
        size = np.where(np.isin(one, [ord(c) for c in "stmd"]), 2, 0)
        for a, b in ("re", "ve", "ll"):
            size[(one == ord(a)) & (two == ord(b))] = 3
        at, size = at[size > 0], size[size > 0]
        opens[at + 1] = False
        end = (at + size)[at + size < len(letters)]
        opens[end] = ~blank[end]

    def _learn(self, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Numbers of new words, given by their letters one behind the other."""
        data = np.frombuffer(codes.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)
        size = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
        words = np.cumsum(np.add.reduceat(size, np.cumsum(lengths) - lengths))
        closes, opens = np.zeros(len(data), bool), np.zeros(len(data), bool)
        closes[words - 1], opens[np.append(0, words[:-1])] = True, True
        before = np.append(np.uint8(0), data[:-1])
        starts = np.flatnonzero(opens | self.cut[closes.astype(np.int8), before, data])
        ids, counts = self._merge(np.where(closes, self.final[data], self.inner[data]), starts)
        word = np.cumsum(opens)[starts] - 1
        return self._remember(ids, np.bincount(word, counts, len(lengths)).astype(np.int64))

    def encode(self, texts: list[str], block: int = 200_000) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one behind the other, and the number of ids of each."""
        found, per_text = [], np.zeros(len(texts), np.int64)
        parts: list[str] = []
        of: list[int] = []
        size = 0

        def flush() -> None:
            if self.pieces > self.known or self.ids > 4 * self.known:
                self._forget()
            begins = np.cumsum([0, *(len(p) + 1 for p in parts)])
            numbers, starts = self._units("\n".join(parts))
            counts = self.count[numbers]
            found.append(self.flat[ragged(self.begin[numbers], counts)])
            so_far = np.append(0, np.cumsum(counts))[np.searchsorted(starts, begins)]
            np.add.at(per_text, of, np.diff(so_far))

        for k, text in enumerate(texts):
            for part in blocks(text, block):
                part = self._plain(part)
                parts.append(part)
                of.append(k)
                size += len(part)
                if size > block:
                    flush()
                    parts, of, size = [], [], 0
        if parts:
            flush()
        return np.concatenate(found) if found else np.zeros(0, np.int32), per_text

    def decode(self, ids: list[int]) -> str:
        """The tokens joined by blanks, as a tokenizer without a decoder does; ids outside the vocabulary are left out."""
        tokens, size = self.tokens, len(self.tokens)
        return " ".join([tokens[i] for i in ids if 0 <= i < size])


def _roomy(x: np.ndarray, size: int) -> np.ndarray:
    """An array with the same values and room for ``size``."""
    return x if size <= len(x) else np.append(x, np.zeros(max(size - len(x), len(x) // 2), x.dtype))


def blocks(text: str, size: int) -> Iterator[str]:
    """Parts of a text of about ``size`` characters, or up to the next place where a cut is certain."""
    begin = 0
    while len(text) - begin > size:
        cut = _CERTAIN.search(text, begin + size)
        if not cut:
            break
        yield text[begin : cut.start()]
        begin = cut.start()
    yield text[begin:]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordBpe:
    """One encoder per Python worker and vocabulary file."""
    return WordBpe(path)
