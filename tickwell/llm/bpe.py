"""Byte-level BPE by dynamic programming over prefixes.

A tokenisation is the one BPE gives exactly if every token alone encodes to itself and
every two neighbours, put together, encode to just these two. So the last token of each
prefix is the only vocabulary entry that ends there and agrees with the last token of the
prefix before it. The table of last tokens holds the token count at every prefix.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from functools import lru_cache

import ahocorasick
import numpy as np
import tiktoken

#: White space as Unicode lists it; ``re`` itself counts four control characters more.
SPACE = "\t-\r \x85\xa0  -     　"

#: Pieces in each of the two generations of a worker's cache; results do not depend on it.
CACHED_PIECES = 250_000


class Cache(dict):
    """Results by piece. When full, it becomes the old generation; what is asked for again
    comes back from there, the rest goes with the next change of generations."""

    def __init__(self, make, size: int = CACHED_PIECES):
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, piece):
        found = self.old.get(piece)
        if found is None:
            found = self.make(piece)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[piece] = found
        return found


def _category(first: str, highest: int) -> str:
    """The code points of a general category as ranges for a character class."""
    ranges, start, before = [], None, None
    for c in range(highest + 2):
        if c <= highest and unicodedata.category(chr(c))[0] == first:
            if start is None:
                start = c
            before = c
        elif start is not None:
            ranges.append((start, before))
            start = None
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


@lru_cache(2)
def piece_pattern(highest: int = sys.maxunicode) -> re.Pattern:
    letters, numbers = _category("L", highest), _category("N", highest)
    return re.compile(
        f"'(?:s|t|re|ve|m|ll|d)| ?[{letters}]+| ?[{numbers}]+| ?[^{SPACE}{letters}{numbers}]+"
        f"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


def pieces_of(text: str) -> list[str]:
    """The pieces that merges stay within. Character classes are several times faster
    where they name no code point beyond the first plane, so most texts take those."""
    highest = 0xFFFF if not text or max(text) <= "\uffff" else sys.maxunicode
    return piece_pattern(highest).findall(text)


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins that the vocabulary file writes for bytes."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class PrefixBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = _byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        vocab = spec["model"]["vocab"]
        self.ids = {raw(t): i for t, i in vocab.items() if t not in special}
        self.tokens = {i: t for t, i in self.ids.items()}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        #: rank and result of each merge; parts and rank of each token that a merge makes first
        self.ranks, self._parts_of, self._rank = {}, {}, {}
        for k, (a, b) in enumerate(pairs):
            whole = vocab[a + b]
            self.ranks[vocab[a], vocab[b]] = (k, whole)
            self._parts_of.setdefault(whole, (vocab[a], vocab[b]))
            self._rank.setdefault(whole, k)
        self.special = special
        ranked = [whole for _, whole in self.ranks.values()]
        if ranked != sorted(ranked):
            raise ValueError("ids do not follow the order of merges")
        self.library = tiktoken.Encoding("pieces", pat_str=r"[\s\S]+", mergeable_ranks=self.ids, special_tokens={})
        self._agree: dict[tuple[int, int], bool] = {}
        #: Entries that no sequence of merges makes stand in no tokenisation.
        self._made = {t for t, i in self.ids.items() if self._merge(t) == [i]}
        self._entries = ahocorasick.Automaton()
        for token in self._made:
            self._entries.add_word(token.decode("latin-1"), (self.ids[token], len(token)))
        self._entries.make_automaton()
        self.counts, self.encoded = Cache(self._counts_of), Cache(self._encoded_of)
        self._cut = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))) or "(?!)")

    def _merge(self, text: bytes) -> list[int]:
        """Plain BPE of a few bytes."""
        ids = [self.ids[text[k:k + 1]] for k in range(len(text))]
        while len(ids) > 1:
            found = [(self.ranks[p][0], k) for k, p in enumerate(zip(ids, ids[1:])) if p in self.ranks]
            if not found:
                break
            _, k = min(found)
            ids[k:k + 2] = [self.ranks[ids[k], ids[k + 1]][1]]
        return ids

    def _agrees(self, a: int, b: int) -> bool:
        """Whether BPE leaves the border between two tokens.

        Take both apart from the last merge back. The border falls if the parts that
        touch it have a merge that comes before the merge that was undone last: on the
        right side also one of equal rank, as the leftmost of equal merges goes first.
        """
        known = self._agree.get((a, b))
        if known is None:
            if len(self._agree) > 1_000_000:
                self._agree.clear()
            known, left, right, bound = True, a, b, len(self.ranks)
            while True:
                found = self.ranks.get((left, right))
                if found is not None and found[0] < bound:
                    known = False
                    break
                l_rank, r_rank = self._rank.get(left, -1), self._rank.get(right, -1)
                if l_rank < 0 and r_rank < 0:
                    break
                if l_rank > r_rank:
                    bound, left = l_rank, self._parts_of[left][1]
                else:
                    bound, right = r_rank + 1, self._parts_of[right][0]
            self._agree[a, b] = known
        return known

    def last_tokens(self, piece: bytes) -> tuple[list[int], list[int]]:
        """Last token and token count of every prefix of a piece, by its bytes."""
        agree, last, count = self._agree, [-1] * (len(piece) + 1), [0] * (len(piece) + 1)
        # the entries that end at each byte, of which exactly one agrees with what is before it
        for at, (token, length) in self._entries.iter(piece.decode("latin-1")):
            end, start = at + 1, at + 1 - length
            if last[end] < 0:
                known = True if start == 0 else agree.get((last[start], token))
                if known is None:
                    known = self._agrees(last[start], token)
                if known:
                    last[end], count[end] = token, count[start] + 1
        return last, count

    def _counts_of(self, piece: str) -> np.ndarray:
        """Token count after each code point of a piece."""
        raw = piece.encode()
        _, count = self.last_tokens(raw)
        if len(raw) == len(piece):
            return np.array(count[1:], np.int32)
        return np.array([count[k] for k in range(1, len(raw) + 1) if k == len(raw) or raw[k] & 0xC0 != 0x80], np.int32)

    def _encoded_of(self, piece: str) -> bytes:
        """The ids of a piece as little-endian 32-bit numbers."""
        return np.array(self.library.encode_ordinary(piece), "<u4").tobytes()

    def _parts(self, text: str):
        """The text between special strings, and those: (part, id or None)."""
        at = 0
        for m in self._cut.finditer(text):
            yield text[at:m.start()], None
            yield m.group(), self.special[m.group()]
            at = m.end()
        yield text[at:], None

    def encode(self, text: str) -> bytes:
        """All ids of a text, as the tokenizers library gives them by default."""
        encoded = self.encoded.__getitem__
        return b"".join(
            b"".join(map(encoded, pieces_of(part))) if special is None else special.to_bytes(4, "little")
            for part, special in self._parts(text))

    def _plain_prefixes(self, text: str) -> np.ndarray:
        """Token count of every prefix of a text without special strings: the counts inside each
        piece after those of all pieces before it."""
        pieces = pieces_of(text)
        if not pieces:
            return np.empty(0, np.int64)
        inside = list(map(self.counts.__getitem__, pieces))
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(lengths)
        counts = np.concatenate(inside)
        before = np.zeros(len(pieces), np.int32)
        np.cumsum(counts[ends[:-1] - 1], out=before[1:])
        counts += np.repeat(before, lengths)
        run, run_from = "", 0
        for k in self._unlike(text, pieces):
            piece, at = pieces[k], int(ends[k] - lengths[k])
            if piece[0] == "'":
                # a cut contraction is an apostrophe and a letter
                first = int(self.counts["'"][-1])
                counts[at:at + 2] = [before[k] + first, before[k] + first + int(self.counts[piece[1]][-1])]
                continue
            # a prefix that ends in a run of white space has all of the run in one piece
            j, run = k - 1, ""
            while j >= 0 and pieces[j].isspace():
                run, run_from, j = pieces[j] + run, before[j], j - 1
            spaces = len(piece) - len(piece.lstrip(_SPACES))
            counts[at:at + spaces] = self.counts[run + piece[:spaces]][-spaces:] + run_from
        return counts

    @staticmethod
    def _unlike(text: str, pieces: list[str]) -> list[int]:
        """The pieces whose prefixes fall apart in another way than within the piece: those that go on a run
        of white space, and contractions of two letters. Most texts have few of them."""
        found = []
        if _TWO_SPACES.search(text):
            found += [k + 1 for k, p in enumerate(pieces[:-1]) if p[-1] in _SPACE_SET and pieces[k + 1][0] in _SPACE_SET]
        if "'" in text:
            found += [k for k, p in enumerate(pieces) if p[0] == "'" and p[1:] in ("re", "ve", "ll")]
        return found

    def prefix_counts(self, text: str) -> np.ndarray:
        """Token count of every prefix of a text, after each code point."""
        rows, before, waiting = [], 0, ""
        for part, special in self._parts(text):
            if special is None:
                waiting = part
                own = self._plain_prefixes(part)
                rows.append(own + before)
                start, before = before, before + (int(own[-1]) if len(own) else 0)
            else:
                # inside a special string that is not yet whole, it is ordinary text
                inside = self._plain_prefixes(waiting + part[:-1])[len(waiting):] + start
                before += 1
                rows += [inside, np.array([before])]
        return np.concatenate(rows).astype(np.int32) if rows else np.empty(0, np.int32)


_SPACES = "".join(chr(c) for c in (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
                                   0x202F, 0x205F, 0x3000))
_SPACE_SET = frozenset(_SPACES)
_TWO_SPACES = re.compile(f"[{SPACE}]{{2}}")


@lru_cache(4)
def load(path: str) -> PrefixBpe:
    """One table for each worker process."""
    return PrefixBpe(path)
