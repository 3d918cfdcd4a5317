"""Encode whole texts with a public tokenizer, encoding each distinct piece once.

Both vocabularies treat the pieces between certain white-space positions independently of
each other, so the ids of a text are the ids of its pieces in order. A worker keeps the
ids of the pieces it met, up to a bound, and passes unknown ones to the library in bulk.
The string of a special token in a text is that token, as in the library's plain call; texts
are cut there first.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import numpy as np

# A worker keeps the ids of at most twice so many pieces: those met since the last turn
# of the store, and those of the turn before.
KEPT_PIECES = 200_000
KEPT_LENGTH = 64
AT_ONCE = 4096
# Pieces passed to the library as one text, which costs it less than as many short texts.
JOINED = 32

# White space of the tokenizers' patterns: Python's, without the four separators U+001C to U+001F.
_OTHER = r"[\S\x1c-\x1f]"
_SPACE = r"[^\S\x1c-\x1f]"
_WORDS = re.compile(_OTHER + "+")
_SPACED = re.compile(f"{_SPACE}*{_OTHER}+|{_SPACE}+")
_RARE_SPACE = re.compile(r"[^\S \n]|[ \n][ \n]|\0")


def words(text: str) -> list[str]:
    """Pieces where white space is dropped: each run of other characters stands alone."""
    if "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
        return _WORDS.findall(text)
    return text.split()


def spaced(text: str) -> list[str]:
    """Pieces where a token may start with the white space before it.

    A cut is safe where white space follows another character.
    """
    if _RARE_SPACE.search(text):
        return _SPACED.findall(text)
    return text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")


# What stands between joined pieces, by way of cutting: one token of its own in any
# surroundings, which no piece that may be joined can give. A piece with its digit, or
# with white space other than one blank or line break before it, is passed alone, and so
# is one without such a start that the digit might run on into.
BETWEEN = {words: "7", spaced: " 7"}
_JOINABLE = {words: re.compile(r"[^\s\x1c-\x1f7]+"), spaced: re.compile(r"(?:[ \n][^\s\x1c-\x1f7]|[A-Za-z])[^\s\x1c-\x1f7]*")}


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, cut: Callable[[str], list[str]]) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cut = cut
        special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        # The library takes the leftmost, and of several there the longest.
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))) or r"(?!)")
        self.between = BETWEEN[cut]
        self.joinable = _JOINABLE[cut].fullmatch
        (self.mark,) = self.tokenizer.encode(self.between, add_special_tokens=False).ids
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        known = self.known
        split = [self._pieces(t) for t in texts]
        missing = {p for s in split for p in s if p not in known}
        self._learn(missing)
        ids = [b"".join(map(known.__getitem__, s)) for s in split]
        for piece in missing:
            if len(piece) > KEPT_LENGTH:
                del known[piece]
        if len(known) > KEPT_PIECES:
            self.known, self.older = {}, known
        return ids

    def _pieces(self, text: str) -> list[str]:
        if not self.special.search(text):
            return self.cut(text)
        pieces, end = [], 0
        for found in self.special.finditer(text):
            pieces += [p for p in self.cut(text[end : found.start()]) if p]
            pieces.append(found.group())
            end = found.end()
        return pieces + [p for p in self.cut(text[end:]) if p]

    def _learn(self, missing: set[str]) -> None:
        known, older, joinable = self.known, self.older, self.joinable
        alone, together = [], []
        for piece in missing:
            ids = older.get(piece)
            if ids is not None:
                known[piece] = ids
            elif joinable(piece) and not self.special.fullmatch(piece):
                together.append(piece)
            else:
                alone.append(piece)
        self._encode(alone, 1)
        self._encode(together, JOINED)

    def _encode(self, pieces: list[str], joined: int) -> None:
        """Learn the ids of pieces, passed to the library so many at once as one text."""
        known = self.known
        for start in range(0, len(pieces), AT_ONCE):
            some = pieces[start : start + AT_ONCE]
            texts = [self.between.join(some[i : i + joined]) for i in range(0, len(some), joined)]
            lists = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            flat = np.fromiter(chain.from_iterable(lists), dtype="<u4")
            ends = np.cumsum([len(ids) for ids in lists])
            if joined > 1:
                # A piece ends at each mark, which is left out, and with its text.
                marks = np.flatnonzero(flat == self.mark)
                starts = np.sort(np.concatenate([marks + 1, ends - np.array([len(x) for x in lists])]))
                ends = np.sort(np.concatenate([marks, ends]))
            else:
                starts = np.concatenate([[0], ends[:-1]])
            if len(starts) != len(some):
                raise RuntimeError("the tokenizer did not keep joined pieces apart")
            ids = flat.tobytes()
            known.update(zip(some, [ids[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist())]))


CUTS = {"words": words, "spaced": spaced}


@lru_cache(maxsize=2)
def encoder(path: str, split: str) -> Encoder:
    """One encoder per worker process, kept over its tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path, CUTS[split])


def public_path(name: str) -> str:
    """Where a public vocabulary lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
