"""Cutting texts where no pretoken can span, and remembering what each piece encodes to.

A byte-level BPE pretoken never runs from a non-space character into a space,
so a text may be cut before every space that follows a non-space character.
Each piece encodes alone, and a task encodes a piece it has met before by
looking it up.  The memory is bounded by ``LIMIT`` pieces of at most
``LONGEST`` characters; a piece beyond either bound is simply encoded again.
Where whole texts are encoded, only those beyond ``STRETCH`` characters are cut.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

LIMIT, LONGEST = 300_000, 48
STRETCH = 1 << 18

SPACE_AFTER_SPACE = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S) ")


def cut(text: str) -> list[str]:
    """The pieces of a text.  All but the first lack the space they begin with."""
    return _CUT.split(text) if SPACE_AFTER_SPACE.search(text) else text.split(" ")


def stretches(text: str, size: int = STRETCH) -> Iterator[str]:
    """A text in parts of ``size`` characters or, up to the next place where it may be cut, more."""
    at = 0
    while len(text) - at > size and (found := _CUT.search(text, at + size)):
        yield text[at:found.start()]
        at = found.start()
    yield text[at:] if at else text


class Pieces:
    """``encode`` turns a list of strings into a list of little-endian id bytes."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]]):
        self.encode, self.known = encode, {}

    def texts(self, texts: list[str]) -> list[bytes]:
        """Id bytes of every text."""
        cuts = [cut(t) for t in texts]
        known = self.known
        missing = {p for parts in cuts for p in parts[1:] if p not in known}
        if len(known) + len(missing) > LIMIT and known:
            known.clear()
            missing = {p for parts in cuts for p in parts[1:]}
        missing = list(missing)
        first = [parts[0] for parts in cuts]
        done = self.encode([*first, *[" " + p for p in missing]])
        now = dict(zip(missing, done[len(first):]))
        known.update((p, b) for p, b in now.items() if len(p) <= LONGEST)
        long = {p: b for p, b in now.items() if len(p) > LONGEST}
        if not long:
            get = known.__getitem__
            return [head + b"".join(map(get, parts[1:])) for head, parts in zip(done, cuts)]
        return [head + b"".join([known[p] if p in known else long[p] for p in parts[1:]]) for head, parts in zip(done, cuts)]
