"""Token ids of whole texts with a public tokenizer file, fast enough for many megabytes a second and core.

The tokenizers used here cut a text before every lone space or line break between two other characters, and between a
letter and a full stop or comma; no token reaches over such a cut. The pieces between those cuts repeat a lot, so each
distinct piece is encoded once and the ids of a text are put together from the pieces. New pieces go through the library
by the hundreds, as one text with a lone mark between each two, at whose id the result is cut again. A text that may hold an added token
(such as ``<|endoftext|>``, which becomes its one id, as in the tokenizers library) is encoded whole, as the pieces around
such a token are other ones. ``tests/llm`` compares this with encoding texts as they are.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain, islice

import numpy as np

#: Pieces remembered before the older half is dropped; bounds memory, never changes results.
MAX_PIECES = 500_000
#: Longer pieces are not remembered.
LONG_PIECE = 48
#: Texts are taken together up to this many characters, so that their new pieces are encoded in few calls.
TOGETHER = 1 << 17
#: New pieces in one call of the library, with a lone mark between each two.
IN_A_CALL = 500
_MARK = "^"
_MARKS = re.compile(r"[^\w\s]+")
_CUT = re.compile(r"(?<=[^\s\x1c-\x1f\x85])(?=[ \n][^\s\x1c-\x1f\x85])")


def _cut(text: str) -> list[str]:
    """The pieces of a text; the space before a piece is left out, a line break is not."""
    words = text.split()
    breaks = "\n" in text
    if " ".join(words) == (text.replace("\n", " ") if breaks else text) and words:
        # all white space is lone spaces and line breaks between words: every one is a cut
        return text.replace("\n", " \n").split(" ") if breaks else words
    first, *rest = _CUT.split(text)
    return [first, *(x[1:] if x[0] == " " else x for x in rest)]


def _spaced(piece: str) -> str:
    return piece if piece[:1] == "\n" else " " + piece


class PieceEncoder:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = (x.content for x in self.tokenizer.get_added_tokens_decoder().values())
        # normalisation may change case and white space, but makes no marks out of other characters
        self._marks = {tuple(sorted(set(_MARKS.findall(x)))) or x.casefold() for x in added}
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        mark = self._ids(" " + _MARK)
        # a vocabulary without the mark as one id gets a call for each piece
        self._mark = int(mark[0]) if len(mark) == 1 else None

    def _ids(self, text: str) -> np.ndarray:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(found, dtype="<u4")

    def raw(self, text: str) -> bytes:
        return self._ids(text).tobytes()

    def _may_hold_added(self, text: str) -> bool:
        return any(
            all(x in text for x in marks) if isinstance(marks, tuple) else marks in text.casefold() for marks in self._marks
        )

    def _encode_pieces(self, pieces: list[str]) -> None:
        """Remember the ids of new pieces, many of them in one call of the library."""
        together = []
        for p in pieces:
            # white space at the end would not be cut from the space before the mark
            if self._mark is None or _MARK in p or p[-1].isspace():
                self._known[p] = self.raw(_spaced(p))
            else:
                together.append(p)
        for i in range(0, len(together), IN_A_CALL):
            part = together[i : i + IN_A_CALL]
            ids = self._ids(f" {_MARK}".join(map(_spaced, part)))
            ends = np.flatnonzero(ids == self._mark).tolist()
            if len(ends) != len(part) - 1:
                raise ValueError("the mark between pieces was not kept apart by this tokenizer")
            raw, begin = ids.tobytes(), 0
            for p, end in zip(part, [*ends, len(ids)]):
                self._known[p] = raw[4 * begin : 4 * end]
                begin = end + 1

    def _learn(self, pieces: set[str]) -> None:
        known, older = self._known, self._older
        new, tailed = [], []
        for p in pieces:
            found = older.get(p)
            if found is not None:
                known[p] = found
                continue
            core = p.rstrip(".,") if p[-1] in ".," else p
            if core != p and core and core[-1].isalpha():
                tailed.append((p, core, p[len(core) :]))
            else:
                new.append(p)
        cores = {c for _, c, _ in tailed if c not in known}.difference(new)
        for c in [c for c in cores if c in older]:
            known[c] = older[c]
            cores.discard(c)
        self._encode_pieces([*new, *cores])
        tails = {t: self.raw(t) for t in {t for _, _, t in tailed}}
        for p, core, tail in tailed:
            known[p] = known[core] + tails[tail]

    def _encode_group(self, texts: list[str]) -> Iterator[bytes]:
        cut = [None if self._may_hold_added(x) else _cut(x) for x in texts]
        known = self._known
        new = set(chain.from_iterable(islice(p, 1, None) for p in cut if p)).difference(known)
        self._learn(new)
        for text, pieces in zip(texts, cut):
            if pieces:
                yield self.raw(pieces[0]) + b"".join(map(known.__getitem__, islice(pieces, 1, None)))
            else:
                yield self.raw(text)
        for p in new:
            if len(p) > LONG_PIECE:
                del known[p]
                known.pop(p.rstrip(".,"), None)
        if len(known) >= MAX_PIECES:
            self._older, self._known = known, {}

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text, in order."""
        group: list[str] = []
        held = 0
        for text in texts:
            group.append(text)
            held += len(text)
            if held >= TOGETHER:
                yield from self._encode_group(group)
                group, held = [], 0
        yield from self._encode_group(group)

    def encode(self, text: str) -> bytes:
        [ids] = self._encode_group([text])
        return ids


@cache
def encoder(path: str) -> PieceEncoder:
    """One encoder per file and process, so that what it remembers serves all tasks that run there."""
    return PieceEncoder(path)


def with_end(ids: bytes, end_id: int) -> np.ndarray:
    return np.frombuffer(ids + int(end_id).to_bytes(4, "little"), dtype="<u4")
