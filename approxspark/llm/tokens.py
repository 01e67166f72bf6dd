"""Token ids of whole texts with a public tokenizer, many times faster than encoding each text anew.

Both tokenizers split a text into pre-tokens that never reach across a single space or line feed
between two other characters, so a text's ids are the ids of its space-separated pieces in a row.
A piece's ids are kept in a bounded table of the Python worker; unknown pieces are encoded by the
``tokenizers`` library, many in one string. A text whose white space does not allow such a cut is
encoded whole by the library. Either way the ids equal ``Tokenizer.encode(text, add_special_tokens=False)``.
"""

from __future__ import annotations

import itertools
import os
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Pieces that a worker remembers, at about 200 bytes each; beyond that the half that came last is forgotten, as frequent
#: pieces come early (a bound on memory, not on results).
TABLE = 900_000
#: Characters of texts whose unknown pieces are encoded together.
BATCH = 200_000
#: Pieces encoded in one string.
TOGETHER = 512

#: A word, perhaps on a new line, and ASCII marks after it (an apostrophe may bind to letters).
ENDING = re.compile(r"(\n?[^\W\d_]+)([!-&(-/:-@\[-`{-~]+)")
MARKS = frozenset(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")

_coders: dict[str, "Coder"] = {}


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Coder:
    """``ids(text)``: the ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.t = Tokenizer.from_file(path)
        self.table: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}
        # does white space make ids (byte-level), or is it dropped?
        self.spaces = bool(self.t.encode("a b", add_special_tokens=False).ids != self.t.encode("a\nb", add_special_tokens=False).ids)
        vocab = self.t.get_vocab()
        edge = np.zeros(max(vocab.values()) + 1, bool)
        if self.spaces:  # a piece begins with the byte-level alphabet's space or line feed
            edge[[i for s, i in vocab.items() if s[0] in "ĠĊ"]] = True
        else:  # a word ends with the mark
            edge[[i for s, i in vocab.items() if s.endswith("</w>")]] = True
        self.edge = edge

    def whole(self, text: str) -> bytes:
        return np.array(self.t.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def ids(self, text: str) -> bytes:
        return next(self.batch([text]))

    def pieces(self, text: str) -> tuple[str, list[str]] | None:
        """What comes before the first space, and the pieces; None if the text has to be encoded whole."""
        if "<|" in text:  # may hold a special token's name, which binds to what is around it
            return None
        if not self.spaces:
            return "", text.replace("\n", " ").split(" ")
        head, *pieces = text.replace("\n", " \n").split(" ")
        return None if not head or head[-1].isspace() else (head, pieces)

    def batch(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text; unknown pieces of all texts are encoded together."""
        cut = [self.pieces(t) if t else ("", []) for t in texts]
        bad = self.learn(set().union(*[c[1] for c in cut if c]).difference(self.table))
        for text, c in zip(texts, cut):
            if c is None or (bad and not bad.isdisjoint(c[1])):
                yield self.whole(text)
            else:
                yield (self.whole(c[0]) if c[0] else b"") + b"".join(map(self.table.__getitem__, c[1]))

    def learn(self, new: set[str]) -> set[str]:
        """Put pieces into the table, but those that end in white space, which binds to what follows; these are returned."""
        bad = {p for p in new if not p or p[-1].isspace()} if self.spaces else set()
        new -= bad
        # letters, then marks: two pre-tokens
        stems = {p: m for p in new if p[-1:] in MARKS and (m := ENDING.fullmatch(p)) and unicodedata.normalize("NFC", m[1].strip("\n")).lower().isalpha()}
        bases = {p: m[1] for p, m in stems.items()}
        if not self.spaces:  # case is dropped
            bases |= {p: p.lower() for p in new if p.isascii() and p.isalpha() and not p.islower()}
        table = self.table
        self.encode(new.difference(bases).union(bases.values()).difference(table))
        for p, base in bases.items():
            table[p] = table[base] + (self.tail(stems[p][2]) if p in stems else b"")
        return bad

    def tail(self, marks: str) -> bytes:
        if marks not in self.tails:
            if len(self.tails) > 10_000:
                self.tails.clear()
            self.tails[marks] = self.whole(marks)
        return self.tails[marks]

    def encode(self, new: set[str]) -> None:
        """Put the ids of each piece into the table: pieces whose ids tell where they begin or end are encoded many in one string."""
        if self.spaces:  # a printable piece has no white space: spaces part pieces
            own = {p for p in new if (p[1:] if p[:1] == "\n" else p).isprintable() and p != "\n"}
        else:
            own = {p for p in new if p.isalpha()}  # one pre-token
        many, few = list(own), [p for p in new if p not in own]
        spaced = (lambda p: p if p[:1] == "\n" else " " + p) if self.spaces else (lambda p: p)
        groups = [many[i : i + TOGETHER] for i in range(0, len(many), TOGETHER)]
        texts = [("" if self.spaces else " ").join(map(spaced, g)) for g in groups]
        for g, e in zip(groups, self.t.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(e.ids, dtype="<u4")
            at = np.flatnonzero(self.edge[ids]) * 4
            if len(at) != len(g):  # a piece of several: each on its own
                few += g
                continue
            raw = ids.tobytes()
            cuts = [*at.tolist(), len(raw)] if self.spaces else [0, *(at + 4).tolist()]
            self.table.update(zip(g, [raw[i:j] for i, j in zip(cuts, cuts[1:])]))
        for p, e in zip(few, self.t.encode_batch_fast(list(map(spaced, few)), add_special_tokens=False)):
            self.table[p] = np.array(e.ids, dtype="<u4").tobytes()


def coder(path: str) -> Coder:
    """The worker's coder for a tokenizer file."""
    found = _coders.get(path)
    if found is None:
        found = _coders[path] = Coder(path)
    if len(found.table) > TABLE:
        found.table = dict(itertools.islice(found.table.items(), TABLE // 2))
    return found


def encode_column(texts: pa.Array, path: str) -> Iterator[bytes]:
    """Ids of each text of an Arrow column, null counting as empty."""
    held, size = [], 0
    for t in texts:
        held.append(t.as_py() or "")
        size += len(held[-1])
        if size >= BATCH:
            yield from coder(path).batch(held)
            held, size = [], 0
    if held:
        yield from coder(path).batch(held)
