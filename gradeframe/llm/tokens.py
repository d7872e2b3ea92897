"""Ids of public tokenizers, per text, with a cache of the chunks between white space.

Pre-tokenization never crosses a boundary between a non-space character and
white space, so texts are cut there (numpy, a few megabytes at a time), each
distinct chunk of a pass is looked up once, new ones are encoded by the library,
and the ids of a text are the gathered ids of its chunks. Nearly all are a word
of Latin-1 letters, perhaps with punctuation behind it: their pieces are plain,
and go straight to the library's model; any other chunk goes through its whole
chain (normalizer, pre-tokenizer, model), which costs four times as much.

The cache belongs to the Python worker: sorted arrays of 64-bit chunk hashes and
their ids, about 30 bytes a chunk. Past ``CACHE_ENTRIES`` chunks or ``CACHE_IDS`` ids, those not
asked for since the last time go (all, if nearly all were), so its memory is bounded and frequent chunks stay.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

from gradeframe.llm.common import span_hashes, word_spans

CACHE_ENTRIES, CACHE_IDS = 1_500_000, 10_000_000
#: Pieces that the worker remembers by their text.
CACHE_PIECES = 150_000

_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN_SPACED = re.compile(rf"(\n?)( ?[{_LETTERS}]+)([.,;:!?]*)").fullmatch
_PLAIN_WORD = re.compile(rf"()([{_LETTERS}]+)([.,;:!?]*)").fullmatch


def _byte_alphabet() -> dict[int, str]:
    """The printable character by which byte-level vocabularies write each byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(other)}


_ALPHABET = _byte_alphabet()

#: Other white space before a blank: the cut between them is no boundary, so such a text goes through the chain whole.
_ODD = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000](?=[\t-\r ])")


class Encoder:
    """``encode(texts)`` gives little-endian unsigned 32-bit ids as bytes, one per text.

    ``keeps_space``: white space belongs to the ids (byte-level vocabularies). If
    False the vocabulary drops white space, and chunks never contain a blank or line feed.
    """

    def __init__(self, path: str, keeps_space: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.keeps_space = keeps_space
        self.pieces: dict[str, bytes] = {}
        self._reset(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, "<u4"))

    def _reset(self, keys: np.ndarray, count: np.ndarray, flat: np.ndarray) -> None:
        """The cache: ascending hashes, and the ids of each, one after the other."""
        self.keys, self.count, self.flat = keys, count, flat
        self.place = np.cumsum(count) - count
        self.used = np.ones(len(keys), bool)

    def _model(self, piece: str) -> bytes:
        """Ids of one pre-tokenized piece, from the library's model."""
        if piece.isascii():
            letters = "\u0120" + piece[1:] if piece[0] == " " else "\u010a" if piece == "\n" else piece
        else:
            letters = piece.encode().decode("latin-1").translate(_ALPHABET)
        return array("I", [t.id for t in self.tokenizer.model.tokenize(letters)]).tobytes()

    def _encode_new(self, chunks: list[bytes]) -> list[bytes]:
        pieces, model = self.pieces, self._model
        if len(pieces) > CACHE_PIECES:
            pieces.clear()
        plain = _PLAIN_SPACED if self.keeps_space else _PLAIN_WORD
        out, rest = [], []
        for c in chunks:
            m = plain(c.decode())
            if m is None:
                rest.append(len(out))
                out.append(b"")
                continue
            line, word, marks = m.groups()
            if not self.keeps_space:
                word = word.lower()
            ids = pieces.get(word)
            if ids is None:
                ids = pieces[word] = model(word)
            for extra in (line, marks):
                if extra and extra not in pieces:
                    pieces[extra] = model(extra)
            if line:
                ids = pieces[line] + ids
            out.append(ids + pieces[marks] if marks else ids)
        for i in range(0, len(rest), 8192):
            part = rest[i: i + 8192]
            for k, e in zip(part, self.tokenizer.encode_batch([chunks[k].decode() for k in part], add_special_tokens=False), strict=True):
                out[k] = array("I", e.ids).tobytes()
        return out

    def _gather(self, place: np.ndarray, count: np.ndarray, flat: np.ndarray) -> np.ndarray:
        behind = np.cumsum(count)
        total = int(behind[-1]) if len(behind) else 0
        return flat[np.repeat(place - behind + count, count) + np.arange(total)]

    def _look_up(self, hashes: np.ndarray, chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, count, flat): where the ids of ascending distinct hashes are; ``chunk(i)`` gives the bytes of one."""
        at = np.searchsorted(self.keys, hashes)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == hashes[known]
        new = np.flatnonzero(~known)
        if len(new):
            ids = self._encode_new([chunk(i) for i in new.tolist()])
            own = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            before = at[new]
            keys = np.insert(self.keys, before, hashes[new])
            count = np.insert(self.count, before, own)
            place = np.insert(self.place, before, len(self.flat) + np.cumsum(own) - own)
            self.used = np.insert(self.used, before, True)
            self.flat = np.concatenate((self.flat, np.frombuffer(b"".join(ids), "<u4")))
            self.keys, self.count, self.place = keys, count, place
            at = np.searchsorted(self.keys, hashes)
        self.used[at] = True
        found = self.place[at], self.count[at], self.flat
        if len(self.keys) > CACHE_ENTRIES or len(self.flat) > CACHE_IDS:
            keep = self.used
            if keep.sum() > CACHE_ENTRIES * 3 // 4 or self.count[keep].sum() > CACHE_IDS * 3 // 4:
                keep = np.zeros(len(self.keys), bool)
            keys, count, flat = self.keys[keep], self.count[keep], self._gather(self.place[keep], self.count[keep], self.flat)
            self._reset(keys, count, flat)
            self.used[:] = False
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of a few megabytes of texts."""
        odd = {i for i, t in enumerate(texts) if not t.isascii() and _ODD.search(t)} if self.keeps_space else set()
        data = [b"" if i in odd else t.encode("utf-8", "replace") for i, t in enumerate(texts)]
        whole = b"\n".join(data) + b"\n"
        buf, begin, starts, ends, text, hashes = word_spans(data)
        size = np.fromiter(map(len, data), np.int64, len(data))
        end = begin
        out = [b""] * len(data)
        if len(starts):
            if self.keeps_space:  # a chunk begins where the word before it ended
                starts = np.concatenate((starts[:1], ends[:-1]))
                first = np.flatnonzero(np.diff(text, prepend=-1))
                starts[first] = begin[text[first]]
                hashes = span_hashes(buf, starts, ends)
            order = np.argsort(hashes)
            same = hashes[order]
            edge = np.concatenate(([True], same[1:] != same[:-1]))
            at, which = order[edge], np.empty(len(order), np.int64)
            which[order] = np.cumsum(edge) - 1
            place, n, flat = self._look_up(same[edge], lambda i: whole[starts[at[i]]: ends[at[i]]])
            count = n[which]
            behind = np.cumsum(count)
            ids = self._gather(place[which], count, flat).tobytes()
            last = np.searchsorted(text, np.arange(len(data)), "right")
            stop = (np.concatenate(([0], behind))[last] * 4).tolist()
            out = [ids[p:q] for p, q in zip([0, *stop[:-1]], stop, strict=True)]
            end = np.where(np.diff(last, prepend=0) > 0, ends[last - 1], begin)
        if self.keeps_space:  # white space at the end of a text is a chunk of its own
            for i in np.flatnonzero(end < begin + size).tolist():
                out[i] += self._encode_new([whole[end[i]: begin[i] + size[i]]])[0]
        for i in odd:
            out[i] = array("I", self.tokenizer.encode(texts[i], add_special_tokens=False).ids).tobytes()
        return out


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, keeps_space: bool) -> Encoder:
    """The worker's encoder of a vocabulary file, made on first use."""
    key = (path, keeps_space)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, keeps_space)
    return _ENCODERS[key]
