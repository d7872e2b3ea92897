"""Toxicity: noisy-channel deobfuscation, then a score of the restored text.

Obfuscated tokens (digits or marks among letters, letters spelled out with blanks
or marks between, letters said many times) are lattices: every character may
stand for itself, for the letter it looks like, or be filling, and a run of one
letter may stand for one or two. A Viterbi search finds the reading of least cost
under a character language model (four-grams of all documents) and the costs of
the channel. The restored text is scored by logistic regression on the presence of
its words and their beginnings, trained by FTRL updates on labelled rows.
"""

from __future__ import annotations

import os
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeframe.llm import ftrl
from gradeframe.llm.common import crc_rest, mix64, slices, text_slices, word_spans

BITS = 20
THRESHOLD = 0.5
MODULUS, HELD_OUT = 5, 0

#: What a mark or digit may stand for (fixed values of common leetspeak).
LOOKS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "¡": "i", "#": "h", "%": "o", "*": "aeiou"}
#: Costs in nats: a look-alike; a wild card; a mark as filling where marks are usual, and where it looks like a letter;
#: a mark or blank as a word edge; repetition beyond the reading.
LOOK_COST, WILD_COST, FILL_COST, LOST_COST, EDGE_COST, RUN_COST = 0.7, 2.5, 0.1, 5.0, 1.0, 0.3
#: Characters without width.
HIDDEN = "\u200b\u200c\u200d\u2060\ufeff\u00ad"
FILLING = set(" .-_*~'`,/\\:;|+^" + HIDDEN)
#: A digit that stays one, in tokens with over twice as many digits as letters; as much again right after a letter.
KEEP_COST = 1.0
#: Characters up to which readings are memoised, and after which what all paths share is written out.
LONGEST = 32
#: Single letters in a row that count as spelled out.
SPELLED = 3

# Symbols of the language model: 0 word edge, 1-26 letters, 27 other letters.
EDGE, OTHER, SYMBOLS = 0, 27, 32
_SYMBOL = np.full(0x250, 255, np.uint8)
for _c in range(0x250):
    if chr(_c).isalpha():
        _base = unicodedata.normalize("NFD", chr(_c).lower())[0]
        _SYMBOL[_c] = ord(_base) - 96 if "a" <= _base <= "z" else OTHER

def symbols(text: str) -> np.ndarray:
    """Symbol per character; 0 for what is no letter."""
    code = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    out = np.where(code < len(_SYMBOL), _SYMBOL[np.minimum(code, len(_SYMBOL) - 1)], 0)
    high = np.flatnonzero(code >= len(_SYMBOL))
    if len(high):
        letters = np.array([chr(c).isalpha() for c in np.unique(code[high])])
        out[high] = np.where(letters[np.unique(code[high], return_inverse=True)[1]], OTHER, 0)
    out[out == 255] = 0
    return out


def four_grams(docs: DataFrame) -> DataFrame:
    """(gram, n): counts of symbol four-grams over the whole texts of all documents."""

    def run(batches):
        total = np.zeros(SYMBOLS**4, np.int64)
        for batch in batches:
            for _, _, texts in text_slices(batch.column("text")):
                s = symbols("  ".join(["", *texts, ""])).astype(np.int32)
                first = (s[1:] != EDGE) | (s[:-1] != EDGE)  # an edge once, however many marks
                s = np.concatenate((np.zeros(3, np.int32), s[1:][first]))
                # Context does not reach over a word edge: pad with edges on its left.
                k1 = s[2:-1] * 1
                k2 = np.where(k1 == EDGE, EDGE, s[1:-2])
                k3 = np.where(k2 == EDGE, EDGE, s[:-3])
                total += np.bincount(((k3 * SYMBOLS + k2) * SYMBOLS + k1) * SYMBOLS + s[3:], minlength=len(total))
        gram = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(gram.astype(np.int32)), pa.array(total[gram])], names=["gram", "n"])

    return docs.select("text").mapInArrow(run, "gram int, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


def language_model(docs: DataFrame) -> np.ndarray:
    """-log P(symbol | three before it), float32 [SYMBOLS ** 4], from interpolated counts."""
    grams = four_grams(docs).toPandas()  # at most 28 ** 4 counts, whatever the corpus
    n = np.zeros(SYMBOLS**4)
    n[grams["gram"].to_numpy()] = grams["n"].to_numpy(float)
    n = n.reshape((SYMBOLS,) * 4)
    p = np.full(SYMBOLS, 1 / 28)
    for order in range(4):
        counts = n.sum(axis=tuple(range(3 - order))) if order < 3 else n
        total = counts.sum(-1, keepdims=True)
        p = (counts + 4.0 * p) / (total + 4.0)
    return -np.log(p).astype(np.float32).ravel()


class Decoder:
    """Viterbi decoding of single tokens, memoised (a bounded number of tokens)."""

    def __init__(self, model: np.ndarray):
        self.cost = model
        self.known: dict[str, str] = {}

    def options(self, token: str) -> list[list[tuple[str, float]]]:
        """Readings of each run of equal characters: (letters, a blank for a word edge, or nothing; cost)."""
        out = []
        number = 3 * sum(map(str.isalpha, token)) < sum(map(str.isalnum, token))
        for m in re.finditer(r"(.)\1*", token, re.S):
            c, run = m[1], len(m[0])
            if c.isalpha():
                read = [(c, RUN_COST * (run > 1) if run < 3 else 0.05)]
                if run >= 2:
                    read.append((c * 2, 0.0 if run == 2 else 0.4))
            else:
                read = [(x, LOOK_COST if len(LOOKS[c]) < 3 else WILD_COST) for x in LOOKS.get(c, "")]
                if run == 2:
                    read = [(x * 2, cost) for x, cost in read] + [(x, cost + 1.0) for x, cost in read]
                read.append(("", FILL_COST if c in FILLING else LOST_COST))
                if not c.isdigit():
                    read.append((" ", EDGE_COST))
                elif number:
                    read.append((c * run, KEEP_COST * run))
            out.append(read)
        return out

    def decode(self, token: str) -> str:
        if len(token) > LONGEST:
            return self._viterbi(token)
        if token not in self.known:
            if len(self.known) > 200_000:
                self.known.clear()
            self.known[token] = self._viterbi(token)
        return self.known[token]

    def _viterbi(self, token: str) -> str:
        cost = self.cost
        # States are the last three symbols; each keeps its cheapest path.
        states: dict[int, tuple[float, str]] = {0: (0.0, "")}
        done = []
        for step, read in enumerate(self.options(token), 1):
            if step % LONGEST == 0:  # paths meet soon: the work is linear in the token
                shared = os.path.commonprefix([path for _, path in states.values()])
                done.append(shared)
                states = {at: (total, path[len(shared):]) for at, (total, path) in states.items()}
            after: dict[int, tuple[float, str]] = {}
            for letters, extra in read:
                codes = [EDGE] if letters.isdigit() else symbols(letters).tolist()
                for context, (so_far, path) in states.items():
                    total, at = so_far + extra + KEEP_COST * (context != EDGE and letters.isdigit()), context
                    for s in codes:
                        if s == at == EDGE and letters != " ":  # beside a digit that stays
                            continue
                        total += float(cost[at * SYMBOLS + s])
                        at = (at * SYMBOLS + s) % SYMBOLS**3 if s else 0
                    if at not in after or total < after[at][0]:
                        after[at] = (total, path + letters)
            states = after
        return "".join([*done, min((total + float(cost[at * SYMBOLS + EDGE]), path) for at, (total, path) in states.items())[1]])

    def token(self, token: str) -> str:
        """What an obfuscated token (or spelled-out run of letters) says; links and mail addresses say what they are.

        Punctuation around it stays out of the lattice; marks at its edges that may
        be letters give a second reading."""
        if not any(map(str.isalpha, token)) or "://" in token or re.fullmatch(r"\S+@\S+\.\S+", token):
            return token
        body = token.strip(_EDGES)
        inner = body.strip(_MARKS)
        read = self.decode(body)
        if read == body:
            return token
        return read if inner == body else f"{read} {self.decode(inner) if inner else ''}"

    def restore(self, texts: list[str]) -> list[str]:
        """Lower-cased texts with obfuscated tokens replaced by their readings."""
        lower = [t.lower() for t in texts]
        out = []
        for a, b in slices([len(t) for t in lower]):
            data = [t.encode("utf-8", "replace") for t in lower[a:b]]
            buf, text_starts, text, first, last = suspects(data)
            edges = np.searchsorted(text, np.arange(b - a + 1)).tolist()
            for i in range(b - a):
                if edges[i] == edges[i + 1]:
                    out.append(lower[a + i])
                    continue
                own, at, pieces = data[i], 0, []
                for p, q in zip((first[edges[i]: edges[i + 1]] - text_starts[i]).tolist(), (last[edges[i]: edges[i + 1]] - text_starts[i]).tolist(), strict=True):
                    pieces += [own[at:p].decode(), self.token(own[p:q].decode())]
                    at = q
                out.append("".join([*pieces, own[at:].decode()]))
        return out


_EDGES, _MARKS = ".,;:!?\"'()[]{}", "#%*&$-_~|@!+€£^=0123456789.,;:?\"'()[]{}<>"
_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[97:123] = _IS_LETTER[65:91] = _IS_LETTER[128:] = True
_IS_LOOK = np.zeros(256, bool)
_IS_LOOK[[ord(c) for c in LOOKS if ord(c) < 128 and c not in "(!"]] = True  # these end words as they are
#: Look-alikes and hidden characters beyond ASCII, which are no letters.
_SEQUENCES = [c.encode() for c in [*LOOKS, *HIDDEN] if ord(c) >= 128]


def suspects(data: list[bytes]) -> tuple[np.ndarray, ...]:
    """Byte ranges of tokens that may be obfuscated: (buffer, text starts, text, first, last), in order.

    Tokens with a mark or digit right before a letter, a look-alike right after one, a look-alike beyond
    ASCII, a hidden character, or a letter said three times; runs of ``SPELLED`` or more single letters,
    each with a mark beside it or not."""
    buf, text_starts, starts, ends, text, _ = word_spans(data)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return buf, text_starts, none, none, none
    letter = _IS_LETTER[buf]
    space = buf <= 32
    mark = ~letter & ~space
    found = np.zeros(len(buf), bool)
    found[:-1] |= mark[:-1] & letter[1:]
    found[:-1] |= letter[:-1] & _IS_LOOK[buf[1:]]
    for sequence in _SEQUENCES:
        at = np.flatnonzero(buf[: len(buf) - len(sequence) + 1] == sequence[0])
        for k in range(1, len(sequence)):
            at = at[buf[at + k] == sequence[k]]
        found[at] = True
    found[:-2] |= letter[:-2] & (buf[:-2] < 128) & (buf[:-2] == buf[1:-1]) & (buf[1:-1] == buf[2:])
    where = np.flatnonzero(found)
    word = np.unique(np.searchsorted(starts, where, "right") - 1)
    length = ends - starts
    single = (length == 1) & ~space[starts] | (length == 2) & (buf[starts] >= 0xC2)
    said = letter[starts] | _IS_LOOK[buf[starts]]
    # A letter with a mark before or after it (buf ends with a line feed, so starts + 1 is inside).
    single |= (length == 2) & (buf[starts] < 128) & (mark[starts + 1] & said | mark[starts] & letter[starts + 1] & (buf[starts + 1] < 128))
    single |= (length == 3) & (buf[starts] >= 0xC2) & mark[ends - 1]
    single &= said | mark[starts] & (length == 2)
    edge = np.diff(np.concatenate(([False], single, [False])).astype(np.int8))
    run, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    # A run does not leave its text.
    begin = np.concatenate((run, np.flatnonzero(np.diff(text, prepend=-1))))
    begin = np.unique(begin[np.isin(begin, np.flatnonzero(single))])
    stop = np.minimum(stop[np.searchsorted(stop, begin, "right")], np.searchsorted(text, text[begin], "right"))
    spelled = stop - begin >= SPELLED
    run, stop = begin[spelled], stop[spelled]
    inside = np.zeros(len(starts) + 1, np.int64)
    inside[run] += 1
    inside[stop] -= 1
    word = word[np.cumsum(inside)[word] == 0]
    first, last = np.concatenate((starts[word], starts[run])), np.concatenate((ends[word], ends[stop - 1]))
    order = np.argsort(first)
    return buf, text_starts, np.concatenate((text[word], text[run]))[order], first[order], last[order]


#: Marks and digits that part words once the text is restored.
_CUTS = bytes(c for c in range(33, 127) if not chr(c).isalpha())
_SALT = mix64(np.arange(700, 703, dtype=np.uint64))
_BEGINNINGS = (4, 5)


def word_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature) of the words of restored texts and their first bytes."""
    buf, _, starts, ends, text, words = word_spans([t.encode("utf-8", "replace") for t in texts], _CUTS)
    kinds = [(text, words)]
    padded = np.concatenate((buf, np.zeros(8, np.uint8))).astype(np.uint64)
    for n in _BEGINNINGS:
        long = np.flatnonzero(ends - starts >= n)
        h = np.zeros(len(long), np.uint64)
        for k in range(n):
            h = h * np.uint64(257) + padded[starts[long] + k]
        kinds.append((text[long], mix64(h + np.uint64(n))))
    feature = [(mix64(h ^ _SALT[k]) >> np.uint64(64 - BITS)).astype(np.int64) for k, (_, h) in enumerate(kinds)]
    return np.concatenate([t for t, _ in kinds]), np.concatenate(feature)


_DECODERS: list = []


def decoder(model: np.ndarray) -> Decoder:
    """The worker's decoder; another model replaces it."""
    if not _DECODERS or not np.array_equal(_DECODERS[0].cost, model):
        _DECODERS[:] = [Decoder(model)]
    return _DECODERS[0]


def train(docs: DataFrame, labels: DataFrame, model: np.ndarray) -> np.ndarray:
    rows = ftrl.training_rows(docs, labels, "toxic", MODULUS, HELD_OUT)

    def features(texts):
        restore = decoder(model).restore
        for a, b in slices([len(t) for t in texts]):
            text, feature = word_features(restore(texts[a:b]))
            order = np.argsort(text, kind="stable")
            feature, edges = feature[order], np.searchsorted(text[order], np.arange(b - a + 1))
            for i in range(b - a):
                index = np.unique(feature[edges[i]: edges[i + 1]])
                index = np.concatenate(([0], index[index > 0]))
                yield index, np.ones(len(index))

    return ftrl.fit(rows, features, 1 << BITS, epochs=3, alpha=1.0, beta=1.0, l1=5.0, l2=0.0)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on the labelled rows that are not held out and score every document.

    ``docs``: doc_id, text and any others (kept); ``labels``: doc_id, toxic. Adds score (0 to 1, higher: label 1 likelier),
    predicted (1 if score >= 0.5), restored (the lower-cased text as it was
    scored) and held_out (crc32 of the id modulo 5 is 0; NULL for a NULL id). A NULL or empty text gets the
    score of the constant, repeated rows equal scores. No documents, no rows; no
    labels, a score of 0.5 everywhere.
    """
    model = language_model(docs)
    weights = train(docs, labels, model)
    rest = [c for c in docs.columns if c not in ("score", "predicted", "restored", "held_out")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(rest).schema) + ", score double, restored string"

    def run(batches):
        restore = decoder(model).restore
        for batch in batches:
            for a, b, texts in text_slices(batch.column("text")):
                own = restore(texts)
                text, feature = word_features(own)
                use = np.flatnonzero((weights[feature] != 0) & (feature > 0))
                once = np.unique(text[use] * (1 << BITS) + feature[use])
                value = ftrl.logistic(weights[0] + np.bincount(once >> BITS, weights[once & (1 << BITS) - 1], b - a))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), pa.array(value), pa.array(own, pa.string())], names=[*rest, "score", "restored"])

    out = docs.select(rest).mapInArrow(run, schema)
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")).withColumn("held_out", crc_rest(F.col("doc_id"), MODULUS) == HELD_OUT)
