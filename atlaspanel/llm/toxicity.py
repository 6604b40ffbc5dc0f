"""Toxicity: noisy-channel restoration of disguised words, then a linear score.

A character language model (trigrams over a to z, counted over all documents)
ranks the readings of a disguised word. Its lattice offers, per character, the
letters that a digit or sign may stand for, one or two letters for a run of
equal letters or signs, and joining or parting for letters and signs set apart;
Viterbi decoding keeps the ``LIST`` likeliest readings. Every word with a sign
beside a letter is decoded (signs at its edges also as plain marks, and the word
also with the neighbour it may be parted from), every run of equal letters, three
or more pieces of one character set apart by any separator (also without the
one-letter word that may stand before them), and every gap between letters.
Words as written, restored words and their beginnings are then the features of
a logistic model learned from labelled documents.

Defined results: null and empty texts score as texts without a feature; a
document labelled twice counts as toxic if any label says so, null labels are
left out; repeated rows each get their row (and are as many examples when the
model is fitted, within its bound); readings of equal likelihood rank by their
text; columns named like the operator's own pass through as keys; without labels of both kinds every
score is the smoothed share of toxic labels; an empty table gives an empty
result; very long texts are read whole.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atlaspanel.llm.common import fresh, stored, texts

#: Bound on the labelled documents that the classifier is fitted on (chosen by hash of the id).
MAX_LABELLED = 20_000
#: Bound on the features of the model.
MAX_FEATURES = 3_000
#: A feature is looked at if this many labelled documents of the sample hold it.
MIN_DOCS = 4
#: Least likelihood-ratio statistic (chi-square with one degree of freedom) of a feature.
MIN_RATIO = 24.0
PREFIXES = (4, 5)
#: Entries that a worker remembers or adds up before it lets go of them (memory only).
REMEMBERED = 100_000
FEATURES_HELD = 50_000
#: Characters of the texts that are looked at together, one longer text alone.
TOGETHER = 200_000
THRESHOLD = 0.7

# What a sign may stand for (fixed values of the channel), each with the cost of reading it so.
READINGS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "*": "abcdefghijklmnopqrstuvwxyz", "#": "h", "€": "e", "£": "l",
}
READ_COST = 1.0
RUN_COST = 0.5
PART_COST = 0.5
#: Readings that a state of the lattice keeps.
LIST = 3

_SIGNS = "".join(re.escape(c) for c in READINGS)
_SIGN_SET, _LETTERS = frozenset(READINGS), frozenset("abcdefghijklmnopqrstuvwxyz")
_ANY = _SIGN_SET | _LETTERS
# Letters and signs side by side, with at least one sign.
_SIGNED = re.compile(f"(?<![a-z{_SIGNS}])[a-z]*+[{_SIGNS}][a-z{_SIGNS}]*+")
_RUN = re.compile(r"(?<![a-z])[a-z]*?([a-z])\1[a-z]*")
# Letters and signs set apart: each piece one character, or several equal ones ("*" only sets apart).
_PIECE = f"a-z{_SIGNS.replace(re.escape('*'), '')}"
_APART_BY = rf"(?:[^{_PIECE}\w]|_)++"
_AFTER_ONE = re.compile(_APART_BY)
_APART = re.compile(rf"(?<![^\W_])([{_PIECE}])(?<!\1\1)\1*+(?:{_APART_BY}([{_PIECE}])\2*+(?![^\W_])){{2,}}")
# The neighbour that a sign's word may have been parted from (the left one is searched in the reversed text).
_NEXT = re.compile(rf"([\s.\-_])\1*[{_PIECE}]+")
#: A word may begin after, and end before, each of this many groups of equal signs at its edges.
EDGE_GROUPS = 32
# Words: what white space, ASCII signs and digits, and these marks set apart.
_BLANK = bytes(c if c >= 128 or 97 <= c <= 122 or 65 <= c <= 90 else 32 for c in range(256))
_MARKS = "\u2019\u2018\u201c\u201d\u2026\u2013\u2014\u00ab\u00bb\u00a0"
EDGE, OTHER, SYMBOLS = 26, 27, 28
_CLASS = np.full(256, OTHER, np.int64)
_CLASS[97:123] = np.arange(26)
_CLASS[65:91] = np.arange(26)
_CLASS[[0x20, *range(0x09, 0x0E)]] = EDGE
_GAP = np.zeros(256, bool)
_GAP[[0x20, *range(0x09, 0x0E), *b".-_*"]] = True
_GAP_CLASS = np.where(_GAP, EDGE, _CLASS)
# What a byte of a lower-case text is or may be part of: a letter, a gap, a sign, a piece of letters set apart, what sets them apart.
_LETTER, _GAPS, _SIGN, _PART, _SETS_APART, _WORD = 1, 2, 4, 8, 16, 32
_BITS = bytes(
    _LETTER * (chr(b) in _LETTERS) + _GAPS * bool(_GAP[b]) + _SIGN * (chr(b) in _SIGN_SET) + _PART * (chr(b) in _ANY and b != 42)
    + _SETS_APART * (b >= 128 or chr(b) not in _ANY or b == 42) + _WORD * (chr(b) in _LETTERS or 48 <= b <= 57)
    for b in range(128)
) + bytes([_SETS_APART + _GAPS * bool(_GAP[b]) for b in range(128, 256)])
_WIDE_SIGNS = [c for c in READINGS if ord(c) > 127]


def _char_counts(batches):
    total = np.zeros(SYMBOLS**3, np.int64)
    for b in batches:
        for t in texts(b.column("text")):
            c = _CLASS[np.frombuffer(f" {t} ".encode(), np.uint8)]
            if len(c) > 2:
                total += np.bincount((c[:-2] * SYMBOLS + c[1:-1]) * SYMBOLS + c[2:], minlength=SYMBOLS**3)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["code", "n"])


def char_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """log P(c | a, b) over the 28 symbols, from all documents; at most 28 cubed sums reach the driver."""
    counts = docs.select(F.col(text_col).alias("text")).mapInArrow(_char_counts, "code int, n long").groupBy("code").agg(F.sum("n").alias("n"))
    n = np.zeros(SYMBOLS**3)
    for r in counts.collect():
        n[r["code"]] = r["n"]
    n = n.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    one = (n.sum((0, 1)) + 1) / (n.sum() + SYMBOLS)
    two = (n.sum(0) + 5 * one) / (n.sum((0, 2))[:, None] + 5)
    three = (n + 5 * two[None]) / (n.sum(2)[:, :, None] + 5)
    return np.log(three)


class _Many:
    """Viterbi steps over all pairs of symbols at once, for signs that stand for any letter."""

    def __init__(self, lp: np.ndarray, states: dict):
        self.lp, self.base, self.back = lp, {a * SYMBOLS + b: kept[0][1] for (a, b), kept in states.items()}, []
        self.score = np.full((SYMBOLS, SYMBOLS), -np.inf)
        for (a, b), kept in states.items():
            self.score[a, b] = kept[0][0]

    def step(self, slot: list[tuple[str, float]]) -> None:
        code = lambda c: EDGE if c == " " else ord(c) - 97
        lp, score = self.lp, self.score
        new, read = np.full((SYMBOLS, SYMBOLS), -np.inf), np.zeros((SYMBOLS, SYMBOLS), np.int64)
        same = np.arange(SYMBOLS * SYMBOLS).reshape(SYMBOLS, SYMBOLS)
        before = same.copy()
        one = [(i, code(r), cost) for i, (r, cost) in enumerate(slot) if len(r) == 1]
        if one:
            at, k, cost = (np.array(x) for x in zip(*one))
            live = np.flatnonzero(score.max(0) > -np.inf)  # after a letter as written, only that letter
            total = score[:, live, None] + lp[:, live[:, None], k] - cost
            best = total.argmax(0)
            to = live[:, None], k
            new[to] = total.max(0)
            before[to] = best * SYMBOLS + live[:, None]
            read[to] = at
        for i, (r, cost) in enumerate(slot):
            if not r:
                better = score - cost > new
                new, before, read = np.where(better, score - cost, new), np.where(better, same, before), np.where(better, i, read)
            elif len(r) == 2:
                x, y = code(r[0]), code(r[1])
                total = score + lp[:, :, x] + lp[:, x, y] - cost
                at = int(total.argmax())
                if total.flat[at] > new[x, y]:
                    new[x, y], before[x, y], read[x, y] = total.flat[at], at, i
        self.score = new
        self.back.append((before, read, slot))

    def best(self) -> str:
        at, out = int((self.score + self.lp[:, :, EDGE]).argmax()), []
        for before, read, slot in reversed(self.back):
            out.append(slot[read.flat[at]][0])
            at = int(before.flat[at])
        return self.base[at] + "".join(reversed(out))


class Restorer:
    """Viterbi decoding of disguised words; remembers readings (bounded) within a worker."""

    def __init__(self, model: np.ndarray):
        self.lp = model.tolist()
        self.dense = np.asarray(model)
        self.memory: dict[str, tuple[str, ...]] = {}
        self.tokens: dict[str, tuple[bytes, ...]] = {}
        # whether two words are likelier joined, by the last two symbols before and the first two after the gap
        lp = self.dense
        joined = lp[:, :26, :26, None] + lp[None, :26, :26, :]
        parted = lp[:, :26, EDGE, None, None] + lp[:26, EDGE, :26][None, :, :, None] + lp[EDGE, :26, :][None, None] - PART_COST
        self.joins = joined > parted

    @staticmethod
    def _runs(token: str, apart: bool) -> list[tuple[str, int]]:
        """Runs of equal characters; separators of any number are one blank."""
        runs, i = [], 0
        while i < len(token):
            j, c = i, token[i]
            if c in _ANY and not (apart and c == "*"):
                while j < len(token) and token[j] == c:
                    j += 1
                runs.append((c, j - i))
            else:
                while j < len(token) and (token[j] not in _ANY or apart and token[j] == "*"):
                    j += 1
                runs.append((" ", 1))
            i = j
        return runs

    @staticmethod
    def _slots(c: str, m: int, again: bool, keep: bool, edge: bool) -> list[list[tuple[str, float]]]:
        """Readings of a run; ``again``: it repeats the piece before a gap; ``keep``: two equal ones stay two;
        ``edge``: it ends the word (a reading without it is taken apart)."""
        if c == " ":
            return [[("", 0.0), (" ", PART_COST)]]
        fewer = [("", RUN_COST)] if again else []
        if c in READINGS:
            read = [(x, READ_COST) for x in READINGS[c]]
            first = read + ([("", 2 * READ_COST)] if c in "!|*+#(" and not edge else []) + fewer
            more = read + ([("", RUN_COST / (m - 1))] if m > 2 or m == 2 and not keep else [])
            return [first] + [more] * (m - 1)
        if m == 1:
            return [[(c, 0.0), *fewer]]
        if m == 2:
            return [[(c + c, 0.0), *([] if keep else [(c, RUN_COST)]), *fewer]]
        return [[(c, RUN_COST), (c + c, RUN_COST), *fewer]]

    def _letter(self, states: dict, c: str) -> dict:
        """The step of a letter as written."""
        lp, after, k = self.lp, {}, ord(c) - 97
        for (a, b), kept in states.items():
            s = lp[a][b][k]
            new = [(score + s, out + c) for score, out in kept]
            at = b, k
            after[at] = self._likeliest(after[at] + new) if at in after else new
        return after

    def _step(self, states: dict, slot: list[tuple[str, float]]) -> dict:
        lp, after, merged = self.lp, {}, set()
        for (a, b), kept in states.items():
            for reading, cost in slot:
                s, x, y = -cost, a, b
                for c in reading:
                    k = EDGE if c == " " else ord(c) - 97
                    s += lp[x][y][k]
                    x, y = y, k
                new = [(score + s, out + reading) for score, out in kept]
                if (x, y) in after:
                    after[x, y] += new
                    merged.add((x, y))
                else:
                    after[x, y] = new
        for state in merged:
            after[state] = self._likeliest(after[state])
        return after

    @staticmethod
    def _likeliest(readings: list[tuple[float, str]]) -> list[tuple[float, str]]:
        """The ``LIST`` likeliest different readings."""
        out: dict[str, float] = {}
        for s, text in sorted(readings, key=lambda r: (-r[0], r[1])):
            if text not in out:
                out[text] = s
                if len(out) == LIST:
                    break
        return [(s, text) for text, s in out.items()]

    def _read(self, runs: list[tuple[str, int]], apart: bool, keep: bool, found: set[str]) -> None:
        """Adds the likeliest readings, and those that end before each group of signs at the end."""
        end = len(runs)
        while end and (runs[end - 1][0] in _SIGN_SET or runs[end - 1][0] == " "):
            end -= 1
        signs = [c in _SIGN_SET or m > 1 or c == " " for c, m in runs]
        first = signs.index(True)
        lp, states, piece, many = self.lp, {(EDGE, EDGE): [(0.0, "")]}, "", None
        for i, (c, m) in enumerate(runs, 1):
            if m == 1 and many is None and c in _LETTERS and not (apart and c == piece):
                states = self._letter(states, c)
                slots = ()
            else:
                slots = self._slots(c, m, apart and c == piece, keep, i > end)
            for slot in slots:
                if many is None and len(slot) > 25 and len(states) > 3:
                    many = _Many(self.dense, states)
                if many is None:
                    states = self._step(states, slot)
                else:
                    many.step(slot)
            if c != " ":
                piece = c
            if i == len(runs) or first < i and end <= i < end + EDGE_GROUPS:
                if many:
                    found.add(many.best())
                else:
                    found.update(out for _, out in self._likeliest([(s + lp[a][b][EDGE], out) for (a, b), kept in states.items() for s, out in kept]))

    def restore(self, token: str) -> tuple[str, ...]:
        """Words of the likeliest readings of a token.

        Its runs of equal characters are read as one or two; signs at its edges
        are read as letters, and left out as plain marks.
        """
        # letters beyond the two next to a choice change no choice: equal cores are decoded once
        apart, i, j = _APART.fullmatch(token) is not None, 0, len(token)
        while i + 2 < j and token[i] in _LETTERS and token[i + 1] in _LETTERS and token[i + 2] in _LETTERS and token[i] != token[i + 1] != token[i + 2]:
            i += 1
        while j - 3 >= i and token[j - 1] in _LETTERS and token[j - 2] in _LETTERS and token[j - 3] in _LETTERS and token[j - 1] != token[j - 2] != token[j - 3]:
            j -= 1
        core = token[i:j]
        known = self.memory.get(core)
        if known is None:
            if len(self.memory) > REMEMBERED:
                self.memory.clear()
            known = self._decode(core, apart)
            if len(core) < 40:
                self.memory[core] = known
        return tuple(sorted({w for r in known for w in (token[:i] + r + token[j:]).split()}))

    def _decode(self, token: str, apart: bool) -> tuple[str, ...]:
        runs, found = self._runs(token, apart), set()
        start = 0
        while start < len(runs) and runs[start][0] in _SIGN_SET:
            start += 1
        for i in sorted({0, *range(max(0, start - EDGE_GROUPS), start + 1)}):
            if any(c in _SIGN_SET or m > 1 or c == " " for c, m in runs[i:]):
                self._read(runs[i:], apart, False, found)
        return tuple(sorted(found))

    def words(self, text: str) -> set[bytes]:
        """Distinct words as written and as restored (UTF-8)."""
        return self.words_of([text])[0]

    def words_of(self, some: list[str]) -> list[set[bytes]]:
        """The words of each text; the marks of a disguise are searched for in all texts at once."""
        lows, out = [t.lower() for t in some], []
        for plain in lows:
            for c in _MARKS:
                if c in plain:
                    plain = plain.replace(c, " ")
            out.append(set(plain.encode().translate(_BLANK).split()))
        raw = [low.encode() for low in lows]
        starts = np.cumsum([2, *(len(r) + 5 for r in raw)])[:-1]  # two blanks around each, and what is no gap between them
        data = b"  " + b"  \0  ".join(raw) + b"  "
        bits = np.frombuffer(data.translate(_BITS), np.uint8)
        byte = np.frombuffer(data, np.uint8)
        other = np.flatnonzero((bits & _LETTER) == 0)  # no letters: the ends of words
        self._rejoin(data, byte, bits, other, starts, out)
        tokens: list[set[str]] = [set() for _ in some]
        self._doubled(data, byte, bits, other, starts, out, tokens)
        signs = _signed_texts(bits, starts)
        apart = _apart_texts(byte, bits, starts)
        for k, low in enumerate(lows):
            wide = not low.isascii() and any(c in low for c in _WIDE_SIGNS)
            if wide or k in signs:
                tokens[k] |= _with_signs(low)
            if wide or k in apart:
                tokens[k] |= _set_apart(low)
        known = self.tokens
        if len(known) > REMEMBERED:
            known.clear()
        for found, those in zip(out, tokens):
            for token in those:
                words = known.get(token)
                if words is None:
                    words = tuple(w.encode() for w in self.restore(token))
                    if len(token) < 40:
                        known[token] = words
                found.update(words)
        return out

    def _rejoin(self, data: bytes, byte: np.ndarray, bits: np.ndarray, other: np.ndarray, starts: np.ndarray, out: list[set[bytes]]) -> None:
        """Adds words of letters that are likelier joined than parted, by the gap between them (equal separators)."""
        gap, letter = (bits & _GAPS) > 0, (bits & _LETTER) > 0
        left = np.flatnonzero(gap[2:-2] & ~gap[1:-3] & letter[1:-3]) + 2
        change = np.append(np.flatnonzero(gap[:-1] & (byte[1:] != byte[:-1])) + 1, len(byte))
        right = change[np.searchsorted(change, left, side="right")]  # end of the equal separators
        fits = right < len(byte) - 2
        left, right = left[fits], right[fits]
        fits = letter[right]
        left, right = left[fits], right[fits]
        sort = lambda at: _GAP_CLASS[byte[at]]
        fits = self.joins[sort(left - 2), sort(left - 1), sort(right), sort(right + 1)]
        left, right = left[fits], right[fits]
        if not len(left):
            return
        begin = other[np.searchsorted(other, left) - 1] + 1
        end = other[np.searchsorted(other, right)]
        # the bytes without these gaps: joined words are slices of them
        width = right - left
        gone = np.cumsum(width)
        kept = np.ones(len(byte), bool)
        kept[np.arange(gone[-1]) + np.repeat(left - gone + width, width)] = False
        joined = byte[kept].tobytes()
        a, b = begin - gone + width, end - gone
        of = np.searchsorted(starts, left, side="right") - 1
        # rows of joined words: two, three, and all of them
        chained = begin[1:] == right[:-1]
        first, last = np.flatnonzero(np.append(True, ~chained)), np.flatnonzero(np.append(~chained, True))
        many = last - first > 1
        first, last = first[many], last[many]
        three = np.flatnonzero(chained)
        for x, y, at in ((a, b, of), (a[three], b[three + 1], of[three]), (a[first], b[last], of[first])):
            words = [joined[i:j] for i, j in zip(x.tolist(), y.tolist())]
            upto = np.searchsorted(at, np.arange(len(out) + 1)).tolist()
            for found, i, j in zip(out, upto, upto[1:]):
                found.update(words[i:j])

    def _doubled(self, data: bytes, byte: np.ndarray, bits: np.ndarray, other: np.ndarray, starts: np.ndarray, out: list[set[bytes]], tokens: list[set[str]]) -> None:
        """Words with equal letters side by side: of one such pair both readings are words, what has more is to be decoded."""
        pair = np.flatnonzero((byte[1:] == byte[:-1]) & ((bits[1:] & _LETTER) > 0))
        if not len(pair):
            return
        at = np.searchsorted(other, pair)
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        one = (np.diff(np.append(first, len(pair))) == 1).tolist()
        pair, at = pair[first], at[first]
        of = np.searchsorted(starts, pair, side="right") - 1
        for k, i, p, j, single in zip(of.tolist(), (other[at - 1] + 1).tolist(), pair.tolist(), other[at].tolist(), one):
            word = data[i:j]
            if single:  # a list of two readings keeps both
                found = out[k]
                found.add(word)
                found.add(data[i:p] + data[p + 1 : j])
            else:
                tokens[k].add(word.decode())


def _signed_texts(bits: np.ndarray, starts: np.ndarray) -> set[int]:
    """Numbers of the texts with an ASCII sign beside a letter."""
    sign, letter = (bits & _SIGN) > 0, (bits & _LETTER) > 0
    at = np.flatnonzero(sign[1:-1] & (letter[:-2] | letter[2:])) + 1
    return set((np.searchsorted(starts, at, side="right") - 1).tolist())


def _apart_texts(byte: np.ndarray, bits: np.ndarray, starts: np.ndarray) -> set[int]:
    """Numbers of the texts that may hold ASCII letters and signs set apart (the pattern decides)."""
    word = (bits & _WORD) > 0
    change = byte[1:] != byte[:-1]
    # runs of an equal piece character without a letter or digit beside them
    begin = np.flatnonzero(change[:-1] & ~word[:-2] & ((bits[1:-1] & _PART) > 0) & (~word[2:] | ~change[1:])) + 1
    end = begin + 1
    longer = np.flatnonzero(~change[begin])
    if len(longer):
        ends = np.append(np.flatnonzero(change) + 1, len(byte))
        end[longer] = ends[np.searchsorted(ends, begin[longer], side="right")]
    fits = ~word[np.minimum(end, len(word) - 1)]
    begin, end = begin[fits], end[fits]
    if len(begin) < 3:
        return set()
    # two in a row: nothing but what sets apart is between them
    held = np.append(0, np.cumsum((bits & _SETS_APART) == 0, dtype=np.int32))
    next_to = (begin[1:] > end[:-1]) & (held[begin[1:]] == held[end[:-1]])
    at = begin[:-2][next_to[:-1] & next_to[1:]]
    return set((np.searchsorted(starts, at, side="right") - 1).tolist())


def _with_signs(low: str) -> set[str]:
    """Words with a sign beside a letter, also with either neighbour."""
    out, n, back = set(), len(low), None
    for m in _SIGNED.finditer(low):
        word = m.group()
        if _LETTERS.isdisjoint(word):
            continue
        out.add(word)
        # with its neighbours, stars at the edges only setting apart
        if "*" in word and _SIGN_SET.isdisjoint(word.strip("*")):
            continue
        i, j = m.span()
        after = _NEXT.match(low, j) if word[-1] != "*" else None
        if after and not _LETTERS.isdisjoint(after.group()):
            out.add(word.lstrip("*") + after.group())
        if i and word[0] != "*":
            back = low[::-1] if back is None else back
            before = _NEXT.match(back, n - i)
            if before and not _LETTERS.isdisjoint(before.group()):
                out.add(before.group()[::-1] + word.rstrip("*"))
    return out


def _set_apart(low: str) -> set[str]:
    """Letters and signs set apart."""
    out = set()
    for m in _APART.finditer(low):
        token = m.group(0)
        if not _LETTERS.isdisjoint(token):
            out.add(token)
            # the one-letter word before may not belong to it
            gap = _AFTER_ONE.match(token, 1) if token[0] in "ai" else None
            if gap and _APART.fullmatch(token, gap.end()):
                out.add(token[gap.end() :])
    return out


def disguised(low: str) -> set[str]:
    """Words of a lower-case text that look disguised: signs beside letters (also with either neighbour), runs, letters set apart."""
    return {m.group(0) for m in _RUN.finditer(low)} | _with_signs(low) | _set_apart(low)


def parts_of(some: list[str]):
    """Texts in parts of about ``TOGETHER`` characters."""
    part, n = [], 0
    for t in some:
        if part and n + len(t) > TOGETHER:
            yield part
            part, n = [], 0
        part.append(t)
        n += len(t)
    if part:
        yield part


def features(found: set[bytes]) -> set[bytes]:
    """Words, and their beginnings (written with a trailing hyphen)."""
    out = set(found)
    for k in PREFIXES:
        out.update([w[:k] + b"-" for w in found if len(w) >= k])
    return out


def _sum_features(model):
    def sums(n):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(n), pa.binary()), pa.array([v[0] for v in n.values()], pa.int64()), pa.array([v[1] for v in n.values()], pa.int64())],
            ["feature", "clean", "toxic"],
        )

    def run(batches):
        restorer = Restorer(model)
        n: dict[bytes, list[int]] = defaultdict(lambda: [0, 0])
        for b in batches:
            labels = iter(b.column("toxic").to_pylist())
            for part in parts_of(texts(b.column("text"))):
                for found, y in zip(restorer.words_of(part), labels):
                    for f in features(found):
                        n[f][y] += 1
                    if len(n) > FEATURES_HELD:  # the shuffle adds the parts up
                        yield sums(n)
                        n.clear()
        yield sums(n)

    return run


def _pick_features(model, known):
    def run(batches):
        restorer, names = Restorer(model), set(known)
        for b in batches:
            found = (w for part in parts_of(texts(b.column("text"))) for w in restorer.words_of(part))
            rows = [sorted(known[f] for f in features(w) & names) for w in found]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int32())), b.column("toxic")], ["at", "toxic"])

    return run


def fit_logistic(rows: list[list[int]], y: np.ndarray, width: int, l2: float = 0.004, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic model on binary features (accelerated gradient steps)."""
    w, b = np.zeros(width), math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    if not len(y) or y.min() == y.max():
        return w, b
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    at = np.fromiter((k for r in rows for k in r), np.int64, len(doc))
    # a coordinate's curvature is at most a quarter of its documents; rows hold few features each
    most = max(1, max(map(len, rows)))
    rate = 1 / (0.25 * np.bincount(at, minlength=width) * most**0.5 + l2)
    bias_rate = 1 / (0.25 * len(y))
    vw, vb, pw, pb = w.copy(), b, w.copy(), b
    for k in range(steps):
        z = np.clip(vb + np.bincount(doc, vw[at], len(rows)), -30, 30)
        g = 1 / (1 + np.exp(-z)) - y
        w = vw - rate * (np.bincount(at, g[doc], width) + l2 * vw)
        b = vb - bias_rate * g.sum()
        m = k / (k + 3)
        vw, vb, pw, pb = w + m * (w - pw), b + m * (b - pb), w, b
    return w, b


def fit(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_labelled: int = MAX_LABELLED) -> dict:
    """Model from ``labelled`` (doc_id, toxic 0/1) texts of ``docs``: character model, feature weights, intercept."""
    lp = char_model(docs, text_col)
    y = labelled.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    share = max_labelled / max(y.count(), 1)
    if share < 1:  # a documented bound on what the classifier is fitted on
        y = y.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    texts_of = stored(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(y, "doc_id").select("text", "toxic"), "toxic-sample")
    held = texts_of.count()
    if held > 2 * max_labelled:  # ids held by very many rows: the bound is one of rows
        part = F.pmod(F.xxhash64("text", F.monotonically_increasing_id()), F.lit(1 << 20)) < int(max_labelled / held * (1 << 20))
        texts_of = stored(texts_of.filter(part), "toxic-sample")
    sums = (
        texts_of.mapInArrow(_sum_features(lp), "feature binary, clean long, toxic long")
        .groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).filter(F.col("clean") + F.col("toxic") >= MIN_DOCS)
    )
    n1, n0 = (texts_of.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()) or (0, 0)
    n1, n0 = n1 or 0, n0 or 0
    # likelihood ratio of the feature and the label being independent; the bound allows for very many features tried
    part = lambda k, of: F.when(k > 0, k * F.log(k / of)).otherwise(0.0)
    held, n = F.col("clean") + F.col("toxic"), n0 + n1
    ratio = 2 * sum(part(k, m * x / n) for k, m, x in (
        (F.col("toxic"), F.lit(float(n1)), held), (F.col("clean"), F.lit(float(n0)), held),
        (n1 - F.col("toxic"), F.lit(float(n1)), n - held), (n0 - F.col("clean"), F.lit(float(n0)), n - held),
    )) if n else F.lit(0.0)
    telling = sums.withColumn("gain", ratio).filter(F.col("gain") > MIN_RATIO)
    names = sorted(bytes(r["feature"]) for r in telling.orderBy(F.desc("gain"), "feature").limit(MAX_FEATURES).collect())
    known = {f: i for i, f in enumerate(names)}
    picked = texts_of.mapInArrow(_pick_features(lp, known), "at array<int>, toxic int").collect()  # at most max_labelled rows, roughly
    w, b = fit_logistic([r["at"] for r in picked], np.array([r["toxic"] for r in picked], float), len(names))
    return {"chars": lp, "weights": {f: float(w[i]) for f, i in known.items() if w[i]}, "bias": float(b)}


def _score(shared, text: str, kept: set[str], score_name: str):
    def run(batches):
        model = shared.value
        restorer, weights, bias = Restorer(model["chars"]), model["weights"], model["bias"]
        vocab = {f for f in weights if not f.endswith(b"-")}
        starts = [(k, {f[:-1]: weights[f] for f in weights if f.endswith(b"-") and len(f) == k + 1}) for k in PREFIXES]
        starts = [(k, own, set(own)) for k, own in starts if own]
        longest = max(PREFIXES)
        for b in batches:
            scores = []
            for part in parts_of(texts(b.column(text))):
                for found in restorer.words_of(part):
                    z = bias + sum(weights[f] for f in sorted(found & vocab))
                    begun = {w[:longest] for w in found}
                    for k, own, keys in starts:
                        z += sum(own[f] for f in sorted((begun if k == longest else {w[:k] for w in begun}) & keys))
                    scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
            names = [n for n in b.schema.names if n in kept]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(scores, pa.float64())], [*names, score_name])

    return run


def score(
    spark: SparkSession, docs: DataFrame, model: dict, keys: dict, text_col: str = "text", score_name: str = "score", text_key: str | None = None
) -> DataFrame:
    """``keys`` (name -> column) of every document with its score. ``text_key``: the key that is the text itself, which is then sent once."""
    kept = docs.select(*[c.alias(n) for n, c in keys.items()])
    text, rows = text_key, kept
    if text is None:
        (text,) = fresh(kept, "__text")
        rows = docs.select(*[c.alias(n) for n, c in keys.items()], F.col(text_col).alias(text))
    schema = T.StructType([*kept.schema.fields, T.StructField(score_name, T.DoubleType())])
    return rows.mapInArrow(_score(spark.sparkContext.broadcast(model), text, set(kept.columns), score_name), schema)


def training_labels(labels: DataFrame, folds: int = 3, held_out: int = 1) -> DataFrame:
    return labels.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds != held_out)
