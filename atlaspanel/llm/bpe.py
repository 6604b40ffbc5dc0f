"""BPE encoding and decoding with a segment tree over the ranks of adjacent pairs.

A piece starts as its characters. The tree's leaf i holds the rank of the merge
of symbol i with the symbol after it (and i itself, so that of equal ranks the
leftmost is smaller); an inner node holds the smaller of its children, so the
root is the leftmost merge of the lowest rank. Applying it changes three leaves
(the merged symbol, the swallowed one and the one before), each of which is
carried up in logarithmic time; encoding ends when the root holds no merge.
Short pieces are encoded together, a row of one matrix each; a long piece has a
tree of its own, so a text without a blank costs n log n.

Spark deals the rows. A worker cuts stretches of ASCII and Latin letters into
pieces by one pattern. A unit (what ASCII white space sets apart, which no piece
crosses) with any other character is cut by the library's own normaliser and
pre-tokeniser. Equal pieces and units are encoded once (a bounded memory, for
speed only). The decoded text follows from the ids alone.

Defined results: a null text counts as the empty text (no ids, empty decoded
text); every row gets its row, repeated rows and ids too; an empty table gives
an empty result; very long texts and units are encoded whole; of columns named
like the operator's own (``ids``, ``decoded``) the operator's are returned;
other columns pass through.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atlaspanel.llm.common import fresh, texts

#: Pieces, and units with other characters, remembered by one Python worker (speed only).
MEMORY_PIECES = 500_000
#: Longer pieces and units (characters, bytes) are not remembered.
MEMORY_BYTES = 200
#: Pieces of at most this many symbols are encoded together.
TOGETHER = 64
#: Pieces of one matrix: bounds its memory.
ROWS = 20_000
#: Texts that are encoded at once.
STEP = 400

NONE = np.int64(1 << 62)
_WORKER: dict = {}

# A pre-tokeniser pattern of public vocabularies, and the same for lower-case texts without odd characters.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_LATIN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u017f]+|[0-9]|[^ \t-\ra-z0-9\u00df-\u00f6\u00f8-\u017f]+")
BLANKS = re.compile(r"[ \t-\r]+")
# Beyond ASCII and the Latin letters that stay letters of their own when normalised and lower-cased.
ODD = re.compile(r"[^\x00-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]")


class Memory:
    """A bounded map of two halves: when the newer is full, the older is let go of; what is asked for again moves up."""

    def __init__(self, bound: int):
        self.half, self.new, self.old = bound // 2, {}, {}

    def turn(self) -> None:
        """Make room, between two steps."""
        if len(self.new) > self.half:
            self.old, self.new = self.new, {}

    def missing(self, keys: set) -> list:
        """Those of ``keys`` that are not known; the others are in ``new`` until the next turn."""
        new, old, out = self.new, self.old, []
        for k in keys.difference(new):
            known = old.get(k)
            if known is None:
                out.append(k)
            else:
                new[k] = known
        return out

    def forget(self, keys: list) -> None:
        for k in keys:
            if len(k) > MEMORY_BYTES:
                del self.new[k]


class Merges:
    """The merges of a vocabulary: symbol pairs by rank, and what they merge into."""

    def __init__(self, vocabulary: dict[str, int], merges: list):
        pairs = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in merges]
        self.rank = {(vocabulary[a], vocabulary[b]): (r, vocabulary[a + b]) for r, (a, b) in enumerate(pairs)}
        self.width = max(vocabulary.values(), default=0) + 1
        keys = np.array([a * self.width + b for a, b in self.rank], np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        rank, into = np.array(list(self.rank.values()), np.int64).reshape(-1, 2).T
        self.ranks = rank[order]
        self.into = np.zeros(len(pairs) + 1, np.int64)
        self.into[rank] = into

    def lookup(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The ranks of pairs of symbols; ``NONE`` where there is no merge or no symbol (negative)."""
        if not len(self.keys):
            return np.full(a.shape, NONE)
        key = a * self.width + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.ranks[at], NONE)


def merge_long(symbols: list[int], merges: Merges) -> list[int]:
    """One piece of any length, by a tree of its own."""
    n = len(symbols)
    if n < 2:
        return list(symbols)
    size = 1 << (n - 1).bit_length()
    none, rank = (1 << 62, 0), merges.rank
    sym, after, before = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))

    def leaf(i: int) -> tuple[int, int]:
        found = rank.get((sym[i], sym[after[i]])) if after[i] < n else None
        return (found[0], i) if found else none

    tree = [none] * size + [leaf(i) for i in range(n)] + [none] * (size - n)
    for k in range(size - 1, 0, -1):
        tree[k] = min(tree[2 * k], tree[2 * k + 1])

    def put(i: int, value: tuple[int, int]) -> None:
        k = size + i
        tree[k] = value
        while k > 1:
            k >>= 1
            best = min(tree[2 * k], tree[2 * k + 1])
            if tree[k] == best:
                break
            tree[k] = best

    while tree[1] is not none and tree[1] != none:
        i = tree[1][1]
        gone = after[i]
        sym[i] = rank[sym[i], sym[gone]][1]
        after[i] = after[gone]
        if after[i] < n:
            before[after[i]] = i
        put(gone, none)
        put(i, leaf(i))
        if before[i] >= 0:
            put(before[i], leaf(before[i]))
    out, i = [], 0
    while i < n:
        out.append(sym[i])
        i = after[i]
    return out


def merge_together(pieces: list[list[int]], merges: Merges) -> list[np.ndarray]:
    """Many short pieces, encoded together."""
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    flat, counts = merge_rows(np.concatenate([np.array(p, np.int64) for p in pieces]), lengths, merges)
    ends = np.cumsum(counts).tolist()
    return [flat[a:b] for a, b in zip([0, *ends], ends)]


def merge_rows(symbols: np.ndarray, length: np.ndarray, merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Pieces side by side and their lengths -> ids side by side and their numbers.

    Row r of the matrices is the tree and the symbols of piece r.
    """
    m, size = len(length), max(2, 1 << (int(length.max()) - 1).bit_length())
    wide, at = size + 1, np.arange(size)  # the last column: no symbol, and a place to write to where nothing follows
    held = at < length[:, None]
    sym = np.full((m, wide), -1, np.int64)
    sym[:, :size][held] = symbols
    tree = np.full((m, 2 * size), NONE)
    rank = merges.lookup(sym[:, :-1], sym[:, 1:])
    tree[:, size:] = np.where(rank < NONE, rank * size + at, NONE)
    for k in range(size - 1, 0, -1):
        np.minimum(tree[:, 2 * k], tree[:, 2 * k + 1], out=tree[:, k])
    after = np.where(at + 1 < length[:, None], at + 1, size)
    after = np.concatenate([after, np.full((m, 1), size)], 1).ravel()
    before = np.broadcast_to(np.where(at > 0, at - 1, size), (m, size))
    before = np.concatenate([before, np.full((m, 1), size)], 1).ravel()
    flat, tree = sym.ravel(), tree.ravel()
    rows = np.flatnonzero(tree[1 :: 2 * size] < NONE)
    best = tree[rows * (2 * size) + 1]
    while len(rows):
        row, top = rows * wide, rows * (2 * size)
        rank, i = np.divmod(best, size)
        here = row + i
        gone = after[here]
        beyond = after[row + gone]
        left = before[here]
        into = merges.into[rank]
        flat[here] = into
        flat[row + gone] = -1
        after[here] = beyond
        before[row + beyond] = i
        # the ranks of the merged symbol with the next one, and of the one before with it
        two = merges.lookup(np.concatenate([into, flat[row + left]]), np.concatenate([flat[row + beyond], into]))
        two = np.where(two < NONE, two * size + np.concatenate([i, left]), NONE)
        some = left < size
        leaf = top + size
        tree[leaf + gone] = NONE
        tree[leaf + i] = two[: len(rows)]
        tree[(leaf + left)[some]] = two[len(rows) :][some]
        three = np.stack([i, gone, np.where(some, left, i)]) + size
        while three[0, 0] > 1:
            three >>= 1
            node = top + three
            child = node + three
            tree[node] = np.minimum(tree[child], tree[child + 1])
        best = tree[top + 1]
        going = best < NONE
        rows, best = rows[going], best[going]
    left = sym[:, :size] >= 0
    return sym[:, :size][left].astype(np.int32), left.sum(1)


class Encoder:
    """Encodes and decodes as the library does, without added special tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges") if model.get(k)]
        if model["type"] != "BPE" or odd:
            raise ValueError(f"not a plain BPE model: {model['type']} {odd}")
        added = spec.get("added_tokens") or []
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError("added tokens must be matched as they stand")
        self.vocabulary = model["vocab"]
        self.merges = Merges(self.vocabulary, model["merges"])
        self.word_end = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in added}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.parts = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if added else None
        self.mark = os.path.commonprefix(longest_first)  # in every text that holds a special token
        # texts without odd characters can be cut without the library where its steps are the known ones
        steps = [*((spec.get("normalizer") or {}).get("normalizers") or []), *((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [])]
        known = [("NFC", None), ("Replace", r"\s+"), ("Lowercase", None), ("Split", WORD_PATTERN), ("ByteLevel", None)]
        self.simple = [(x["type"], (x.get("pattern") or {}).get("Regex")) for x in steps] == known and bool(self.word_end)
        self.ends = {t[: -len(self.word_end)]: i for t, i in self.vocabulary.items() if t.endswith(self.word_end)} if self.word_end else {}
        self.token = {i: t for t, i in [*self.vocabulary.items(), *self.special.items()]}
        self.tokens = pa.array([self.token.get(i, "") for i in range(max(self.token, default=-1) + 1)], pa.large_string())
        if self.simple:
            # the ids of a byte within a piece and at its end (the byte-level step shows each byte as a character)
            shown = [self._shown(k) for k in range(256)]
            self.inner = np.array([self.vocabulary.get(c, -1) for c in shown], np.int64)
            self.last = np.array([self.ends.get(c, -1) for c in shown], np.int64)
            self.byte = {c: k for k, c in enumerate(shown)}
        # ids are kept as 32-bit numbers side by side, so that those of a text are joined without a loop
        self.memory = Memory(MEMORY_PIECES)

    @staticmethod
    def _shown(byte: int) -> str:
        """The byte-level step's character of a byte: itself if visible in Latin-1, else the next one free from U+0100 on."""
        visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        return chr(byte if byte in visible else 0x100 + byte - sum(v < byte for v in visible))

    def symbols(self, piece: str) -> list[int]:
        """A piece's characters as ids; a character that the vocabulary lacks gives none, as in the library."""
        if not self.word_end:
            return [v for c in piece if (v := self.vocabulary.get(c)) is not None]
        ids = [*map(self.vocabulary.get, piece[:-1]), self.ends.get(piece[-1])]
        return [v for v in ids if v is not None] if None in ids else ids

    def plain(self, text: str) -> bool:
        """Whether ``WORD_LATIN`` cuts the text as the library would."""
        return not ODD.search(text) and not (self.special and self.mark in text)

    def parted(self, text: str) -> list[str | bytes]:
        """A text as pieces (text) and as units that are yet to be cut (bytes)."""
        if not self.word_end or self.library.decoder:  # blanks are part of the pieces, or the decoder may look across units
            return [text.encode()] * bool(text)
        if not self.simple:
            return text.encode().split()
        if self.plain(text):
            return WORD_LATIN.findall(text.lower())
        out, stretch = [], []
        for u in BLANKS.split(text):
            if self.plain(u):
                stretch.append(u)
            else:
                out += WORD_LATIN.findall(" ".join(stretch).lower())
                out.append(u.encode())
                stretch = []
        return out + WORD_LATIN.findall(" ".join(stretch).lower())

    def cut(self, unit: bytes) -> list[str | int]:
        """A unit as pieces (text) and special tokens (ids)."""
        text, out = unit.decode(), []
        parts = self.parts.split(text) if self.special and self.mark in text else [text]
        for part in parts:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                normal = self.library.normalizer.normalize_str(part) if self.library.normalizer else part
                some = [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)] if self.library.pre_tokenizer else [normal]
                out += [bytes(map(self.byte.__getitem__, p)).decode() for p in some] if self.simple else some
        return out

    def learn(self, new: list[str]) -> None:
        """Encode pieces that are not known yet."""
        if self.simple:
            raw = [p.encode() for p in new]
            lengths = np.fromiter(map(len, raw), np.int64, len(raw))
            held = np.frombuffer(b"".join(raw), np.uint8)
            flat, ends = self.inner[held], np.cumsum(lengths)
            flat[ends - 1] = self.last[held[ends - 1]]
            if len(flat) and flat.min() < 0:  # a character that the vocabulary lacks gives no id
                lengths = np.add.reduceat(flat >= 0, ends - lengths, dtype=np.int64)
                flat = flat[flat >= 0]
        else:
            ids = [self.symbols(p) for p in new]
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.array([k for some in ids for k in some], np.int64)
        known, starts = self.memory.new, np.cumsum(lengths) - lengths
        for k in np.flatnonzero((lengths == 0) | (lengths > TOGETHER)).tolist():
            known[new[k]] = np.array(merge_long(flat[starts[k] : starts[k] + lengths[k]].tolist(), self.merges), np.int32).tobytes()
        short, high = (lengths > 0) & (lengths <= TOGETHER), 0
        while high <= TOGETHER:  # trees of one height together
            low, high = high, max(1, 2 * high)
            group = np.flatnonzero(short & (lengths > low) & (lengths <= high))
            for at in range(0, len(group), ROWS):
                some = group[at : at + ROWS]
                size = lengths[some]
                within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                ids, counts = merge_rows(flat[np.repeat(starts[some], size) + within], size, self.merges)
                packed, ends = ids.tobytes(), (4 * np.cumsum(counts)).tolist()
                known.update(zip([new[k] for k in some.tolist()], [packed[a:b] for a, b in zip([0, *ends], ends)]))

    def decode(self, ids) -> str:
        """The library's text of the ids, special tokens included."""
        tokens = [self.token[i] for i in ids]
        return self.library.decoder.decode(tokens) if self.library.decoder else " ".join(tokens)

    def decoded(self, ids: pa.ListArray) -> pa.Array:
        """The library's texts of lists of ids."""
        if self.library.decoder:  # may look across pieces
            return pa.array([self.decode(x) for x in ids.to_pylist()], pa.string())
        tokens = pa.ListArray.from_arrays(ids.offsets, self.tokens.take(ids.values))
        return pc.binary_join(tokens, pa.scalar(" ", pa.large_string())).cast(pa.string())

    def ids(self, batch: list[str]) -> pa.ListArray:
        """The ids of each text."""
        self.memory.turn()
        parted = [self.parted(t) for t in batch]
        new = self.memory.missing(set().union(*parted))
        units = [u for u in new if isinstance(u, bytes)]
        if units:
            cuts = [self.cut(u) for u in units]
            more = {p for some in cuts for p in some if isinstance(p, str)}.difference(new)
            new = [p for p in new if isinstance(p, str)] + self.memory.missing(more)
        self.learn(new)
        known = self.memory.new
        if units:
            known.update((u, b"".join(np.int32(p).tobytes() if isinstance(p, int) else known[p] for p in some)) for u, some in zip(units, cuts))
        packed = [b"".join(map(known.__getitem__, some)) for some in parted]
        self.memory.forget(new + units)
        offsets = np.cumsum([0, *(len(x) // 4 for x in packed)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), np.int32)))

    def encode(self, batch: list[str]) -> tuple[list[bytes], list[str]]:
        """(ids as 32-bit numbers side by side, decoded text) of each text."""
        ids = self.ids(batch)
        return [np.array(x, np.int32).tobytes() for x in ids.to_pylist()], self.decoded(ids).to_pylist()


def _encoder(path: str) -> Encoder:
    if _WORKER.get("path") != path:
        _WORKER.update(path=path, encoder=Encoder(path))
    return _WORKER["encoder"]


def _run(path: str, text_name: str):
    def run(batches):
        for b in batches:
            encoder = _encoder(path)
            kept = [i for i, n in enumerate(b.schema.names) if n != text_name]
            for at in range(0, b.num_rows, STEP):
                some = b.slice(at, STEP)
                ids = encoder.ids(texts(some.column(text_name)))
                yield pa.RecordBatch.from_arrays([*[some.column(i) for i in kept], ids, encoder.decoded(ids)], [*[b.schema.names[i] for i in kept], "ids", "decoded"])

    return run


def encode_documents(spark: SparkSession, docs: DataFrame, tokenizer_path: str, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with the text's ``ids`` (array<int>) and their ``decoded`` text."""
    (text,) = fresh(docs, "__text")
    kept = [c for c in docs.columns if c != text_col and c.lower() not in ("ids", "decoded")]
    asked = docs.select(*kept, F.coalesce(F.col(text_col), F.lit("")).alias(text))
    schema = T.StructType([
        *[T.StructField(f.name, f.dataType, True) for f in asked.schema.fields if f.name != text],
        T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType()),
    ])
    return asked.mapInArrow(_run(tokenizer_path, text), schema)
