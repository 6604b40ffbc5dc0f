"""Elements of large JSON documents, read by byte ranges.

A payload that is one JSON document cannot be cut at line ends. It is read as
text that ends at ``}`` instead, which Spark splits by byte ranges like any text
file. A ``}`` inside a string ends a fragment too, so a scanner carries what a
range cannot know by itself from range to range: whether a string is open, and
which containers are (their keys). A first pass gives, per range, whether it
turns the string state and how it changes the containers; these summaries (one
row per range) compose from the start of a file, and a second pass cuts each
range into elements from its own starting state. An element that crosses ranges
leaves a piece in each, joined by its first position.

Only Arrow batches and the element at hand are held in memory.
"""

from __future__ import annotations

import itertools
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A string (its content), a container's start or end, or a comma.
_TOKEN = re.compile(r'"((?:[^"\\]|\\.)*)"|[\[\]{},]', re.S)
_QUOTE = re.compile(r'\\.|"', re.S)

RANGES = "file string, size long, start long, bytes long, odd boolean, closes int, opens array<string>, deepest int, head string, closed boolean, own boolean"
PIECES = "file string, start long, place long, keys array<string>, text string, piece string"
#: Pieces of an element: all of it, its start, a range within it, its end.
WHOLE, FIRST, MIDDLE, LAST = "whole", "first", "middle", "last"


def fragments(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, its size, start of the byte range, fragment, its bytes) in file order within a range; a fragment lacks the
    brace that ends it (the last of a file may have none)."""
    text = spark.read.option("lineSep", "}").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("start"),
        F.col("value").alias("fragment"), F.octet_length("value").alias("bytes"),
    )


def odd_quotes(text: str) -> bool:
    """Whether the text turns the string state: an odd number of quotes that no backslash escapes."""
    if "\\" not in text:
        return text.count('"') % 2 == 1
    return sum(t == '"' for t in _QUOTE.findall(text)) % 2 == 1


def _joined(rows, inside: bool, tail: str | None, brace: bool):
    """A range's fragments with their braces, those that end inside a string joined to the next.

    ``inside``: the rest of a string that began before the range is left out (it
    belongs to the range before, as its ``tail``). ``brace``: whether the last
    fragment has one.
    """
    held, odd = [], False
    fragment = next(rows, None)
    while fragment is not None:
        after = next(rows, None)
        text = fragment + "}" if brace or after is not None else fragment
        fragment = after
        turned = odd_quotes(text)
        if inside:
            inside = not turned
            continue
        held.append(text)
        odd ^= turned
        if not odd:
            yield held[0] if len(held) == 1 else "".join(held)
            held = []
    if held:
        yield "".join([*held, tail or ""])


def _by_range(batches):
    """(file, size, start, fragments as (text, bytes)) of the ranges that a task reads one after the other."""
    names = ("file", "size", "start", "fragment", "bytes")
    rows = (r for b in batches for r in zip(*(b.column(n).to_pylist() for n in names)))
    for key, own in itertools.groupby(rows, key=lambda r: r[:3]):
        yield *key, ((r[3], r[4]) for r in own)


def _batch(schema: str, types: list, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [c.split()[0] for c in schema.split(", ")])


def _read_key(key: str | None) -> str | None:
    return json.loads(f'"{key}"', strict=False) if key and "\\" in key else key


def _summaries(cut: dict, heads: set):
    """Per range: its bytes, whether its quotes are odd, the containers it closes and leaves open before its last brace,
    how deep it gets (above its start), and, if asked for, the rest of the string that it begins in and whether that ends."""
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.list_(pa.string()), pa.int32(), pa.string(), pa.bool_(), pa.bool_()]

    def run(batches):
        for file, size, start, rows in _by_range(batches):
            inside, tail = cut.get((file, start), (False, None))
            odd, head, searching, total = False, [], (file, start) in heads, 0

            def watched():
                nonlocal odd, searching, total
                for t, n in rows:
                    total += n + 1
                    turned = odd_quotes(t)
                    if searching:  # what belongs to the range in which the string began
                        head.append(t + "}")
                        searching = not turned
                    odd ^= turned
                    yield t

            keys: list = []
            closes = deepest = 0
            own = False
            for text in _joined(watched(), inside, tail, False):
                own, key = True, None
                for m in _TOKEN.finditer(text):
                    token = m.group()
                    if token in "{[":
                        keys.append(key)
                        deepest = max(deepest, len(keys) - closes)
                    elif token in "}]":
                        if keys:
                            keys.pop()
                        else:
                            closes += 1
                    key = m.group(1)
            yield _batch(RANGES, types, [(file, size, start, total, odd, closes, keys, deepest, "".join(head), not searching, own)])

    return run


def _elements(level: int, starts: dict, cut: dict, step: int = 2000):
    """The pieces of the elements at ``level``: objects opened when so many containers are open."""
    types = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.string(), pa.string()]

    def run(batches):
        out: list[tuple] = []
        for file, _, start, rows in _by_range(batches):
            if (file, start) not in starts:
                raise RuntimeError("the payload's byte ranges changed between two passes")
            keys, begin, brace = starts[file, start]
            keys = list(keys)
            element: list[str] | None = [] if len(keys) > level else None
            here, path, place = element is None, None, 0
            inside, tail = cut.get((file, start), (False, None))
            for text in _joined((t for t, _ in rows), inside, tail, brace):
                at, key = 0, None
                for m in _TOKEN.finditer(text):
                    token = m.group()
                    if token in "{[":
                        if element is None and token == "{" and len(keys) == level:
                            element, at, here, path = [], m.start(), True, [_read_key(k) for k in (*keys[1:], key)]
                        keys.append(key)
                    elif token in "}]":
                        if keys:
                            keys.pop()
                        if element is not None and len(keys) == level:
                            element.append(text[at : m.end()])
                            out.append((file, start if here else begin, place, path, "".join(element), WHOLE if here else LAST))
                            element, path, place = None, None, place + 1
                    key = m.group(1)
                if element is not None:
                    element.append(text[at:])
                if len(out) >= step:
                    yield _batch(PIECES, types, out)
                    out = []
            if element is not None:
                out.append((file, start if here else begin, place if here else start, path, "".join(element), FIRST if here else MIDDLE))
        if out:
            yield _batch(PIECES, types, out)

    return run


class Ranges:
    """The byte ranges of a payload in order, with the containers open at the start of each."""

    def __init__(self, spark: SparkSession, path: str | list[str]):
        self.spark, self.path = spark, path
        self.cut: dict = {}
        rows = self._summary()
        if inside := _begun_in_string(rows):  # a brace in a string ends a range: very rare
            order = [(r["file"], r["start"]) for r in rows]
            heads = {(r["file"], r["start"]): r for r in self._summary(inside)}
            # the range in which the string began gets the rest of it, through as many ranges as it goes
            rest: dict = {}
            for before, k in zip(order, order[1:]):
                if k in inside:
                    owner = before if before not in inside or heads[before]["closed"] else owner
                    rest.setdefault(owner, []).append(heads[k]["head"])
            self.cut = {k: (k in inside, "".join(rest[k]) if k in rest else None) for k in [*inside, *rest]}
            rows = self._summary()
        # the last brace of a range closes a container unless it is text or belongs to the range before
        self.loose = {(r["file"], r["start"]) for r in rows if not r["own"] or r["odd"] != ((r["file"], r["start"]) in inside)}
        last = {r["file"]: r["start"] for r in rows}
        read = dict.fromkeys(last, 0)
        for r in rows:
            read[r["file"]] += r["bytes"]
        # every fragment but a file's last ends at a brace; the last does if the bytes add up
        bare = {(r["file"], r["start"]) for r in rows if r["start"] == last[r["file"]] and read[r["file"]] > r["size"]}
        self.rows = [(r["file"], r["start"], r["closes"], r["opens"], r["deepest"], (r["file"], r["start"]) not in bare) for r in rows]
        self.states: dict = {}  # (file, start) -> keys of the containers open there
        self.depth: dict[str, int] = {}  # how deep a file gets
        self.unfinished: dict[str, int] = {}  # containers that a file leaves open
        after: dict[str, list] = {}
        for file, start, closes, opens, deepest, brace in self.rows:
            keys = self.states[file, start] = after.get(file, [])
            self.depth[file] = max(self.depth.get(file, 0), len(keys) + deepest)
            left = [*keys[: max(0, len(keys) - closes)], *opens]
            after = {file: left[:-1] if brace and not self._loose(file, start) else left}
            self.unfinished[file] = len(after[file])

    def _summary(self, heads: set = frozenset()) -> list:
        """One row per byte range, in order (their number is the payload's size over that of a range)."""
        found = fragments(self.spark, self.path).mapInArrow(_summaries(self.cut, heads), RANGES)
        return sorted(found.collect(), key=lambda r: (r["file"], r["start"]))

    def _loose(self, file: str, start: int) -> bool:
        return (file, start) in self.loose

    def files_without(self, level: int) -> list[str]:
        """The files that never get as deep as an element of ``level``."""
        return [f for f, d in self.depth.items() if d <= level]

    def unfinished_outside(self, level: int) -> list[str]:
        """The files that end with open containers, but not within an element."""
        return [f for f, n in self.unfinished.items() if 0 < n <= level and self.depth[f] > level]

    def elements(self, level: int) -> DataFrame:
        """(file, start, place, keys, text) of every object that is opened while ``level`` containers are open.

        ``keys``: those of the containers from the second on, then the element's
        own; a member of an array has null. ``start`` and
        ``place`` order the elements of a file. An element that never ends is
        given as far as it goes.
        """
        starts, file, begin = {}, None, None
        for f, start, closes, opens, _, brace in self.rows:
            keys = self.states[f, start]
            if f != file:
                file, before = f, None
            if len(keys) <= level:
                begin = None
            elif begin is None or before is None:
                begin = before
            starts[f, start] = keys, begin, brace
            # the element open at the start goes on through the range, or ends in it and another may begin
            ends = len(keys) - closes <= level or len(keys) - closes == level + 1 and not opens and brace and not self._loose(f, start)
            if len(keys) <= level or ends:
                begin = None
            before = start
        pieces = fragments(self.spark, self.path).mapInArrow(_elements(level, starts, self.cut), PIECES)
        # an element that crosses ranges has a piece in each, all under the range in which it begins
        crossing = pieces.filter(F.col("piece") != WHOLE).withColumn(
            "at", F.when(F.col("piece") == FIRST, F.lit(-1)).when(F.col("piece") == LAST, F.lit(1 << 62)).otherwise(F.col("place")).cast("long")
        )
        joined = crossing.groupBy("file", "start").agg(
            F.max(F.when(F.col("piece") == FIRST, F.col("place"))).alias("place"), F.max(F.when(F.col("piece") == FIRST, F.col("keys"))).alias("keys"),
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda x: x["text"]), "").alias("text"),
        )
        return pieces.filter(F.col("piece") == WHOLE).drop("piece").unionByName(joined)


def _begun_in_string(rows) -> set:
    """The ranges with an odd number of quotes before them in their file."""
    out, file, odd = set(), None, False
    for r in rows:
        if r["file"] != file:
            file, odd = r["file"], False
        if odd:
            out.add((r["file"], r["start"]))
        odd ^= r["odd"]
    return out
