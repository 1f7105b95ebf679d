"""Benchmark decontamination by pigeonhole edit matching.

An item may occur in a document with up to `budget` edits. Cut into budget + 1 pieces, at least one piece of such an
occurrence is untouched, so exact hits of pieces find every candidate place; Myers' bit-parallel distance then decides
over the place's surroundings. The same count holds for any run of pieces (n pieces, at most n - 1 edits, or the other
pieces have an untouched one of their own), so a hit is verified over two pieces, four pieces and so on before the
whole item. Items are searched in blocks of bounded size against all documents.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm import words

LEAKS = "doc_id long, item_id long, distance int, start long, end long"
_BATCH_BYTES = 4 << 20


def normal(text: str) -> str:
    """Lower case, white space runs as one space, trimmed."""
    return " ".join(text.lower().split())


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """budget + 1 pieces of near equal length, with their offsets."""
    n = budget + 1
    cuts = [i * len(item) // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Pattern:
    """An item prepared for Myers' algorithm."""

    def __init__(self, item: str):
        self.size = len(item)
        self.masks: dict[str, int] = defaultdict(int)
        for i, c in enumerate(item):
            self.masks[c] |= 1 << i

    def best(self, text: str, budget: int) -> tuple[int, int] | None:
        """Least distance of the item to any substring of text and where that ends, if within the budget.

        The last of equally good ends is returned. Distances of all substrings that end at a character follow from one
        step on bit vectors as long as the item.
        """
        masks, high = self.masks, 1 << (self.size - 1)
        full = (high << 1) - 1
        up, down, score, best, end = full, 0, self.size, budget + 1, -1
        for at, c in enumerate(text):
            eq = masks.get(c, 0)
            cross = eq | down
            diag = (((eq & up) + up) ^ up) | eq
            plus = down | (full & ~(diag | up))
            minus = up & diag
            if plus & high:
                score += 1
            elif minus & high:
                score -= 1
            plus = (plus << 1) & full
            minus = (minus << 1) & full
            up = minus | (full & ~(cross | plus))
            down = plus & cross
            if score <= best and score <= budget:
                best, end = score, at + 1
        return (best, end) if end >= 0 else None


class Item:
    """An item with its pieces, and patterns of the runs of 2, 4, ... pieces over each of them."""

    def __init__(self, item_id: int, text: str, rate: float):
        self.id, self.text, self.budget = item_id, text, int(len(text) * rate)
        self.pieces = pieces(text, self.budget) if text else []
        self.whole = Pattern(text)
        self.runs: dict[tuple[int, int], tuple[int, int, Pattern]] = {}

    def run(self, level: int, nth: int) -> tuple[int, int, Pattern]:
        """Offset, budget and pattern of the nth run of 2^level pieces."""
        if (level, nth) not in self.runs:
            part = self.pieces[nth << level : (nth + 1) << level]
            self.runs[level, nth] = part[0][0], len(part) - 1, Pattern("".join(p for _, p in part))
        return self.runs[level, nth]

    def plausible(self, text: str, piece: int, at: int) -> bool:
        """Whether a hit of a piece at that place holds over all runs of pieces around it, short of the whole."""
        for level in range(1, len(self.pieces).bit_length()):
            if 1 << level >= len(self.pieces):
                return True
            offset, budget, pattern = self.run(level, piece >> level)
            begin = at - (self.pieces[piece][0] - offset) - budget
            if not pattern.best(text[max(0, begin) : begin + pattern.size + 2 * budget], budget):
                return False
        return True


class Matcher:
    """All items of a block: one automaton over their pieces."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        import ahocorasick

        self.items = [Item(i, normal(t), rate) for i, t in items]
        places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for k, item in enumerate(self.items):
            for j, (_, piece) in enumerate(item.pieces):
                places[piece].append((k, j))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.empty = not places
        if places:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item_id, distance, start, end) of the best occurrence of every item that the normal text holds.

        start is the earliest place at which the occurrence can begin, given its end and distance.
        """
        if self.empty:
            return []
        spots: dict[int, list[int]] = defaultdict(list)
        for last, (size, where) in self.automaton.iter(text):
            at = last + 1 - size
            for k, j in where:
                if self.items[k].plausible(text, j, at):
                    spots[k].append(at - self.items[k].pieces[j][0])
        out = []
        for k, begins in spots.items():
            item = self.items[k]
            size, budget, found, lo, hi = item.whole.size, item.budget, None, None, None
            for b in [*sorted(begins), None]:
                if b is not None and hi is not None and b - budget <= hi:
                    hi = b + size + budget
                    continue
                if hi is not None:
                    got = item.whole.best(text[lo:hi], budget)
                    if got and (found is None or got[0] < found[0]):
                        found = (got[0], lo + got[1])
                if b is not None:
                    lo, hi = max(0, b - budget), b + size + budget
            if found:
                distance, end = found
                out.append((item.id, distance, max(0, end - size - distance), end))
        return out


def leaks(docs: DataFrame, items: DataFrame, rate: float = 0.1, block_bytes: int = 1 << 20) -> DataFrame:
    """One row per document and benchmark item that occurs in it: doc_id, item_id, distance, start, end.

    docs has doc_id and text, items item_id and text; other columns are ignored. Both texts are compared in lower case with
    single spaces; start and end are places in that form. An item of n characters may differ by rate * n edits. The whole
    text is searched. Null and empty texts hold nothing, null and blank items occur nowhere; equal items are all
    reported; repeated documents give repeated rows. Items go to the tasks in broadcast blocks of about block_bytes (the
    size is summed first, so each broadcast is bounded), each block one pass over the documents. All blocks pass through
    the driver, and a benchmark of many blocks costs as many passes: this suits benchmarks of megabytes, not gigabytes.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = [source.mapInArrow(_search(block, rate), LEAKS) for block in _blocks(items, block_bytes)]
    return reduce(DataFrame.unionByName, found)


def _blocks(items: DataFrame, block_bytes: int) -> list:
    """Broadcast lists of (item_id, text), together all items that are not blank; one empty list if there are none."""
    context = items.sparkSession.sparkContext
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.length(F.trim("text")) > 0)
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-size // block_bytes))
    parts = (items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k).collect() for k in range(count))
    return [context.broadcast(sorted(((r.item_id, r.text) for r in part), key=str)) for part in parts]


def _search(block, rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(block.value, rate)
        for batch in words.gathered(batches, _BATCH_BYTES):
            rows = [
                (doc, *hit)
                for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True)
                if text
                for hit in matcher.find(normal(text))
            ]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [x.split()[0] for x in LEAKS.split(", ")]
            )

    return run


def decontaminate(docs: DataFrame, items: DataFrame, rate: float = 0.1, block_bytes: int = 1 << 20) -> DataFrame:
    """The rows of docs, all columns, whose text holds no item; rows are judged one by one, whatever their ids."""
    for block in _blocks(items, block_bytes):
        docs = docs.mapInArrow(_without(block, rate), docs.schema)
    return docs


def _without(block, rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(block.value, rate)
        for batch in batches:
            clean = [not text or not matcher.find(normal(text)) for text in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return run
