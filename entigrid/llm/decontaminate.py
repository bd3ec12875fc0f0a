"""Benchmark decontamination with a generalised suffix automaton of the test items.

A-Z is lower-cased and words are runs of characters other than \\x00-\\x2F, \\x3A-\\x60 and
\\x7B-\\x7F. An item's windows are its runs of ``window`` words, or the whole item if it is
shorter. The automaton of all items reads each document word by word and knows after each the
longest run of words ending there that some item has; a window ends where this run is long enough
(for short items: where it ends in the whole item). Words inside a window are hit.

The items are read in blocks of at most ``block_words`` words (an item larger than that is a block
of its own), one automaton and one pass over the documents for each block, so what a task holds is
bounded. Defined results: null texts have no words; items without words and items that repeat
change nothing; an item whose id is null counts under the id ''; rows that repeat a doc_id are rows
of their own.
"""

from __future__ import annotations

import hashlib
import pickle
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from entigrid.llm.common import free_name, kept_by_worker, stored

WINDOW = 10
BLOCK_WORDS = 200_000
# Documents of which more than this share of words is hit are dropped; in others the spans are cut.
COVERAGE = 0.5

_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def normalised(text: str | None) -> bytes:
    """The text's UTF-8 bytes, lower-cased, with a space for every byte between words."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE)


class ItemAutomaton:
    """Suffix automaton over the word numbers of all items of a block."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        self.window = window
        self.words: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        # items by the state of a window, with the window's length
        self.ends: dict[int, dict[int, set[str]]] = {}
        rows = [(key, [self.words.setdefault(w, len(self.words)) for w in normalised(text).split(b" ") if w]) for key, text in items]
        for _, row in rows:
            self._add(row)
        for key, row in rows:
            if row:
                self._mark(key, row)
        self.found = self._all_ends()

    def _add(self, row: list[int]) -> None:
        last = 0
        for word in row:
            last = self._extend(last, word)

    def _state(self, length: int, link: int, arrows: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(arrows)
        return len(self.length) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p != -1 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word: int) -> int:
        q = self.next[last].get(word)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, word, q)
        new, p = self._state(self.length[last] + 1, 0, {}), last
        while p != -1 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p != -1:
            q = self.next[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
        return new

    def _mark(self, key: str, row: list[int]) -> None:
        """Note the item at the states that hold its windows."""
        size = min(self.window, len(row))
        state = length = 0
        for word in row:
            state, length = self._step(state, length, word)
            if length >= size:
                at = state
                while self.length[self.link[at]] >= size:
                    at = self.link[at]
                self.ends.setdefault(at, {}).setdefault(size, set()).add(key)

    def _step(self, state: int, length: int, word: int) -> tuple[int, int]:
        while state and word not in self.next[state]:
            state = self.link[state]
            length = self.length[state]
        to = self.next[state].get(word)
        return (0, 0) if to is None else (to, length + 1)

    def _all_ends(self) -> list[list[tuple[int, list[str]]]]:
        """For each state the windows that end with it: its own and those of its suffixes."""
        found: list[list[tuple[int, list[str]]]] = [[] for _ in self.length]
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__):
            own = sorted((size, sorted(keys)) for size, keys in self.ends.get(state, {}).items())
            found[state] = found[self.link[state]] + own if own else found[self.link[state]]
        return found

    def read(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """The hit spans (first word, end) in order, apart from each other, and the items found."""
        number, arrows, link, lengths, found = self.words.get, self.next, self.link, self.length, self.found
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        state = length = 0
        for at, word in enumerate(map(number, words)):
            if word is None:
                state = length = 0
                continue
            while state and word not in arrows[state]:
                state = link[state]
                length = lengths[state]
            state = arrows[state].get(word, 0)
            if not state:
                length = 0
                continue
            length += 1
            if found[state]:
                longest = 0
                for size, keys in found[state]:
                    if size <= length:
                        longest = max(longest, size)
                        items.update(keys)
                if longest:
                    first, end = at + 1 - longest, at + 1
                    while spans and spans[-1][1] >= first:
                        first = min(first, spans.pop()[0])
                    spans.append((first, end))
        return spans, items


def _blocks(items: DataFrame, block_words: int) -> Iterator[list[tuple[str, str | None]]]:
    """The items in blocks of a bounded number of words; blocks are read one at a time."""
    sized = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    # separators only make words shorter, so half the bytes bound the words
    sized = stored(sized.distinct().withColumn("words", F.expr("1 + octet_length(coalesce(text, '')) DIV 2")), "items")
    count = -(-(sized.agg(F.sum("words")).first()[0] or 0) // block_words)
    if count <= 1:
        yield [tuple(r) for r in sized.select("item_id", "text").collect()]
        return
    # by hash, so blocks are even; each is cut again where it is over the bound
    parts = 2 * count
    for b in range(parts):
        block, size = [], 0
        rows = sized.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == b)
        for row in rows.toLocalIterator():
            if block and size + row.words > block_words:
                yield block
                block, size = [], 0
            block.append((row.item_id, row.text))
            size += row.words
        if block:
            yield block


def _loaded(key: str, data: bytes) -> ItemAutomaton:
    return kept_by_worker("decontaminate", key, lambda: pickle.loads(data))


def _held(spark: SparkSession, items: list[tuple[str, str | None]], window: int) -> Broadcast:
    """One block's automaton on every executor; its size is bounded by the block's words."""
    data = pickle.dumps(ItemAutomaton(items, window))
    return spark.sparkContext.broadcast((hashlib.sha256(data).hexdigest(), data))


_HITS = "n_words long, spans array<int>, items array<string>"


def _marker(held: Broadcast) -> Callable[[Column, Column], Column]:
    """The hits of a text by one block, joined with those of the blocks before it."""

    @F.pandas_udf(_HITS)
    def mark(texts: pd.Series, before: pd.DataFrame) -> pd.DataFrame:
        automaton = _loaded(*held.value)
        rows = []
        for text, spans, items in zip(texts, before["spans"], before["items"]):
            words = normalised(text).split()
            hit, keys = automaton.read(words)
            if len(spans):
                hit = _joined([*hit, *zip(spans[::2], spans[1::2])])
            rows.append((len(words), [int(x) for span in hit for x in span], sorted(keys.union(items))))
        return pd.DataFrame(rows, columns=["n_words", "spans", "items"])

    return mark


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, end in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out


def with_hits(docs: DataFrame, items: DataFrame, hits: str, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents with a struct column ``hits``: n_words, spans (first word and end of each
    stretch of hit words, in order), items (ids of the items whose windows the text has)."""
    nothing = F.from_json(F.lit('{"n_words": 0, "spans": [], "items": []}'), _HITS)
    out, blocks = None, _blocks(items, block_words)
    for block in blocks:
        before = docs.withColumn(hits, nothing) if out is None else stored(out, "hits")
        held = _held(docs.sparkSession, block, window)
        out = before.withColumn(hits, _marker(held)(F.col("text"), F.col(hits)))
    return out


def _cutter(held: Broadcast) -> Callable[[Column], Column]:
    @F.pandas_udf("string")
    def cut(texts: pd.Series) -> pd.Series:
        automaton = _loaded(*held.value)
        return texts.map(lambda text: _without_hits(text, automaton))

    return cut


def _without_hits(text: str | None, automaton: ItemAutomaton) -> str | None:
    """The text without its hit spans; what then meets is read again until nothing is hit."""
    while spans := automaton.read(normalised(text).split())[0]:
        places = [m.span() for m in _WORD.finditer(text)]
        kept, at = [], 0
        for first, end in spans:
            kept.append(text[at : places[first][0]])
            at = places[end - 1][1]
        text = "".join([*kept, text[at:]])
    return text


_WORD = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")


def n_hit(hits: str) -> Column:
    return F.expr(f"aggregate(transform(`{hits}`.spans, (x, i) -> IF(i % 2 = 0, -x, x)), 0L, (s, x) -> s + x)")


def decontaminated(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, coverage: float = COVERAGE, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """The documents, same columns: hit spans are cut out of the text (and ``n_chars``, where there
    is such a column, counted again); documents with more than ``coverage`` of their words hit go.
    Documents without a hit stay as they are."""
    hits = free_name(docs, "hits")
    kept = stored(with_hits(docs, items, hits, window, block_words), "hits")
    kept = kept.filter(n_hit(hits) <= F.col(f"`{hits}`.n_words") * F.lit(coverage))
    was = kept.filter(F.size(F.col(f"`{hits}`.spans")) > 0).drop(hits)
    clean = kept.filter(F.size(F.col(f"`{hits}`.spans")) == 0).drop(hits)
    # what meets after a cut can be a window of another block, so blocks take turns until none cuts
    while True:
        changed, blocks = was, 0
        for block in _blocks(items, block_words):
            changed = changed.withColumn("text", _cutter(_held(docs.sparkSession, block, window))(F.col("text")))
            blocks += 1
        if blocks <= 1:
            break
        was = stored(changed, "cut")
        if with_hits(was, items, hits, window, block_words).filter(F.size(F.col(f"`{hits}`.spans")) > 0).isEmpty():
            changed = was
            break
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.unionByName(changed)
