"""Token ids of whole texts, by a public byte-level BPE vocabulary and the tokenizers library.

A byte-level BPE never merges over a space that is followed by a visible character, nor over a
line end between two of them, so a text is cut there and the ids of a piece are remembered. Texts
are cut, and their different pieces told, in Arrow; each is looked up once for a batch. The words
that a batch brings for the first time go through the library in few calls: words of letters, which
its own cutting leaves whole, straight to its model, some in a line, the others through all of it.
"""

from __future__ import annotations

import codecs
import gc
import os
import re
import string
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, compress, islice
from operator import attrgetter, not_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from entigrid.llm.common import give_back, kept_by_worker

END_ID = 2
VOCABULARY = "byte_bpe_50k.json"
MEMORY_PIECES = 200_000
ENCODED_BYTES = 6 << 20
# Words in one call of the library, which takes some hundred bytes for each while it works.
LEARNED_AT_ONCE = 8_192
# Words in one line for the model: a call for each costs more, and so does finding merges in a long one.
WORDS_A_LINE = 32

# Blanks that the library may take together (RE2): such texts are only cut where it surely doesn't.
_BLANK = r"\s\pZ\x0b\x1c-\x1f\x{85}"
_BLANK_RUN = rf"[ \n][{_BLANK}]| $|[{_BLANK}]\n"
_CUT = re.compile(r" (?=\S)")
_MARKS, _MARKS_KEPT = string.punctuation, 10_000
_ID = attrgetter("id")


def _byte_letters() -> str:
    """What a byte-level BPE writes for each byte: printable ones stay, the others go from U+0100 on."""
    kept = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    moved = iter(range(0x100, 0x200))
    return "".join(chr(b if b in kept else next(moved)) for b in range(0x100))


_BYTES = _byte_letters()


def _byte_level(text: str) -> str:
    return codecs.charmap_decode(text.encode(), "strict", _BYTES)[0]


class TextEncoder:
    """Ids without special tokens, as little-endian unsigned 32-bit bytes.

    A worker remembers the ``memory_pieces`` pieces that it met last, in Arrow: those of the last
    call first, then those of the calls before. Null counts as the empty text.
    """

    def __init__(self, vocabulary: str = VOCABULARY, memory_pieces: int = MEMORY_PIECES):
        # one core per task: Spark runs as many tasks as there are cores
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer, models

        self._tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        self._model = model = self._tokenizer.model
        self._cutting = self._tokenizer.pre_tokenizer
        # whether a word's ids hang on its own merges alone
        self._merges = isinstance(model, models.BPE) and self._cutting is not None and self._tokenizer.normalizer is None and not (
            model.ignore_merges or model.dropout or model.continuing_subword_prefix or model.end_of_word_suffix
        )
        # characters that the library takes for letters, and others that Python does
        self._letters: set[str] = set()
        self._strange: set[str] = set()
        self._memory_pieces = memory_pieces
        self._known, self._known_ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        vocab = self._tokenizer.get_vocab()
        self._opens = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self._opens[[i for token, i in vocab.items() if token.startswith("Ġ")]] = True
        self._special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._marks = {"": b""}
        self._line_end = self._direct("\n")

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        collecting = gc.isenabled()
        gc.disable()  # nothing below makes cycles, and millions of small objects are alive
        try:
            return self._encode([text or "" for text in texts])
        finally:
            if collecting:
                gc.enable()
            give_back()

    def _encode(self, texts: list[str]) -> list[bytes]:
        column = pa.array(texts, pa.large_string())
        blanks = pc.match_substring_regex(column, _BLANK_RUN)
        odd = [run or self._is_whole(text) for run, text in zip(blanks.to_pylist(), texts)]
        plain = iter(self._encode_plain(column.filter(pc.invert(pa.array(odd, pa.bool_())))))
        cut = [self._pieces(text) for text in compress(texts, odd)]
        pieces = list(dict.fromkeys(piece for own in cut for piece in own))
        ids = dict(zip(pieces, self._ids(pa.array(pieces, pa.large_string())).to_pylist()))
        others = iter(cut)
        return [b"".join(map(ids.__getitem__, next(others))) if apart else next(plain) for apart in odd]

    def _encode_plain(self, column: pa.LargeStringArray) -> list[bytes]:
        if not len(column):
            return []
        cut = pc.split_pattern(pc.replace_substring(column, "\n", " \n"), " ")
        starts = cut.offsets.to_numpy()
        coded = cut.values.dictionary_encode()
        place, words = coded.indices.to_numpy().copy(), coded.dictionary
        # a text's first piece has no space before it, nor has one after a line end
        lined = pc.starts_with(words, "\n")
        rest = pa.concat_arrays([pc.if_else(lined, pc.utf8_slice_codeunits(words, 1), words), cut.values.take(pa.array(starts[:-1]))])
        place[starts[:-1]] = np.arange(len(words), len(rest))
        bare = np.concatenate([lined.to_numpy(zero_copy_only=False), np.ones(len(rest) - len(words), dtype=bool)])
        # letters and the marks after them are never merged
        stem = pc.utf8_rtrim(rest, characters=_MARKS)
        stem = pc.if_else(pc.utf8_is_alpha(stem), stem, rest)
        lead = pc.if_else(pa.array(bare), "\0", "").cast(pa.large_string())
        keys = pc.binary_join_element_wise(lead, stem, pa.scalar("", pa.large_string())).dictionary_encode()
        ids = self._ids(keys.dictionary).take(keys.indices)
        marked = np.flatnonzero(pc.not_equal(pc.binary_length(rest), pc.binary_length(stem)).to_numpy(zero_copy_only=False))
        which = np.zeros(len(rest), dtype=np.int64)
        ends = [a[len(b) :] for a, b in zip(_strings(rest.take(pa.array(marked))), _strings(stem.take(pa.array(marked))))]
        marks = {end: i for i, end in enumerate(dict.fromkeys(["", *ends]))}
        which[marked] = list(map(marks.__getitem__, ends))
        before = pa.array([b"", self._line_end], pa.large_binary()).take(lined.cast(pa.int8()))
        before = pa.concat_arrays([before, pa.array([b""] * (len(rest) - len(words)), pa.large_binary())])
        after = pa.array(list(map(self._marked, marks)), pa.large_binary()).take(pa.array(which))
        flat = pc.binary_join_element_wise(before, ids, after, pa.scalar(b"", pa.large_binary())).take(pa.array(place))
        bounds = np.frombuffer(flat.buffers()[1], dtype=np.int64)[starts + flat.offset].tolist()
        raw = memoryview(flat.buffers()[2] or b"")
        return [raw[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]

    def _ids(self, keys: pa.LargeStringArray) -> pa.LargeBinaryArray:
        """The ids of different keys: pieces with a space before them, or after a NUL without it."""
        place = pc.index_in(keys, value_set=self._known)
        new = pc.is_null(place)
        learned = self._learn(_strings(keys.filter(new)))
        place, new = place.fill_null(0).to_numpy().astype(np.int64), new.to_numpy(zero_copy_only=False)
        unmet = np.ones(len(self._known), dtype=bool)
        unmet[place[~new]] = False
        place[new] = len(self._known) + np.arange(len(learned))
        found = pa.concat_arrays([self._known_ids, learned]).take(pa.array(place))
        kept = pa.array(np.flatnonzero(unmet)[: max(0, self._memory_pieces - len(keys))])
        now = slice(0, self._memory_pieces)
        self._known = pa.concat_arrays([keys[now], self._known.take(kept)])
        self._known_ids = pa.concat_arrays([found[now], self._known_ids.take(kept)])
        return found

    def _direct(self, text: str) -> bytes:
        ids = self._tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def _is_whole(self, text: str) -> bool:
        return "\0" in text or any(s in text for s in self._special)

    def _pieces(self, text: str) -> list[str]:
        """The keys of an odd text's pieces, the first of which has no space before it."""
        if self._is_whole(text):
            return ["\0" + text]
        pieces = _CUT.split(text)
        pieces[0] = "\0" + pieces[0]
        return pieces

    def _learn(self, keys: list[str]) -> pa.LargeBinaryArray:
        letters, others, bare, direct = [], [], [], []
        for i, (key, alone) in enumerate(zip(keys, map(str.isalpha, keys))):
            if alone:
                letters.append(i)
            elif key[:1] == "\0" and key[1:].isalpha():
                bare.append(i)
            elif key[:1] == "\0" or not key or " " in key or key[0].isspace():
                direct.append(i)
            else:
                others.append(i)
        ids = [self._direct(key[1:] if key[:1] == "\0" or not key else " " + key) for key in map(keys.__getitem__, direct)]
        places, found = direct, [pa.array(ids, pa.large_binary())]
        for own, before, rest in ((letters, " ", others), (bare, "\n", [])):
            whole, cut = self._whole_words(keys, own)
            for at, ids_of in ((whole, self._merged), (cut + rest, self._joined)):
                places = places + at
                found += self._learned([keys[i] for i in at], before, ids_of)
        order = np.empty(len(keys), dtype=np.int64)
        order[places] = np.arange(len(keys))
        return pa.concat_arrays(found).take(pa.array(order))

    def _whole_words(self, keys: list[str], own: list[int]) -> tuple[list[int], list[int]]:
        """Places of words of what the library takes for letters too, which it leaves whole, and of the rest."""
        if not self._merges:
            return [], own
        words = list(map(keys.__getitem__, own))
        for c in set("".join(words)) - self._letters - self._strange - {"\0"}:
            cut = self._cutting.pre_tokenize_str(f" a{c}a")
            (self._letters if [piece for piece, _ in cut] == [_byte_level(f" a{c}a")] else self._strange).add(c)
        whole = list(map(self._strange.isdisjoint, words))
        return list(compress(own, whole)), list(compress(own, map(not_, whole)))

    def _learned(self, keys: list[str], before: str, ids_of: Callable[[list[str], str], np.ndarray]) -> Iterator[pa.LargeBinaryArray]:
        """The ids of words with a space before them, which is theirs, or a line end, which isn't."""
        apart = int(before == "\n")
        for own in (keys[i : i + LEARNED_AT_ONCE] for i in range(0, len(keys), LEARNED_AT_ONCE)):
            words = [key[1:] for key in own] if apart else own
            ids = ids_of(words, before)
            if len(starts := self._starts(ids, apart)) != len(own):  # a merge took something of two words
                ids = self._joined(words, before)
                starts = self._starts(ids, apart)
            if len(starts) != len(own):
                raise ValueError("words that the library takes together")
            if apart:
                ids, starts = np.delete(ids, starts - 1), starts - np.arange(1, len(own) + 1)
            bounds = np.append(starts, len(ids)).astype(np.int64) * 4
            yield pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(own), [None, pa.py_buffer(bounds), pa.py_buffer(ids)])

    def _starts(self, ids: np.ndarray, apart: int) -> np.ndarray:
        return np.flatnonzero(ids == np.frombuffer(self._line_end, "<u4")[0]) + 1 if apart else np.flatnonzero(self._opens[ids])

    def _joined(self, words: list[str], before: str) -> np.ndarray:
        return self._line("".join([before + word for word in words]))

    def _merged(self, words: list[str], before: str) -> np.ndarray:
        """The words' ids by the library's model alone. No merge reaches over a space or line end before letters."""
        lines = (words[i : i + WORDS_A_LINE] for i in range(0, len(words), WORDS_A_LINE))
        found = map(self._model.tokenize, (_byte_level(before + before.join(line)) for line in lines))
        return np.fromiter(map(_ID, chain.from_iterable(found)), dtype="<u4")

    def _line(self, line: str) -> np.ndarray:
        return np.array(self._tokenizer.encode_batch_fast([line], add_special_tokens=False)[0].ids, dtype="<u4")

    def _marked(self, marks: str) -> bytes:
        if marks not in self._marks:
            if len(self._marks) >= _MARKS_KEPT:
                self._marks = {"": b""}
            self._marks[marks] = self._direct(marks)
        return self._marks[marks]


def _strings(column: pa.LargeStringArray) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def encoded(batches: Iterable[pa.RecordBatch], encoder: TextEncoder, at_once: int = ENCODED_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Each batch with the ids of its texts. Batches of some megabytes are encoded together, as
    a piece that they share is then looked up once."""
    held: list[pa.RecordBatch] = []

    def done() -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
        ids = iter(encoder.encode([text for batch in held for text in batch.column("text").to_pylist()]))
        for batch in held:
            yield batch, list(islice(ids, batch.num_rows))

    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= at_once:
            yield from done()
            held = []
    if held:
        yield from done()


def worker_encoder(vocabulary: str = VOCABULARY, memory_pieces: int = MEMORY_PIECES) -> TextEncoder:
    """The encoder of this worker process, kept between batches and tasks."""
    return kept_by_worker("tokens", (vocabulary, memory_pieces), lambda: TextEncoder(vocabulary, memory_pieces))
