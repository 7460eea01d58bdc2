"""Token ids of whole texts by the tokenizers library, in tasks.

For tokenizers that drop white space before merging (a split pattern without white space, no
prefix space), the ids of a text are the ids of its blank-separated words in a row. Each worker
therefore keeps the ids of words it has met, and hands the library only new words, many at once.
"""

from __future__ import annotations

import os
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.llm.workers import kept, lean

#: Words kept by a worker: recurring ones, and ones met once (about 150 MB); bytes of a word that is still kept.
RECURRING_WORDS, NEW_WORDS = 500_000, 400_000
CACHED_WORD = 64
#: A control character that stands between new words handed over in one call.
_MARK = "\x01"
_CALL_WORDS = 20_000
#: Signs that may follow a word and are split from it whatever they are; an apostrophe may belong to a suffix.
_SIGNS = "".join(c for c in string.punctuation if c != "'")


class _Known(dict):
    """Ids of recurring words. A word met once waits in ``recent`` and is taken in when it comes again."""

    def __init__(self) -> None:
        super().__init__({"": b""})
        self.recent: dict[str, bytes] = {}
        self.new: set[str] = set()

    def __missing__(self, word: str) -> bytes | None:
        ids = self.recent.get(word)
        if ids is None:
            self.new.add(word)
        else:
            self[word] = ids
        return ids

    def forget(self) -> None:
        if len(self.recent) > NEW_WORDS:
            self.recent.clear()
        if len(self) > RECURRING_WORDS:
            self.clear()
            self[""] = b""


class WordEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.mark = self._ids(_MARK)
        if len(self.mark) != 1 or self._ids("a b\n c") != self._ids("a") + self._ids("b") + self._ids("c"):
            raise ValueError("this tokenizer does not encode words one by one")
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None) or "\x00"
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self.ends[[number for piece, number in self.tokenizer.get_vocab().items() if piece.endswith(suffix)]] = True
        self.known = _Known()
        self.signs: dict[str, bytes] = {}
        # letters and the signs after them are split by the library as well
        self.splits = self._ids("word.") == self._ids("word") + self._ids(".")

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _alone(self, word: str) -> bytes:
        return np.array(self._ids(word), dtype="<u4").tobytes()

    def _store(self, words: list[str], data: bytes, starts: list[int], ends: list[int]) -> None:
        recent = self.known.recent
        for word, start, end in zip(words, starts, ends):
            recent[word] = data[4 * start : 4 * end]

    def _learn(self, words: list[str]) -> None:
        for first in range(0, len(words), _CALL_WORDS):
            part = words[first : first + _CALL_WORDS]
            ids = np.array(self._ids(f" {_MARK} ".join(part)), dtype="<u4")
            cuts = np.flatnonzero(ids == self.mark[0]).tolist()
            if len(cuts) != len(part) - 1:
                raise RuntimeError("words did not stay apart")
            self._store(part, ids.tobytes(), [0, *[c + 1 for c in cuts]], [*cuts, len(ids)])

    def _learn_letters(self, words: list[str]) -> None:
        """Words of letters alone end at the tokens with the word-end suffix; where the count agrees no mark is needed."""
        for first in range(0, len(words), _CALL_WORDS):
            part = words[first : first + _CALL_WORDS]
            ids = np.array(self._ids(" ".join(part)), dtype="<u4")
            stops = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            if len(stops) == len(part):
                self._store(part, ids.tobytes(), [0, *stops[:-1]], stops)
            else:
                self._learn(part)

    def encode(self, texts: list[str]) -> list[bytes]:
        known, find = self.known, self.known.__getitem__
        # only blanks and newlines cut; the library sees other white space inside a word
        split = [text.replace("\n", " ").split(" ") for text in texts]
        found = [list(map(find, words)) for words in split]
        special = {w: self._alone(w) for w in known.new if len(w) > CACHED_WORD or _MARK in w}
        letters, signed, others = set(), [], []
        for word in known.new.difference(special):
            stem = word.rstrip(_SIGNS)
            if not stem.isalpha() or not self.splits:
                others.append(word)
            elif stem == word:
                letters.add(word)
            else:
                signed.append((word, stem))
        letters.update({stem for _, stem in signed if find(stem) is None})
        known.new.clear()
        self._learn_letters(list(letters))
        self._learn(others)
        recent = known.recent
        for word, stem in signed:
            signs = word[len(stem) :]
            if signs not in self.signs:
                self.signs[signs] = self._alone(signs)
            recent[word] = (known.get(stem) or recent[stem]) + self.signs[signs]
        recent.update(special)
        made = [
            b"".join([(known.get(w) or recent[w]) if ids is None else ids for w, ids in zip(words, parts)] if None in parts else parts)
            for words, parts in zip(split, found)
        ]
        for word in special:
            del recent[word]
        known.forget()
        return made


def encoder(path: str) -> WordEncoder:
    """One for each worker process and file, kept between tasks that encode."""
    return kept(f"words of {path}", lambda: WordEncoder(path))


def slices(batch: pa.RecordBatch, text: int, size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``size`` bytes of text, at least one row each."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0))
    ends, first = np.cumsum(lengths), 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield batch.slice(first, last - first)
        first = last


def token_ids(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int | None = 1
) -> DataFrame:
    """The id, ``ids`` (binary, little-endian unsigned 32 bits each) and ``n_tokens`` of each row.

    ``tokenizer`` is the path of a tokenizer file that every executor can open. ``end_id`` closes each document; a
    null or empty text has it alone. Nothing is shuffled.
    """
    tail = b"" if end_id is None else np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in batches:
            for part in slices(batch, 1):
                made = [ids + tail for ids in encode(part.column(1).to_pylist())]
                counts = pa.array([len(ids) // 4 for ids in made], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(made, pa.binary()), counts], [id_col, "ids", "n_tokens"])

    rows = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return rows.mapInArrow(lean(run, keeps=True), f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, ids binary, n_tokens bigint")
