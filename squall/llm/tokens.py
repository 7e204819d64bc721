"""Token ids of whole texts.

Texts are cut at spaces and every distinct piece is encoded once per task.
This gives the ids of the whole text for tokenizers that drop white space and
never merge across it (such as word-level BPE with end-of-word marks), which
``word_bounded`` checks on the tokenizer's own definition.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from squall.llm.common import SLICE_BYTES, strings

# distinct pieces remembered by a Python worker (bounds its memory)
CACHE_PIECES = 300_000

# A piece as (stem, closing marks). Marks after a letter or digit are tokens of
# their own, and these letters have one-to-one lower case and no composed forms,
# so encoding the lower-cased stem and the marks apart keeps the ids. Pieces of
# any other form are encoded as they are.
STEM = "^(?P<stem>[0-9A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<tail>[.,!?;:)]*)$"
LETTERS = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"
SEPARATOR = "|"

_LOADED: dict[str, "TextEncoder"] = {}


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def encoder(path: str) -> "TextEncoder":
    """The worker's encoder for a tokenizer file; loaded once per process."""
    if path not in _LOADED:
        _LOADED[path] = TextEncoder(path)
    return _LOADED[path]


def word_bounded(spec: dict) -> bool:
    """Does the pre-tokenizer keep only matches of a pattern that hold no white
    space, so that a space always ends a piece?"""
    steps = [spec.get("pre_tokenizer") or {}]
    steps = steps[0].get("pretokenizers", steps)
    return any(s.get("type") == "Split" and s.get("behavior") == "Removed" and s.get("invert")
               and r"[^\s" in json.dumps(s.get("pattern")).replace("\\\\", "\\") for s in steps)


class TextEncoder:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.by_piece = word_bounded(spec)
        self.word_end = self._word_ends((spec.get("model") or {}).get("end_of_word_suffix"))
        mark = self.tokenizer.encode(SEPARATOR, add_special_tokens=False).ids
        self.by_piece &= len(mark) == 1
        self.separator = mark[0]
        self._reset()

    def _word_ends(self, suffix: str | None) -> np.ndarray | None:
        """Which ids end a word, if the vocabulary marks that."""
        if not suffix:
            return None
        vocabulary = self.tokenizer.get_vocab()
        ends = np.zeros(max(vocabulary.values()) + 1, bool)
        ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        return ends

    def _reset(self) -> None:
        self.known = pa.array([""], pa.large_string())
        self.flat = [np.empty(0, np.uint32)]
        self.counts = [np.zeros(1, np.int64)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts after each other (uint32), and the count of each."""
        texts = strings(texts)
        if not self.by_piece:
            ids = [e.ids for e in self.tokenizer.encode_batch(texts.to_pylist(), add_special_tokens=False)]
            return (np.array([i for x in ids for i in x], np.uint32),
                    np.array([len(x) for x in ids], np.int64))
        if len(texts) == 1 and texts.nbytes > 2 * SLICE_BYTES:
            parts = [self._encode(pa.array([p], pa.large_string()))[0] for p in _cut(texts[0].as_py())]
            ids = np.concatenate(parts)
            return ids, np.array([len(ids)], np.int64)
        return self._encode(texts)

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        pieces = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        words = pieces.flatten().dictionary_encode()
        parted = pc.extract_regex(words.dictionary, STEM)
        stem, tail = pc.struct_field(parted, [0]), pc.struct_field(parted, [1])
        plain = pc.is_null(parted)
        stem = pc.if_else(plain, words.dictionary, pc.utf8_lower(stem)).dictionary_encode()
        tail = pc.if_else(plain, "", tail).dictionary_encode()
        # one lookup for both: it hashes the whole table of known pieces
        at = self._lookup(pa.concat_arrays([stem.dictionary, tail.dictionary]))
        one, two = at[stem.indices.to_numpy()], at[len(stem.dictionary) + tail.indices.to_numpy()]
        self.flat, self.counts = [np.concatenate(self.flat)], [np.concatenate(self.counts)]
        table = _lists(np.concatenate([[0], np.cumsum(self.counts[0])]), pa.array(self.flat[0]))
        both = table.take(pa.array(np.stack([one, two], axis=1).ravel()))
        each = _lists(both.offsets.to_numpy()[::2], both.values)  # a stem's ids, then its marks'
        ids = each.take(words.indices)
        upto = ids.offsets.to_numpy()
        bounds = upto[pieces.offsets.to_numpy() - pieces.offsets[0].as_py()].astype(np.int64)
        if len(self.known) > CACHE_PIECES:
            self._reset()
        return ids.values.to_numpy(), np.diff(bounds)

    def _lookup(self, words: pa.Array) -> np.ndarray:
        """Index of each piece in the table of encoded pieces; new ones are added.

        New pieces are encoded many at a time. Pieces of letters only are one word
        each, so the ids that end a word part them; others have a separator
        between them, a mark that none of them holds and that is one token."""
        at = pc.index_in(words, value_set=self.known)
        new = words.filter(pc.is_null(at))
        if len(new):
            apart = pc.match_substring(new, SEPARATOR)
            plain = pc.match_substring_regex(new, LETTERS) if self.word_end is not None else pc.is_null(new)
            kinds = [new.filter(plain), new.filter(pc.and_not(pc.invert(apart), plain)), new.filter(apart)]
            for run in _runs(kinds[0]):
                ids = self._ids(" ".join(run))
                ends = np.flatnonzero(self.word_end[ids])
                if len(ends) == len(run):
                    self._add(ids, np.diff(ends, prepend=-1))
                else:
                    self._each(run)
            for run in _runs(kinds[1]):
                ids = self._ids(f" {SEPARATOR} ".join([*run, ""]))
                ends = np.flatnonzero(ids == self.separator)
                self._add(np.delete(ids, ends), np.diff(ends, prepend=-1) - 1)
            self._each(kinds[2].to_pylist())
            added = pa.concat_arrays(kinds)
            at = pc.coalesce(at, pc.add(pc.index_in(words, value_set=added), len(self.known)))
            self.known = pa.concat_arrays([self.known, added])
        return at.to_numpy(zero_copy_only=False)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _each(self, words: list[str]) -> None:
        for w in words:
            ids = self._ids(w)
            self._add(ids, np.array([len(ids)]))

    def _add(self, ids: np.ndarray, counts: np.ndarray) -> None:
        self.flat.append(ids)
        self.counts.append(counts)


def _lists(ends: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)


def _runs(words: pa.Array, n: int = 512):
    names = words.to_pylist()
    return (names[i:i + n] for i in range(0, len(names), n))


def _cut(text: str, most: int = SLICE_BYTES):
    """A very long text in parts that end at a space."""
    start = 0
    while start < len(text):
        end = start + most
        if end < len(text):
            space = text.rfind(" ", start, end)
            space = space if space > start else text.find(" ", end)
            end = len(text) if space < 0 else space
        yield text[start:end]
        start = end + 1
