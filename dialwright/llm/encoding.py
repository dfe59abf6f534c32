"""Whole texts to token ids with a byte-level BPE of the tokenizers library.

The library spends most of its time on taking texts apart, and most words of a
corpus come again and again.  So texts are cut into words by Arrow, ids are
remembered per word, and only new words are encoded, a lot at a time.  Texts are
cut only where the library's pre-tokenizer always cuts:

* vocabularies that keep white space: before a single space and around a single
  newline; a text with any other white space goes to the library whole;
* vocabularies that drop white space: at ASCII white space.

A text that holds an added token's string goes to the library whole, too.  New
words of letters are merged by tiktoken with the merges of the same file, other
words by the library.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_ENCODERS: dict[str, WordEncoder] = {}
# White space of Unicode other than the space and the newline.
_OTHER_SPACE = r"[\t\x0B\f\r\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_ODD = _OTHER_SPACE + r"|[ \n][ \n]|\A[ \n]|[ \n]\z"
# Latin and Cyrillic letters, which normal form C leaves as they are.
_STABLE = r"[A-Za-z\x{AA}\x{B5}\x{BA}\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}\x{400}-\x{481}\x{48A}-\x{52F}]"
_MARK = "\x00"  # stands for the end of a word; no word of letters holds it


def _alphabet() -> dict[str, int]:
    """How byte-level vocabularies write a byte: printable ones as themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Merger:
    """Ids of pieces that the pre-tokenizer leaves whole, by the merges of a tokenizer file.

    A merge's rank is its place in the file.  Where the vocabulary marks the end
    of a word, a byte and the mark after it merge before anything else.
    """

    def __init__(self, model: dict) -> None:
        import tiktoken

        vocabulary, suffix, byte = model["vocab"], model["end_of_word_suffix"] or "", _alphabet()
        self.mark = _MARK if suffix else ""

        def raw(token: str) -> bytes:
            closed = bool(suffix) and token.endswith(suffix)
            body = token[: -len(suffix)] if closed else token
            return bytes(byte[c] for c in body) + (self.mark.encode() if closed else b"")

        made = ["".join(pair.split(" ") if isinstance(pair, str) else pair) for pair in model["merges"]]
        closed_bytes = [c + suffix for c in byte] if suffix else []
        tokens = [*closed_bytes, *made, *byte]
        ranks: dict[bytes, int] = {}
        for rank, token in enumerate(tokens):
            ranks.setdefault(raw(token), rank)
        self.id_of = np.array([vocabulary[t] for t in tokens], np.uint32)
        self.newline = ranks[b"\n"]
        self.tool = tiktoken.Encoding("words", pat_str=r"[^\n.,]+|[.,]\x00?|\n", mergeable_ranks=ranks, special_tokens={})

    def ids(self, words: pa.Array) -> pa.Array:
        """Ids of words of letters, which may end in a full stop or a comma, as lists."""
        if self.mark:
            words = pc.replace_substring_regex(words, r"([.,])\z", rf"{self.mark}\1")
        closed = f"{self.mark}\n"
        ranks = np.array(self.tool.encode_ordinary(closed.join(words.to_pylist()) + closed), np.int64)
        between = ranks == self.newline
        ends = np.flatnonzero(between) - np.arange(len(words))
        return _lists(self.id_of[ranks[~between]], ends)


def _lists(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int64)), pa.array(ids, pa.uint32()))


class _Memory:
    """Words and their ids."""

    def __init__(self) -> None:
        self.words = pa.array([], pa.large_string())
        self.ids = _lists(np.zeros(0, np.uint32), np.zeros(0, np.int64))

    def add(self, words: pa.Array, ids: pa.Array) -> None:
        self.words = pa.concat_arrays([self.words, words])
        self.ids = pa.concat_arrays([self.ids, ids])

    def find(self, words: pa.Array) -> pa.Array:
        """The place of each word, null for one that is not known."""
        return pc.index_in(words, value_set=self.words)


class WordEncoder:
    """Ids of texts, equal to ``encode(text, add_special_tokens=False).ids`` of the library.

    A worker remembers at most about twice ``kept_words`` words in two
    generations: when the young one is full it becomes the old one, and words
    met again move on.  Words in use survive; the bound changes time, not results.
    """

    def __init__(self, path: str, kept_words: int = 200_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.kept_words = kept_words
        self.drops_space = not self._library(["\n"])[0]
        self.folds = self._library(["A"]) == self._library(["a"])
        self.simple = rf"\A{_STABLE}+[.,]?\z" if self.drops_space else r"\A ?\p{L}+[.,]?\z"
        self.merger = Merger(model)
        self.young, self.old = _Memory(), _Memory()
        self.cuts = self._cuts_hold()

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [found.ids for found in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _cuts_hold(self) -> bool:
        """Whether this tokenizer takes words one by one, with the space before them where it keeps that."""
        words = ["ab", " cd", "\n", "Ef", " it's", " x1,", "\n", "éè", " --", " Straße."]
        whole = self._library(["".join(words)])[0]
        if self.drops_space:
            words = [w.strip() for w in words if w != "\n"]
        memory = _Memory()
        self._learn(memory, pa.array(list(dict.fromkeys(words)), pa.large_string()))
        at = memory.find(pa.array(words, pa.large_string()))
        return whole == sum(self._library(words), []) and whole == memory.ids.take(at).flatten().to_pylist()

    def _learn(self, memory: _Memory, words: pa.Array) -> None:
        """Put new words into the memory.

        Letters, and letters with one closing mark, are merged here; the library
        takes the rest, and an empty part stands for a newline.
        """
        simple = pc.match_substring_regex(words, self.simple)
        if self.folds:
            simple = pc.and_(simple, pc.invert(pc.match_substring(words, "İ")))  # becomes two characters
        letters, others = words.filter(simple), words.filter(pc.invert(simple))
        if len(letters):
            memory.add(letters, self.merger.ids(pc.utf8_lower(letters) if self.folds else letters))
        if len(others):
            found = self._library([w or "\n" for w in others.to_pylist()])
            ids = np.array([i for ids in found for i in ids], np.uint32)
            memory.add(others, _lists(ids, np.cumsum([len(ids) for ids in found])))

    def _places(self, words: pa.Array) -> np.ndarray:
        """The place of each of these distinct words in the young memory, where they are put first if need be."""
        if len(self.young.words) > self.kept_words:
            self.young, self.old = _Memory(), self.young
        at = self.young.find(words)
        absent = words.filter(pc.is_null(at))
        if len(absent):
            known = self.old.find(absent)
            seen = pc.is_valid(known)
            self.young.add(absent.filter(seen), self.old.ids.take(known.drop_null()))
            new = absent.filter(pc.invert(seen))
            if len(new):
                self._learn(self.young, new)
            at = self.young.find(words)
        return at.to_numpy(zero_copy_only=False)

    def _by_words(self, texts: pa.Array) -> Iterator[np.ndarray]:
        if self.drops_space:
            parts = pc.ascii_split_whitespace(texts)
            flat = parts.flatten()
            keep = pc.not_equal(flat, "")  # white space at an end leaves an empty part
            sizes = np.add.reduceat(
                np.append(keep.to_numpy(zero_copy_only=False).astype(np.int64), 0),
                parts.offsets.to_numpy()[:-1],
            )
            flat = flat.filter(keep)
        else:
            # A doubled newline leaves the empty part that stands for it.
            doubled = pc.replace_substring(texts, "\n", "\n\n")
            parts = pc.split_pattern(pc.replace_substring(doubled, " ", "\n "), "\n")
            flat = parts.flatten()
            sizes = np.diff(parts.offsets.to_numpy())
        coded = flat.dictionary_encode()
        places = self._places(coded.dictionary)
        found = self.young.ids.take(pa.array(places[coded.indices.to_numpy(zero_copy_only=False)]))
        text_ends = found.offsets.to_numpy()[np.cumsum(sizes)]
        return iter(np.split(found.flatten().to_numpy(), text_ends[:-1]))

    def encode(self, texts: list[str] | pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, as uint32."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        whole = pc.equal(texts, "")
        if not self.cuts:
            whole = pc.or_(whole, True)
        elif self.drops_space:
            whole = pc.or_(whole, pc.invert(pc.match_substring_regex(texts, r"[^ \t\n\x0B\f\r]")))
        else:
            whole = pc.or_(whole, pc.match_substring_regex(texts, _ODD))
        for token in self.added:
            whole = pc.or_(whole, pc.match_substring(texts, token))
        rest = iter(self._library(texts.filter(whole).to_pylist()))
        plain = texts.filter(pc.invert(whole))
        cut = self._by_words(plain) if len(plain) else iter(())
        for is_whole in whole.to_pylist():
            yield np.array(next(rest), np.uint32) if is_whole else next(cut)


def encoder(path: str) -> WordEncoder:
    """This worker's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def encoded(path: str, texts: pa.Array, end_id: int, at_once: int = 1 << 22) -> Iterator[np.ndarray]:
    """Each text's ids and the end id, as little-endian uint32; a null text is empty.

    Texts are handled in lots of about ``at_once`` bytes, so memory follows one
    lot or one long text.
    """
    tool = encoder(path)
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + at_once, side="right")))
        for found in tool.encode(texts.slice(start, stop - start)):
            ids = np.empty(len(found) + 1, "<u4")
            ids[:-1] = found
            ids[-1] = end_id
            yield ids
        start = stop
