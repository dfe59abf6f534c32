"""Token counts by prefix dynamic programming.

The count at a prefix needs only the counts at shorter prefixes: the last token
of a prefix is the one vocabulary entry that ends there and is stable next to
the last token of what stands before it (two neighbours are stable if merging
their joined characters gives exactly the two again).  So one left-to-right pass
stores the exact token count of *every* prefix, and truncation and budget
questions read that table instead of encoding again.

White space starts a token and never stands inside or at the end of one, so the
passes of different words are independent and a word's table is kept for its
next occurrence.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialwright.llm.common import prepare

SPACE = "▁"  # how the vocabulary writes a space
_RUNS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
_COUNTERS: dict[str, PrefixCounter] = {}


class Remembered(dict):
    """Values of ``compute`` by argument, in two generations.

    When the younger one is full it becomes the older one, whose values return
    on their next use; so what is used often survives and at most ``most`` are
    kept.
    """

    def __init__(self, compute: Callable[[Any], Any], most: int) -> None:
        super().__init__()
        self.compute, self.half, self.older = compute, most // 2, {}

    def __missing__(self, key: Any) -> Any:
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.half:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class PrefixCounter:
    """Exact token counts of all prefixes of a text, for one sentencepiece BPE model.

    ``kept_words`` bounds the words that a worker remembers and ``kept_pairs``
    the judged neighbours; what is forgotten is computed again, so the bounds
    change time, not results.
    """

    def __init__(self, model_path: str, kept_words: int = 400_000, kept_pairs: int = 1_000_000) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        special = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
        self.scores = {
            model.id_to_piece(i): model.get_score(i)
            for i in range(model.get_piece_size())
            if not any(is_special(i) for is_special in special)
        }
        # A piece that its own characters do not merge into never appears.
        self.pieces = [p for p in self.scores if len(p) == 1 or self.merged(p) == [p]]
        self.known = {p for p in self.scores if len(p) == 1}
        self.ending = self._by_ending()
        self.stable = Remembered(self._is_stable, kept_pairs)
        self.after_space = Remembered(lambda word: self.segment_counts(SPACE + word)[-1], kept_words)
        self.bare = Remembered(lambda word: self.segment_counts(word)[-1], kept_words)

    def _by_ending(self) -> dict:
        """Pieces from their last character to the first, as nested dictionaries; ``""`` holds a piece's number."""
        root: dict = {}
        for number, piece in enumerate(self.pieces):
            node = root
            for character in reversed(piece):
                node = node.setdefault(character, {})
            node[""] = number
        return root

    def merged(self, text: str) -> list[str]:
        """The tokens of a few characters, by the merge order itself."""
        parts = list(text)
        while len(parts) > 1:
            found = [
                (-self.scores[parts[i] + parts[i + 1]], i)
                for i in range(len(parts) - 1)
                if parts[i] + parts[i + 1] in self.scores
            ]
            if not found:
                break
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _is_stable(self, pair: int) -> bool:
        """Whether two neighbours (their numbers in one) stay apart when their characters are merged."""
        before, last = (self.pieces[number] for number in divmod(pair, len(self.pieces)))
        return self.merged(before + last) == [before, last]

    def _run_counts(self, run: str) -> list[int]:
        """Counts at every prefix of characters that are all in the vocabulary."""
        stable, ending, size = self.stable, self.ending, len(self.pieces)
        counts: list[int] = []
        lasts: list[int] = []
        for end in range(len(run)):
            node, start = ending, end
            # Exactly one of the pieces that end here is stable next to what stands before it.
            while True:
                node = node[run[start]]
                last = node.get("")
                if last is not None:
                    if start == 0:
                        counts.append(1)
                        break
                    if stable[lasts[start - 1] * size + last]:
                        counts.append(counts[start - 1] + 1)
                        break
                start -= 1
            lasts.append(last)
        return counts

    def segment_counts(self, segment: str) -> list[int]:
        """Counts at every prefix of a word with the spaces before it.

        A character outside the vocabulary becomes its UTF-8 bytes, one token
        each, and nothing merges across it.
        """
        known = self.known
        if known.issuperset(segment):
            return self._run_counts(segment)
        counts: list[int] = []
        base = at = 0
        while at < len(segment):
            end = at
            while end < len(segment) and segment[end] in known:
                end += 1
            if end > at:
                counts += [base + c for c in self._run_counts(segment[at:end])]
                base, at = counts[-1], end
            else:
                base += len(segment[at].encode())
                counts.append(base)
                at += 1
        return counts

    def count(self, text: str) -> int:
        """Tokens of the whole text: the last entry of its prefix table."""
        if not text:
            return 0
        lines = text.split("\n")
        newline = 0 if len(lines) == 1 else self.segment_counts("\n")[-1]
        total = newline * (len(lines) - 1)
        first = True
        for line in lines:
            words = line.split(" ")
            if "" in words or SPACE in line:
                written = (SPACE if first else "") + line.replace(" ", SPACE)
                total += sum(map(self._total, _RUNS.findall(written)))
            else:
                total += sum(map(self.after_space.__getitem__, words[not first :]))
                if not first:
                    total += self.bare[words[0]]
            first = False
        return total

    def _total(self, segment: str) -> int:
        """The last entry of a segment's table."""
        return self.after_space[segment[1:]] if segment[0] == SPACE else self.bare[segment]

    def _segments(self, text: str) -> Iterator[str]:
        written = SPACE + text.replace(" ", SPACE) if text else ""
        for line_number, line in enumerate(written.split("\n")):
            if line_number:
                yield "\n"
            yield from _RUNS.findall(line)

    def prefix_counts(self, text: str) -> list[int]:
        """Tokens of ``text[:1]``, ``text[:2]`` and so on to the whole text."""
        counts: list[int] = []
        base = 0
        for segment in self._segments(text):
            counts += [base + c for c in self.segment_counts(segment)]
            base = counts[-1]
        return counts[1:]  # without the space put before the text

    def longest_fit(self, text: str, budget: int) -> int:
        """Characters of the longest prefix of at most ``budget`` tokens."""
        begun: list[tuple[int, int, str]] = []
        base, at = 0, -1
        for segment in self._segments(text):
            if base + 1 > budget:
                break
            begun.append((base, at, segment))
            base, at = base + self._total(segment), at + len(segment)
        # The longest fit ends in the last segment of which any prefix fits.
        for base, at, segment in reversed(begun):
            fits = [i for i, c in enumerate(self.segment_counts(segment)) if base + c <= budget]
            if fits:
                return max(0, at + fits[-1] + 1)
        return 0


def counter(model_path: str) -> PrefixCounter:
    """This worker's counter for a model."""
    if model_path not in _COUNTERS:
        _COUNTERS[model_path] = PrefixCounter(model_path)
    return _COUNTERS[model_path]


def token_counts(
    docs: DataFrame,
    model_path: str,
    *,
    key: str = "doc_id",
    text: str = "text",
    budget: int = 4096,
    keep_prefixes: bool = False,
) -> DataFrame:
    """Exact token counts of whole texts, and where a budget cuts them.

    Returns the key, ``n_bytes``, ``n_tokens``, ``over_limit``
    (``n_tokens > budget``) and ``fit_chars``, the characters of the longest
    prefix within the budget.  ``keep_prefixes`` adds ``prefix_tokens``
    (array<int>): entry i is the count of the first i characters, so
    :func:`prefix_tokens_at` and later budgets need no tokenizer.

    One pass over the rows, no shuffle.  A null text counts as empty (0 bytes,
    0 tokens); repeated rows and null keys come back as often as they came;
    an empty table gives an empty result; other columns are left out, so their
    names cannot clash.
    """
    prepare(docs.sparkSession)
    source = docs.select(F.col(key), F.col(text).alias("__text"))
    kind = source.schema[key].dataType.simpleString()
    fields = f"`{key}` {kind}, n_bytes long, n_tokens long, over_limit boolean, fit_chars long"
    if keep_prefixes:
        fields += ", prefix_tokens array<int>"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = counter(model_path)
        for batch in batches:
            texts = [t or "" for t in batch.column("__text").to_pylist()]
            tables = [tool.prefix_counts(t) for t in texts] if keep_prefixes else None
            counts = [(c[-1] if c else 0) for c in tables] if tables is not None else [tool.count(t) for t in texts]
            over = [c > budget for c in counts]
            columns = [
                batch.column(key),
                pa.array([len(t.encode()) for t in texts], pa.int64()),
                pa.array(counts, pa.int64()),
                pa.array(over, pa.bool_()),
                pa.array([tool.longest_fit(t, budget) if o else len(t) for t, o in zip(texts, over, strict=True)], pa.int64()),
            ]
            names = [key, "n_bytes", "n_tokens", "over_limit", "fit_chars"]
            if tables is not None:
                columns.append(pa.array(tables, pa.list_(pa.int32())))
                names.append("prefix_tokens")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return source.mapInArrow(count, fields)


def prefix_tokens_at(n_chars: int, table: str = "prefix_tokens"):
    """Tokens of the first ``n_chars`` characters, read from a kept table; shorter texts give their whole count."""
    entries = F.col(table)
    at = F.least(F.lit(n_chars), F.size(entries))
    return F.when(at <= 0, F.lit(0)).otherwise(F.get(entries, at - 1))


def longest_prefix(budget: int, table: str = "prefix_tokens"):
    """Characters of the longest prefix within ``budget`` tokens, read from a kept table."""
    entries = F.col(table)
    fitting = F.filter(F.transform(entries, lambda c, i: F.when(c <= budget, i + 1)), lambda i: i.isNotNull())
    return F.coalesce(F.array_max(fitting), F.lit(0))
