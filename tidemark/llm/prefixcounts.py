"""Exact token counts at every prefix of a text.

A byte-level BPE never merges across the words that its pattern cuts, so count(prefix) = count(up to the last word) +
count(the word's part). The table holds the running count at each word's end. Inside a word, dynamic programming goes
over its bytes once: the last token of the prefix that ends at i is the one token t for which the last token of the
prefix before t and t stand side by side, that is, are what BPE makes of their joined bytes; its count is one more
than that prefix's. An automaton names the tokens that end at each byte. Every distinct word is worked out once.
Truncation and budget questions then read stored counts; they never encode a text again.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from .text import slices

TOKENIZER = "byte_bpe_50k.json"
#: Characters (and 16 for each word) of the words whose counts a Python worker keeps; longer words are not kept.
CACHED_CHARS = 16_000_000
KEPT = 1024
#: Characters of the words whose counts at every prefix it keeps.
INSIDE_CHARS = 4_000_000
#: The pattern may cut the prefix of a word of so many characters into several ('re, 've, 'll).
RECUT = 4
_NEVER = 1 << 60


class Inside:
    """Token counts at every byte of a word, from the merges of a byte-level BPE."""

    def __init__(self, model: dict):
        import ahocorasick

        self.byte = _byte_letters()
        letter = {c: bytes([b]) for b, c in self.byte.items()}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.ranks = {(self._bytes(a, letter), self._bytes(b, letter)): k for k, (a, b) in enumerate(pairs)}
        parts = [bytes([b]) for b in range(256)] + [a + b for a, b in self.ranks]
        self.parts = [p for p in dict.fromkeys(parts) if self.merge(p) == [p]]  # the rest no text ever gives
        self.tokens = ahocorasick.Automaton()
        for k, p in enumerate(self.parts):
            self.tokens.add_word(p.decode("latin-1"), (k, len(p)))
        self.tokens.make_automaton()
        self.beside: dict[int, bool] = {}
        self.steps: dict[int, list] = {}

    @staticmethod
    def _bytes(token: str, letter: dict[str, bytes]) -> bytes:
        return b"".join(letter[c] for c in token)

    def merge(self, word: bytes, steps: list | None = None) -> list[bytes]:
        """BPE of a few bytes, merge by merge. `steps` receives (rank, first part, last part) before each and at the end."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            least, at = min((self.ranks.get((a, b), _NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if least == _NEVER:
                break
            if steps is not None:
                steps.append((least, parts[0], parts[-1]))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if steps is not None:
            steps.append((_NEVER, parts[0], parts[-1]))
        return parts

    def _steps(self, token: int) -> list[tuple[int, bytes, bytes]]:
        if token not in self.steps:
            steps: list = []
            self.merge(self.parts[token], steps)
            self.steps[token] = steps
        return self.steps[token]

    def _stand(self, a: int, b: int) -> bool:
        """Whether BPE leaves the tokens a and b as they are when they meet: as both grow, merge by merge in the order
        of ranks and places, the pair across never has its turn."""
        left, right = iter(self._steps(a)), iter(self._steps(b))
        rank = self.ranks.get
        (one, _, last), (two, first, _) = next(left), next(right)
        while True:
            across = rank((last, first), _NEVER)
            if across < one and across <= two and across != _NEVER:
                ok = False
                break
            if one == two == _NEVER:
                ok = True
                break
            if one <= two:
                one, _, last = next(left)
            else:
                two, first, _ = next(right)
        self.beside[a << 20 | b] = ok
        return ok

    def counts(self, word: str) -> np.ndarray:
        """Tokens of the first 1, 2, … characters of a word that stay one word for the pattern."""
        if len(self.beside) > 1_000_000:
            self.beside.clear()
        raw = word.encode("utf-8")
        last, count = [-1] * (len(raw) + 1), [0] * (len(raw) + 1)
        known = self.beside.get
        for end, (token, size) in self.tokens.iter(raw.decode("latin-1")):
            end += 1
            if last[end] < 0:
                start = end - size
                before = last[start]
                if not start:
                    last[end], count[end] = token, 1
                elif before >= 0:
                    ok = known(before << 20 | token)
                    if ok if ok is not None else self._stand(before, token):
                        last[end], count[end] = token, count[start] + 1
        if len(raw) == len(word):
            return np.array(count[1:], dtype=np.int32)
        ends = np.cumsum([len(c.encode("utf-8")) for c in word])
        return np.array(count, dtype=np.int32)[ends]


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in the file: printable ones for themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class PrefixCounter:
    """Counts of one tokenizers file, which is found by `public_tokenizers.path` on whichever machine runs this.

    Special strings count as the library's default has them: one token, and an end for the words on both sides.
    """

    def __init__(self, file: str = TOKENIZER, pattern: str | None = None):
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(file))
        self.words = regex.compile(pattern or public_tokenizers.PATTERN).findall
        self.blank = regex.compile(r"\s+")
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = frozenset(special)
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True)) + ")").split if special else None
        self.known: dict[str, int] = {}
        self.held = 0
        self.brief: list[str] = []
        self._inside: Inside | None = None
        self.profiles: dict[str, np.ndarray] = {}
        self.profiled = 0

    def encode(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False))

    def units(self, text: str) -> list[str]:
        """The words and special strings of a text, in order; joined they give the text."""
        if self.cut is None or not any(s in text for s in self.special):
            return self.words(text)
        return [u for k, x in enumerate(self.cut(text)) for u in ([x] if k % 2 else self.words(x))]

    def learn(self, units: set[str]) -> None:
        """Count words not met before. What stays between calls is bounded in characters."""
        if self.held > CACHED_CHARS:
            self.known.clear()
            self.held = 0
        for u in self.brief:
            self.known.pop(u, None)
        new = [u for u in units if u not in self.known]
        self.brief = [u for u in new if len(u) > KEPT]
        got = self.tokenizer.encode_batch_fast(new, add_special_tokens=False) if new else []
        self.known.update(zip(new, map(len, got)))
        self.held += sum(map(len, new)) + 16 * len(new)

    def tables(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text (ends, counts): the code points and tokens up to each word's end."""
        cut = [self.units(t) for t in texts]
        self.learn(set().union(*cut) if cut else set())
        known = self.known
        return [(np.cumsum(np.fromiter(map(len, u), np.int32, len(u)), dtype=np.int32), np.cumsum(np.fromiter(map(known.__getitem__, u), np.int32, len(u)), dtype=np.int32)) for u in cut]

    def profile(self, word: str) -> np.ndarray:
        """Tokens of the first 1, 2, … characters of a word or run of blanks, worked out once."""
        got = self.profiles.get(word)
        if got is None:
            if self._inside is None:
                self._inside = Inside(json.loads(self.tokenizer.to_str())["model"])
            got = self._inside.counts(word)
            if len(word) <= RECUT:
                pieces = [self.words(word[:n]) for n in range(1, len(word) + 1)]
                got = np.array([got[n] if len(p) == 1 else sum(int(self.profile(x)[-1]) for x in p) for n, p in enumerate(pieces)], dtype=np.int32)
            if self.profiled > INSIDE_CHARS:
                self.profiles.clear()
                self.profiled = 0
            self.profiles[word] = got
            self.profiled += len(word) + 32
        return got

    def within(self, text: str, ends, counts, k: int) -> np.ndarray:
        """Tokens of the prefixes that end after each character of unit k.

        Blanks that end a text are one word, however the pattern cut them with a word behind, so a prefix that ends
        in blanks takes them from the first blank unit on. One that ends inside a special string has no special
        string there: its letters join the word before, so it is cut again from that word on.
        """
        start, end = int(ends[k - 1]) if k else 0, int(ends[k])
        unit = text[start:end]
        first, at = k, start  # from here on units are blank
        while first and self.blank.fullmatch(text, int(ends[first - 2]) if first > 1 else 0, at):
            first -= 1
            at = int(ends[first - 1]) if first else 0
        base = int(counts[first - 1]) if first else 0
        if unit in self.special:
            if first and text[int(ends[first - 2]) if first > 1 else 0 : at] not in self.special:
                first -= 1
                at = int(ends[first - 1]) if first else 0
                base = int(counts[first - 1]) if first else 0
            inner = [base + sum(int(self.profile(w)[-1]) for w in self.words(text[at : start + n])) for n in range(1, len(unit))]
            return np.array([*inner, int(counts[k])], dtype=np.int64)
        out = self.profile(unit).astype(np.int64) + (int(counts[k - 1]) if k else 0)
        blanks = self.blank.match(text, start, end)
        if blanks:
            run = self.blank.match(text, at).end()  # the run from its beginning to where it ends, in whichever unit
            here = self.profile(text[at:run])[start - at : blanks.end() - at]
            out[: len(here)] = base + here
        return out

    def at(self, text: str, ends, counts, stop: int) -> int:
        """Tokens of text[:stop]."""
        if stop <= 0 or not len(ends):
            return 0
        k = bisect_right(ends, stop - 1)
        return int(self.within(text, ends, counts, k)[stop - (int(ends[k - 1]) if k else 0) - 1])

    def longest(self, text: str, ends, counts, budget: int) -> int:
        """Code points of the longest prefix with at most `budget` tokens.

        It ends in the first unit whose end the table has above the budget, or, where that unit's last blanks or
        letters would join what follows, in the units behind; else before it.
        """
        if not len(ends):
            return 0
        k = bisect_right(counts, budget)
        last = k
        while last < len(ends) and self.blank.fullmatch(text, int(ends[last - 1]) if last else 0, int(ends[last])):
            last += 1
        ahead = last + 1
        while ahead < len(ends) and self.blank.fullmatch(text, int(ends[ahead - 1]), int(ends[ahead])):
            ahead += 1
        if ahead < len(ends) and text[int(ends[ahead - 1]) : int(ends[ahead])] in self.special:
            last = ahead
        elif last + 1 < len(ends):
            last += 1  # its first blank may join blanks before it
        for i in range(min(last, len(ends) - 1), -1, -1):
            ok = np.flatnonzero(self.within(text, ends, counts, i) <= budget)
            if len(ok):
                return (int(ends[i - 1]) if i else 0) + int(ok[-1]) + 1
        return 0


_counters: dict[str, PrefixCounter] = {}


def counter(file: str) -> PrefixCounter:
    if file not in _counters:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _counters[file] = PrefixCounter(file)
    return _counters[file]


def prefix_table(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, keep_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, ends, counts (and text), a row for each input row; a null text is empty.

    `ends` and `counts` have an entry for each word: code points and tokens up to its end. Both are empty for an
    empty text. The whole text is counted, however long it is.
    """
    cols = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    ints = ArrayType(IntegerType(), False)
    schema = StructType([cols.schema["doc_id"], *([StructField("text", StringType())] if keep_text else []), StructField("n_bytes", LongType()), StructField("ends", ints), StructField("counts", ints)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw, offsets in slices(batches):
            data = raw.tobytes()
            tables = counter(tokenizer).tables([data[a:b].decode("utf-8") for a, b in zip(offsets[:-1], offsets[1:])])
            bounds = pa.array(np.cumsum([0, *(len(e) for e, _ in tables)]), pa.int32())
            lists = [pa.ListArray.from_arrays(bounds, pa.array(np.concatenate([t[k] for t in tables]), pa.int32())) for k in (0, 1)]
            first = [part.column("doc_id"), *([part.column("text")] if keep_text else [])]
            yield pa.RecordBatch.from_arrays([*first, pa.array(np.diff(offsets), pa.int64()), *lists], names=schema.names)

    return cols.mapInArrow(run, schema)


def token_counts(table: DataFrame, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit from a prefix table: the last prefix is the whole text."""
    n = F.when(F.size("counts") > 0, F.element_at("counts", -1)).otherwise(0).cast("bigint")
    return table.select("doc_id", "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit"))


def truncated(table: DataFrame, budget: int, *, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, text (the longest prefix of at most `budget` tokens), n_tokens, from a prefix table with texts."""
    cols = table.select("doc_id", "text", "ends", "counts")
    schema = StructType([cols.schema["doc_id"], StructField("text", StringType()), StructField("n_tokens", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(tokenizer)
        for part in batches:
            texts, totals = [], []
            for text, ends, counts in zip(*(part.column(x).to_pylist() for x in ("text", "ends", "counts"))):
                stop = c.longest(text or "", ends, counts, budget)
                texts.append((text or "")[:stop])
                totals.append(c.at(text or "", ends, counts, stop))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string()), pa.array(totals, pa.int64())], names=schema.names)

    return cols.mapInArrow(run, schema)
