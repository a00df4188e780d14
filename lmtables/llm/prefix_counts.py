"""Token counts of every prefix of a text, by dynamic programming over a byte-pair vocabulary."""

from __future__ import annotations

import json
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A chunk is what white space sets apart; the pattern below only splits inside of it.
CHUNK = regex.compile(r" ?[^\p{White_Space}]+|\p{White_Space}+(?![^\p{White_Space}])|\p{White_Space}+")
# Fixed value: the pre-token pattern of byte-level vocabularies of this kind.
WORD = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?![^\p{White_Space}])|\p{White_Space}+"
)
# White space and what follows it up to the next one: a text is cut into segments, and no pre-token crosses their ends.
SEGMENT = regex.compile(r"\p{White_Space}*[^\p{White_Space}]+|\p{White_Space}+")
SPACE = regex.compile(r"\p{White_Space}*")
# Pre-tokens whose first two characters are two pre-tokens when the text ends there.
CONTRACTIONS = ("'re", "'ve", "'ll")
ROWS_AT_ONCE = 256
CACHED = 400_000
LONGEST_CACHED = 48


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones as they are, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixCounter:
    """Exact token counts of all prefixes under a byte-level BPE vocabulary in ``tokenizers`` format.

    A sequence of tokens is the encoding of its bytes if and only if each token encodes to itself and each two
    neighbours encode to themselves. So the last token of a prefix is the one token that ends there and fits the last
    token of the prefix before it: one pass over the bytes gives the count of every prefix.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        decode = lambda token: bytes(letters[c] for c in token)
        added = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.added = set(added)
        model = spec["model"]
        self.vocab = {decode(t): i for t, i in model["vocab"].items() if t not in self.added}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.rank = {(decode(a), decode(b)): i for i, (a, b) in enumerate(pairs)}
        self.tokens = {i: t for t, i in self.vocab.items()}
        self.ending = ahocorasick.Automaton()  # finds the tokens that end at each byte
        for token, i in self.vocab.items():
            self.ending.add_word(token.decode("latin-1"), (len(token), i))
        self.ending.make_automaton()
        self.library = None
        self.fits: dict[int, bool] = {}
        self.words: dict[str, list[int]] = {}
        self.chunks: dict[str, int] = {}
        self.arrays: dict[str, np.ndarray] = {}

    def merge(self, data: bytes) -> list[bytes]:
        """The merges in rank order, for strings of two tokens at most."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get((parts[i], parts[i + 1]), 1 << 60))
            if (parts[best], parts[best + 1]) not in self.rank:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def _fit(self, before: int, token: int) -> bool:
        if len(self.fits) > 4 * CACHED:
            self.fits.clear()
        pair = [self.tokens[token]] if before < 0 else [self.tokens[before], self.tokens[token]]
        known = self.fits[before << 32 | token] = self.merge(b"".join(pair)) == pair
        return known

    def byte_counts(self, data: bytes) -> list[int]:
        """Tokens of data[:i] for i = 0 … len(data), where data is one pre-token."""
        counts, last, fits, done = [0] * (len(data) + 1), [-1] * (len(data) + 1), self.fits, 0
        for end, (size, token) in self.ending.iter(data.decode("latin-1")):
            if end < done:
                continue
            start = end + 1 - size
            before = last[start]
            known = fits.get(before << 32 | token)
            if known if known is not None else self._fit(before, token):
                done = end + 1
                counts[done], last[done] = counts[start] + 1, token
        if done < len(data):
            raise ValueError("the vocabulary lacks a byte")
        return counts

    def word_counts(self, word: str) -> list[int]:
        """Tokens of word[:i] by code point, where word is one pre-token."""
        known = self.words.get(word)
        if known is None:
            counts = self.byte_counts(word.encode())
            ends = np.cumsum([0, *(len(c.encode()) for c in word)]) if len(word) != len(counts) - 1 else None
            known = counts if ends is None else [counts[e] for e in ends]
            if len(word) <= LONGEST_CACHED:
                if len(self.words) > CACHED:
                    self.words.clear()
                self.words[word] = known
        return known

    def chunk_count(self, chunk: str) -> int:
        known = self.chunks.get(chunk)
        if known is None:
            known = sum(self.word_counts(word)[-1] for word in self.split(chunk))
            if len(chunk) <= LONGEST_CACHED:
                if len(self.chunks) > CACHED:
                    self.chunks.clear()
                self.chunks[chunk] = known
        return known

    def split(self, chunk: str) -> list[str]:
        """Pre-tokens; characters that are not assigned in Python's tables are classed by the library itself."""
        if chunk.isascii() or not any(unicodedata.category(c) == "Cn" for c in chunk):
            return WORD.findall(chunk)
        if self.library is None:
            from tokenizers.pre_tokenizers import ByteLevel

            self.library = ByteLevel(add_prefix_space=False)
        return [chunk[start:end] for _, (start, end) in self.library.pre_tokenize_str(chunk)]

    def parts(self, text: str) -> Iterator[tuple[bool, str]]:
        """The text between special strings, and these strings."""
        if self.special is None or not self.special.search(text):
            yield False, text
        else:
            for part in self.special.split(text):
                if part:
                    yield part in self.added, part

    def total(self, text: str) -> int:
        count, known = 0, self.chunks.get
        for special, part in self.parts(text):
            if special:
                count += 1
                continue
            for chunk in CHUNK.findall(part):
                found = known(chunk)
                count += self.chunk_count(chunk) if found is None else found
        return count

    def segments(self, text: str) -> list[str]:
        """The text in segments. A special string belongs to the segment before it, or is one where another one is before
        it: the count of a prefix that ends inside of it depends on the text before it."""
        if self.special is None or not self.special.search(text):
            return SEGMENT.findall(text)
        found: list[str] = []
        joined = False
        for special, part in self.parts(text):
            if special and joined:
                found[-1] += part
            else:
                found += [part] if special else SEGMENT.findall(part)
            joined = not special
        return found

    def segment_counts(self, segment: str) -> np.ndarray:
        """Tokens of segment[:i] for i = 0 … len(segment)."""
        special = next((t for t in self.added if segment.endswith(t)), "")
        body = segment[: len(segment) - len(special)]
        out, space = np.zeros(len(segment) + 1, np.int32), SPACE.match(body).end()
        if space:
            # At the end of a prefix, white space is one pre-token.
            out[: space + 1] = self.word_counts(body[:space])
        place = base = 0
        if space < len(body):
            for chunk in CHUNK.findall(body):
                for word in self.split(chunk):
                    counts = self.word_counts(word)
                    if word in CONTRACTIONS:
                        counts = [*counts[:2], sum(self.word_counts(c)[-1] for c in word[:2]), counts[3]]
                    begin = max(place, space)
                    if place + len(word) > space:
                        out[begin + 1 : place + len(word) + 1] = counts[begin + 1 - place :]
                        out[begin + 1 : place + len(word) + 1] += base
                    place, base = place + len(word), base + counts[-1]
        for i in range(1, len(special)):
            out[len(body) + i] = self.total(body + special[:i])
        if special:
            out[-1] = out[len(body)] + 1
        return out

    def known_counts(self, segment: str) -> np.ndarray:
        known = self.arrays.get(segment)
        if known is None:
            known = self.segment_counts(segment)
            if len(segment) <= LONGEST_CACHED:
                if len(self.arrays) > CACHED:
                    self.arrays.clear()
                self.arrays[segment] = known
        return known

    def index(self, text: str) -> tuple[list[int], list[int], list[int], list[str]]:
        """Starts of the segments (code points), the tokens up to there, the fewest tokens up to a place inside or at the
        end of each, and the segments: with the counts of each distinct segment, the count of every prefix."""
        starts, before, least, place, count = [], [], [], 0, 0
        segments = self.segments(text)
        for segment in segments:
            counts = self.known_counts(segment)
            starts.append(place)
            before.append(count)
            least.append(count + int(counts[1:].min()))
            place, count = place + len(segment), count + int(counts[-1])
        return starts, before, least, segments


def count_at(starts: Sequence[int], before: Sequence[int], counts: Callable[[int], Sequence[int]], size: int) -> int:
    """Tokens of text[:size], looked up: ``counts(k)`` are the stored counts of the k-th segment."""
    k = bisect_right(starts, size) - 1
    return before[k] + int(counts(k)[size - starts[k]]) if size and k >= 0 else 0


def longest_within(
    starts: Sequence[int], before: Sequence[int], least: Sequence[int], counts: Callable[[int], Sequence[int]], budget: int
) -> int:
    """The largest size such that text[:size] has at most ``budget`` tokens, looked up. Counts of prefixes may fall again,
    so the last segment that holds such a size is the one with the answer."""
    k = next((k for k in range(len(starts) - 1, -1, -1) if least[k] <= budget), None)
    if k is None:
        return 0
    return starts[k] + int(np.flatnonzero(np.asarray(counts(k))[1:] <= budget - before[k])[-1]) + 1


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def count_tokens(docs: DataFrame, path: str, *, key: str = "doc_id", text: str = "text", limit: int = 512) -> DataFrame:
    """Counts of whole texts: key, ``n_bytes``, ``n_tokens``, ``over_limit`` (more than ``limit`` tokens).

    ``path`` names the vocabulary file, which every worker can read. Null text is empty and has no tokens; repeated
    rows are counted each; other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path).total
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            sizes, tokens = [len(t.encode()) for t in texts], [count(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())], ["id", "n_bytes", "n_tokens"]
            )

    counted = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(
        run, f"id {kind}, n_bytes long, n_tokens long"
    )
    return counted.select(
        F.col("id").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


def segment_key(segment: str) -> bytes:
    return xxhash.xxh3_128_digest(segment.encode())


def prefix_index(docs: DataFrame, path: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Texts as references to stored counts: key, ``starts``, ``before``, ``least`` and ``segments`` (keys of
    :func:`segment_table`), see :meth:`PrefixCounter.index`. Null text is empty and has no segments."""
    kind = docs.schema[key].dataType.simpleString()
    integers = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = counter(path).index
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(begin, ROWS_AT_ONCE)
                found = [index(t or "") for t in part.column(1).to_pylist()]
                columns = [pa.array([f[k] for f in found], integers) for k in range(3)]
                keys = pa.array([[segment_key(s) for s in f[3]] for f in found], pa.list_(pa.binary()))
                yield pa.RecordBatch.from_arrays([part.column(0), *columns, keys], ["id", "starts", "before", "least", "segments"])

    return (
        docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
        .mapInArrow(run, f"id {kind}, starts array<int>, before array<int>, least array<int>, segments array<binary>")
        .withColumnRenamed("id", key)
    )


def segment_table(docs: DataFrame, path: str, *, text: str = "text") -> DataFrame:
    """Each distinct segment of the texts once: ``segment`` (its key) and ``tokens``, the count of every prefix of it.

    Tasks leave out what they wrote a short while ago, so common segments are few rows by the time they are shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_path, seen = counter(path), set()
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS_AT_ONCE):
                fresh: dict[str, np.ndarray] = {}
                for t in batch.column(0).slice(begin, ROWS_AT_ONCE).to_pylist():
                    for segment in by_path.segments(t or ""):
                        if segment not in seen and segment not in fresh:
                            fresh[segment] = by_path.known_counts(segment)
                if len(seen) > CACHED:
                    seen.clear()
                seen.update(s for s in fresh if len(s) <= LONGEST_CACHED)
                columns = [pa.array(list(map(segment_key, fresh)), pa.binary()), pa.array(list(fresh.values()), pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, ["segment", "tokens"])

    written = docs.select(text).mapInArrow(run, "segment binary, tokens array<int>")
    return written.groupBy("segment").agg(F.any_value("tokens").alias("tokens"))


def _looked_up(questions: DataFrame, segments: DataFrame) -> DataFrame:
    """Adds what the index has for the segment ``k`` (from 0, null for none), and its stored ``tokens``."""
    at = [F.get(c, F.col("k")).alias(f"_{c}") for c in ("starts", "before", "segments")]
    placed = questions.select("*", *at).drop("starts", "before", "least", "segments")
    stored = segments.select(F.col("segment").alias("_segments"), F.col("tokens").alias("_tokens"))
    return placed.join(stored, "_segments", "left")


def tokens_at(index: DataFrame, segments: DataFrame, cuts: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """Truncations: ``cuts`` (key, ``size`` in code points) with ``tokens``, those of the text cut there. Nothing is
    encoded. A size beyond the text counts the whole text, one below 0 or null gives null, as does an unknown key."""
    asked = cuts.select(key, "size").join(index, key)
    asked = asked.withColumn("k", F.size(F.filter("starts", lambda s: s < F.col("size"))) - 1)
    found = _looked_up(asked.withColumn("k", F.when(F.col("k") >= 0, F.col("k"))), segments)
    offset = F.least(F.col("size") - F.col("_starts"), F.size("_tokens") - 1).cast("int")
    tokens = F.when(F.col("size") >= 0, F.coalesce(F.col("_before") + F.get("_tokens", offset), F.lit(0)))
    known = found.select(key, "size", tokens.alias("tokens")).distinct()
    left = cuts.select(F.col(key).alias("_key"), F.col("size").alias("_size"))
    return left.join(known, F.col("_key").eqNullSafe(F.col(key)) & F.col("_size").eqNullSafe(F.col("size")), "left").select(
        F.col("_key").alias(key), F.col("_size").alias("size"), "tokens"
    )


def sizes_within(index: DataFrame, segments: DataFrame, budgets: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """Budgets: ``budgets`` (key, ``budget`` in tokens) with ``size``, that of the longest prefix with at most as many
    tokens, as code points. Nothing is encoded. Keys are unique in the index; unknown ones are left out."""
    asked = budgets.select(key, "budget").join(index, key)
    fits = F.filter(F.sequence(F.lit(0), F.size("least") - 1), lambda k: F.get("least", k) <= F.col("budget"))
    asked = asked.withColumn("k", F.when(F.size("least") > 0, F.array_max(fits)))
    found = _looked_up(asked, segments)
    places = F.sequence(F.lit(1), F.size("_tokens") - 1)
    offset = F.array_max(F.filter(places, lambda i: F.col("_before") + F.get("_tokens", i) <= F.col("budget")))
    return found.select(key, "budget", F.coalesce(F.col("_starts") + offset, F.lit(0)).alias("size"))
