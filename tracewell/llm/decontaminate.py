"""Benchmark decontamination: CGK random-walk embedding, bit-sampling LSH, exact edit distance.

The embedding walks over a word sequence: at step j it writes the word at its place and moves on
if a random bit of (word, j) says so. Two sequences at a small edit distance fall into step again
after each edit, so that their walks agree at most steps (Chakraborty, Goldenberg, Koucky 2016).
A table samples some steps and hashes what the walk wrote there.

Windows are as long as an item allows: of each scale those that end within the item, from each of
its words on, so that a key never reads what follows the item in a document. ``walks`` repeats
the embedding with other random bits until the recall at the most edits allowed is 0.95 or more
for every length (``tests/llm/test_leaks.py`` measures it by length and number of edits).

An item of fewer than ``shortest`` words leaves the walks too few steps: with as many edits as it may
have no window of it may be clean. It is cut into one segment more than it may have edits, so
that one segment at least stands unedited wherever the item does, and is looked up by these: the
windows of such an item are its segments, and nothing is missed.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import SLICE, mix64, span_hashes, text_slices, tidy, utf8_parts, word_spans

#: Bytes that are part of no word: ASCII but for letters and digits.
_GAP = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


@dataclass(frozen=True)
class Params:
    """similarity: least 1 - distance / words of the item, distances counted in words.
    walks: embeddings with random bits of their own. scales: for each table the number of steps
    that it samples from, one in each of ``sampled`` equal parts; a short scale needs a few words
    without edits, a long one bridges edits. shortest: items of so many words or more are looked up by walks."""

    similarity: float = 0.8
    walks: int = 2
    scales: tuple[int, ...] = (12, 14, 18, 32)
    sampled: int = 6
    shortest: int = 14
    seed: int = 11


def words_of(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all rows, A-Z in lower case, and the first word of each row (n + 1)."""
    data = _FOLD[data]
    starts, ends, first = word_spans(data, off, _GAP)
    return span_hashes(data, starts, ends), first


def _steps(p: Params) -> list[list[set[int]]]:
    """By walk and table: the sampled steps."""
    rng = np.random.default_rng(p.seed)
    cuts = [np.linspace(0, scale, p.sampled + 1).round().astype(int) for scale in p.scales]
    return [[{int(rng.integers(lo, hi)) for lo, hi in zip(c[:-1], c[1:])} for c in cuts] for _ in range(p.walks)]


def window_keys(words: np.ndarray, first: np.ndarray, p: Params, with_ends: bool = False):
    """For each walk and table, the key of the window that starts at each word, and if asked for whether it ends within its row.

    first: the first word of each row (n + 1). Rows are padded with a sign on which a walk stays.
    """
    n_rows, row_of = len(first) - 1, np.repeat(np.arange(len(first) - 1), np.diff(first))
    places = np.arange(len(words)) + row_of  # one sign after each row
    padded = np.zeros(len(words) + n_rows, np.uint64)
    padded[places] = words
    is_word = np.zeros(len(padded), bool)
    is_word[places] = True
    for walk, tables in enumerate(_steps(p)):
        bits = mix64(padded + np.uint64((walk + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        bits[~is_word] = 0
        at = places.copy()
        keys = [np.full(len(words), walk * 64 + t + 1, np.uint64) for t in range(len(tables))]
        inside = [None] * len(tables)
        for j in range(max(p.scales)):
            used = [t for t, steps in enumerate(tables) if j in steps]
            if used:
                wrote = padded.take(at, mode="clip")
                factor = np.uint64(pow(0xD6E8FEB86659FD93, j + 1, 1 << 64))
                wrote *= factor
                for t in used:
                    keys[t] += wrote
                    if with_ends and j == max(tables[t]):
                        inside[t] = is_word.take(at, mode="clip")
            at += ((bits >> np.uint64(j)).astype(np.uint8) & np.uint8(1)).take(at, mode="clip")
        for t, key in enumerate(keys):
            yield key, inside[t]


def segments(n: int, p: Params) -> list[tuple[int, int]]:
    """(start, length) of the segments of an item of n words, one more than the edits it may have."""
    cuts = np.linspace(0, n, min(n, _most(n, p) + 1) + 1).round().astype(int).tolist()
    return [(a, b - a) for a, b in zip(cuts[:-1], cuts[1:])]


def _most(n: int, p: Params) -> int:
    return int(n * (1 - p.similarity) + 1e-9)


def run_keys(words: np.ndarray, longest: int):
    """For each length up to the longest, the key of the run of so many words that starts at each word, as long as there are words."""
    key = np.zeros(len(words), np.uint64)
    for length in range(1, longest + 1):
        key = key[: max(0, len(words) - length + 1)] * np.uint64(0x9E3779B97F4A7C15) + words[length - 1 :]
        yield length, mix64(key ^ np.uint64(length))


def _spans_of(group: np.ndarray, low: np.ndarray, high: np.ndarray, reach: np.ndarray | int) -> np.ndarray:
    """For rows sorted by group, then low: which begin a span, if those of one group that lie within reach of each other are one."""
    if not len(group):
        return np.zeros(0, bool)
    new = np.ones(len(group), bool)
    new[1:] = group[1:] != group[:-1]
    # the furthest end so far within the group: ends are made to grow from group to group
    lift = np.cumsum(new) * (int(high.max()) - int(low.min()) + 2 * int(np.max(reach)) + 2)
    furthest = np.maximum.accumulate(high + lift)
    new[1:] |= (low + lift)[1:] > furthest[:-1] + np.broadcast_to(reach, len(group))[1:]
    return new


class Index:
    """The items' word sequences and, by key, the items that have it and where. Small: it grows with a part of the benchmark alone."""

    def __init__(self, items: list[tuple[int, str]], p: Params):
        self.p, self.ids = p, [i for i, _ in items]
        self.words: list[np.ndarray] = []
        keys, numbers, places, self.lengths = [], [], [], set()
        for k, (_, text) in enumerate(items):
            data = np.frombuffer((text or "").encode(), np.uint8)
            words, _ = words_of(data, np.array([0, len(data)]))
            self.words.append(words)
            n = len(words)
            if n < p.shortest:
                of_length = dict(run_keys(words, n))
                for start, length in segments(n, p):
                    self.lengths.add(length)
                    keys.append(of_length[length][start : start + 1])
                    places.append(np.array([start]))
                    numbers.append(np.array([k]))
                continue
            for key, inside in window_keys(words, np.array([0, n]), p, with_ends=True):
                keys.append(key[inside])
                places.append(np.flatnonzero(inside))
                numbers.append(np.full(int(inside.sum()), k))
        empty = np.zeros(0, np.int64)
        key, item, place = (np.concatenate(x) if x else empty for x in (keys, numbers, places))
        order = np.lexsort((place, item, key))
        key, item, place = key[order].astype(np.uint64), item[order], place[order]
        # of an item's places with one key the first and the last
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (item[1:] != item[:-1])
        starts = np.flatnonzero(new)
        self.item, self.place, self.last = item[starts], place[starts], np.maximum.reduceat(place, starts) if len(starts) else empty
        self.keys, self.of = np.unique(key[starts], return_index=True)
        self.of = np.append(self.of, len(starts))
        self.sieve = np.zeros(1 << 22, bool)
        self.sieve[self.keys >> np.uint64(42)] = True
        self.long = np.array([len(w) for w in self.words], np.int64)
        self.most = np.array([_most(len(w), p) for w in self.words], np.int64)
        # the words of short items side by side
        self.padded = np.zeros((len(self.words), p.shortest), np.uint64)
        for k in np.flatnonzero(self.long <= p.shortest).tolist():
            self.padded[k, : self.long[k]] = self.words[k]

    def candidates(self, words: np.ndarray, first: np.ndarray) -> np.ndarray:
        """(row, item number, first and last word at which the item may start), at most one of a row and item within an item's length.

        Places of one key in a row that follow each other closely are one before its items are looked
        at, and so are those of one item: a text of one word again and again is one candidate for each item.
        """
        rows = np.repeat(np.arange(len(first) - 1), np.diff(first))
        left = np.repeat(first[1:], np.diff(first)) - np.arange(len(words))  # words to the row's end
        walks = ((0, key) for key, _ in window_keys(words, first, self.p))
        runs = ((length, key) for length, key in run_keys(words, max(self.lengths, default=0)) if length in self.lengths)
        hits = []
        for length, key in chain(walks, runs):
            at = np.flatnonzero(self.sieve[key >> np.uint64(42)])
            nth = np.searchsorted(self.keys, key[at])
            held = (nth < len(self.keys)) & (left[at] >= length)  # a run ends within its row
            at, nth = at[held], nth[held]
            same = self.keys[nth] == key[at]
            hits.append(np.stack([nth[same], at[same]], 1))
        hit = np.concatenate(hits) if hits else np.zeros((0, 2), np.int64)
        nth, at = hit[np.lexsort((hit[:, 1], hit[:, 0]))].T
        row = rows[at]
        reach = int(self.long.max(initial=0))
        starts = np.flatnonzero(_spans_of(nth * len(first) + row, at, at, reach))
        if not len(starts):
            return np.zeros((0, 4), np.int64)
        low, high, nth, row = at[starts], np.maximum.reduceat(at, starts), nth[starts], row[starts]
        n = self.of[nth + 1] - self.of[nth]
        held = np.repeat(self.of[nth] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        row, item, low, high = np.repeat(row, n), self.item[held], np.repeat(low, n) - self.last[held], np.repeat(high, n) - self.place[held]
        order = np.lexsort((low, item, row))
        row, item, low, high = row[order], item[order], low[order], high[order]
        starts = np.flatnonzero(_spans_of(row * len(self.long) + item, low, high, self.long[item]))
        return np.stack([row[starts], item[starts], low[starts], np.maximum.reduceat(high, starts)], 1)

    def holds_words(self, words: np.ndarray, item: np.ndarray, lo: np.ndarray, hi: np.ndarray, widest: int = 64) -> np.ndarray:
        """For candidates whether the words from lo to hi may hold the item: all but as many of its words as may be edited stand there.

        An edit takes one word of the item at most, so nothing is lost. Held against whole arrays of
        candidates with narrow windows, as common words of short items make many of them; the others may hold it.
        """
        may = np.ones(len(item), bool)
        narrow = np.flatnonzero((hi - lo <= widest) & (self.long[item] <= self.padded.shape[1]))
        for at in np.array_split(narrow, -(-len(narrow) // 8192) or 1):
            if len(at):
                reach = np.arange(int((hi - lo)[at].max()))
                inside = lo[at, None] + reach < hi[at, None]
                near = np.where(inside, words.take(lo[at, None] + reach, mode="clip"), 0)
                wanted, found = self.padded[item[at]], np.zeros(len(at), np.int64)
                for k in range(wanted.shape[1]):
                    found += ((near == wanted[:, k, None]) & inside).any(1) & (k < self.long[item[at]])
                may[at] = found >= self.long[item[at]] - self.most[item[at]]
        return may

    def matches(self, data: np.ndarray, off: np.ndarray) -> list[tuple[int, int, int]]:
        """(row, item number, distance) for each row and item within the distance."""
        words, first = words_of(data, off)
        out: dict[tuple[int, int], int] = {}
        found = self.candidates(words, first) if len(self.keys) else np.zeros((0, 4), np.int64)
        row, item, low, high = found.T
        lo = np.maximum(first[row], low - 2 * self.most[item])
        hi = np.minimum(first[row + 1], high + self.long[item] + 3 * self.most[item] + 1)
        may = self.holds_words(words, item, lo, hi)
        for row, item, lo, hi in np.stack([row, item, lo, hi], 1)[may].tolist():
            most = int(self.most[item])
            if out.get((row, item)) == 0:
                continue
            distance = substring_distance(self.words[item], words[lo:hi])
            if distance <= most:
                out[row, item] = min(distance, out.get((row, item), distance))
        return [(row, item, d) for (row, item), d in out.items()]


def substring_distance(pattern: np.ndarray, text: np.ndarray) -> int:
    """Least edit distance, in words, of the pattern to any run of words of the text (bit-parallel, exact)."""
    m = len(pattern)
    if m == 0:
        return 0
    where: dict[int, int] = {}
    for i, w in enumerate(pattern.tolist()):
        where[w] = where.get(w, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best = m
    for w in text.tolist():
        eq = where.get(w, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        ph, mh = (down | ~(xh | up)) & full, up & xh
        score += bool(ph & top) - bool(mh & top)
        ph, mh = ph << 1, mh << 1
        up, down = (mh | ~(xv | ph)) & full, ph & xv & full
        if score < best:
            best = score
            if not best:
                break
    return best


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    params: Params = Params(),
    part_items: int = 100_000,
) -> DataFrame:
    """(id, item_id, distance, similarity, contaminated) for each row and item that its text holds.

    Words are runs of letters and digits, A-Z in lower case. A row holds an item if some run of
    its words is within ``1 - similarity`` of the item's words in edit distance. Tasks read the
    benchmark in parts of about ``part_items`` items, each in a pass over the documents: one pass for
    any but the largest benchmarks. Items without a word, null ones too, match nothing; null and
    empty texts hold nothing; repeated item ids are items of their own. Each row of a repeated
    document yields its own matches. Works row by row on whole texts: nothing shuffles.
    """
    items = benchmark.select(F.col(item_id_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text")).where(F.col("text").isNotNull())
    parts = max(1, -(-items.count() // part_items))
    dealt = items.withColumn("_part", F.pmod(F.xxhash64("text"), F.lit(parts)).cast("int"))
    found = [_pass(docs, dealt.where(F.col("_part") == k), id_col, text_col, params) for k in range(parts)]
    return reduce(DataFrame.unionAll, found).withColumn("contaminated", F.lit(True))


def _pass(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, params: Params) -> DataFrame:
    """(id, item_id, distance, similarity) for a part of the benchmark, of a size that a task can read."""
    index = Index([(r["item_id"], r["text"]) for r in items.collect()], params)
    shared = docs.sparkSession.sparkContext.broadcast(index)
    id_kind, item_kind = docs.schema[id_col].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()

    def run(batches):
        own = shared.value
        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                got = own.matches(*utf8_parts(part.column(1)))
                rows = pa.array([row for row, _, _ in got], pa.int64())
                size = np.array([len(own.words[item]) for _, item, _ in got], float)
                distance = np.array([d for _, _, d in got], np.int64)
                ids = pa.array([own.ids[item] for _, item, _ in got], ids_type)
                yield pa.record_batch([part.column(0).take(rows), ids, pa.array(distance), pa.array(1 - distance / np.maximum(size, 1))], [id_col, "item_id", "distance", "similarity"])

    ids_type = to_arrow_type(items.schema["item_id"].dataType)
    texts = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    return texts.mapInArrow(tidy(run), f"`{id_col}` {id_kind}, item_id {item_kind}, distance long, similarity double")
