"""Phrase collocations from FM-indexes of word ids, one for each shard of the corpus.

A task cuts its texts into pieces and words and writes, for each language, shards: a dictionary
and the sequence of word ids, with 0 between pieces. A shard's index sorts its places, and those
of the reversed sequence, as deep as the longest phrase. A phrase is an interval of either; a
word more on one side narrows both at once, through the transform of the one and the numbers of
smaller words in the other (bidirectional extension). So a shard gives all its phrases of one
length with their counts from those of the length before.

Levels: words, then phrases of two, three and four. A level's counts are summed over shards; only
shards' phrases that are frequent in the whole corpus come back to the shard, which extends these
alone, as a frequent phrase has frequent parts. What a level's phrases don't cover leaves the
shard's sequence. Nothing is kept of phrases that are rare everywhere, and no table is held whole
by the driver or a task.

Words travel as texts once. A frequent phrase gets a number, and longer phrases travel as two: that of
the phrase without its last word, and that of the last word. Texts are put together at the end, for
frequent phrases alone.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import discard, materialize, sweep, text_slices, tidy, utf8_parts, word_spans

#: Bytes of text in a shard; a longer text is a shard of its own. What is left of a language at the end of a task joins that of its neighbours: so many tasks in all.
SHARD, NEIGHBOURS = 8 << 20, 3

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ENDS_PIECE, _GAP = np.zeros(256, bool), np.zeros(256, bool)
_ENDS_PIECE[[*b".,;:!?\n\x0b\x0c\r"]] = True
_GAP[[*b" \t"]] = True
_GAP |= _ENDS_PIECE

#: Rows of shards: phrases (words by lang and gram, longer ones by prefix and word), and a sequence in each shard. spot: where a phrase stands, and how often, in one number.
_WORDS = "shard long, lang string, gram string, spot long, ids binary"
_PHRASES = "shard long, prefix long, word long, spot long, ids binary"


def _ranges(start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges start[i] .. start[i] + n[i] - 1, and of each the i."""
    of = np.repeat(np.arange(len(n)), n)
    return np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + start[of], of


class _Sorted:
    """Places of a sequence sorted by the ``depth`` ids from each on, and its Burrows-Wheeler transform."""

    def __init__(self, ids: np.ndarray, depth: int):
        self.ids, deep, key = ids, 1, ids.astype(np.int64)
        while True:
            # ranks of twice as many ids, until they are enough
            ahead = np.append(key[deep:], np.zeros(min(deep, len(key)), np.int64))
            key, deep = key * (int(key.max(initial=0)) + 1) + ahead, 2 * deep
            if deep >= depth:
                break
            key = np.unique(key, return_inverse=True)[1]
        self.order = np.argsort(key)
        self.rank = np.empty(len(ids), np.int64)
        self.rank[self.order] = np.arange(len(ids))
        self.before = ids[self.order - 1]  # the transform: the id before each place
        self.step = self.rank[self.order - 1]  # where the place before lies

    def interval(self, at: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
        """First row and length of the intervals of the phrases of so many words that begin at these places."""
        padded, new = np.append(self.ids, np.zeros(words, self.ids.dtype)), np.zeros(len(self.ids), bool)
        new[:1] = True
        for k in range(words):
            own = padded[self.order + k]
            new[1:] |= own[1:] != own[:-1]
        starts = np.flatnonzero(new)
        run = np.searchsorted(starts, self.rank[at], side="right") - 1
        return starts[run], np.diff(np.append(starts, len(self.ids)))[run]


class WordIndex:
    """Bidirectional FM-index of a sequence of word ids that begins and ends with 0, the end of a piece; phrases up to ``depth`` words."""

    def __init__(self, ids: np.ndarray, depth: int):
        self.ids, self.depth = ids, depth
        self.forward, self.back = _Sorted(ids, depth), _Sorted(ids[::-1], depth)

    def phrases(self, at: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(rows in the forward, rows in the backward index, counts, which of the places) of the phrases at these places, each phrase once."""
        low, n = self.forward.interval(at, words)
        low, first = np.unique(low, return_index=True)
        back, _ = self.back.interval(len(self.ids) - at[first] - words, words)
        return low, back, n[first], first

    @staticmethod
    def _extend(through: _Sorted, low: np.ndarray, other: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Intervals narrowed by each id that the transform holds in them, ends of pieces left out: (low, other, count, which it came from)."""
        rows, of = _ranges(low, n)
        ids = through.before[rows].astype(np.int64)
        order = np.argsort(of * (int(ids.max(initial=0)) + 1) + ids)
        rows, of, ids = rows[order], of[order], ids[order]
        cut = np.flatnonzero((np.diff(of, prepend=-1) != 0) | (np.diff(ids, prepend=-1) != 0))
        count = np.diff(np.append(cut, len(of)))
        smaller = cut - (np.cumsum(n) - n)[of[cut]]
        word = ids[cut] > 0
        # rows alike as deep as the index goes may change places, so the first is the least
        step = np.minimum.reduceat(through.step[rows], cut) if len(cut) else cut
        return step[word], (other[of[cut]] + smaller)[word], count[word], of[cut][word]

    def extend_right(self, low, back, n):
        """(forward rows, backward rows, counts, which phrase) of all phrases with one word more at the right."""
        new_back, new_low, count, of = self._extend(self.back, back, low, n)
        return new_low, new_back, count, of

    def extend_left(self, low, back, n):
        """The same with one word more at the left."""
        return self._extend(self.forward, low, back, n)

    def places(self, low: np.ndarray, n: np.ndarray) -> np.ndarray:
        """All places where the phrases of these intervals begin."""
        return self.forward.order[_ranges(low, n)[0]]


def _pack(ids: np.ndarray, numbers: np.ndarray | None = None) -> bytes:
    """A sequence and the numbers of its words, compressed: bytes of a place in the numbers stand together, as most of them are 0."""
    numbers = np.zeros(0, np.int64) if numbers is None else numbers
    planes = [np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes() for x in (ids.astype("<i4"), numbers.astype("<i8"))]
    head = np.array([len(ids), len(numbers)], "<i8").tobytes()
    return head + pa.compress(planes[0] + planes[1], codec="zstd", asbytes=True)


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, m = np.frombuffer(data, "<i8", 2).tolist()
    raw = np.frombuffer(pa.decompress(data[16:], decompressed_size=4 * n + 8 * m, codec="zstd", asbytes=True), np.uint8)
    planes = lambda part, width, kind: np.ascontiguousarray(part.reshape(width, -1).T).view(kind).ravel() if len(part) else np.zeros(0, kind)
    return planes(raw[: 4 * n], 4, "<i4"), planes(raw[4 * n :], 8, "<i8")


def _table(shard: int, keys: dict[str, pa.Array], at: np.ndarray, n: np.ndarray, held: bytes | None, total: int = 0, whole: dict[str, str] = {}) -> pa.Table:
    """Rows of a shard: one for each phrase, and one with its sequence, if it is needed further."""
    m, more = len(at), held is not None
    last = lambda c, kind: pa.array([whole.get(c)] * more, kind)
    columns = [
        pa.array([shard] * (m + more), pa.int64()), *(pa.concat_arrays([k, last(c, k.type)]) for c, k in keys.items()),
        pa.array(np.append(at + (n.astype(np.int64) << 32), [total] * more).astype(np.int64)), pa.array([None] * m + [held] * more, pa.binary()),
    ]
    return pa.Table.from_arrays(columns, ["shard", *keys, "spot", "ids"])


def _words(part: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The words of a slice of texts, whether one begins a piece, the row of each, and the bytes of each row."""
    data, off = utf8_parts(part.column(1))
    data = _LOWER[data]
    start, end, first = word_spans(data, off, _GAP)
    row = np.repeat(np.arange(part.num_rows), np.diff(first))
    ends = np.append(0, np.cumsum(_ENDS_PIECE[data], dtype=np.int64))
    begins = np.ones(len(start), bool)
    begins[1:] = (ends[start[1:]] > ends[end[:-1]]) | (row[1:] != row[:-1])
    at, _ = _ranges(start, end - start)
    offsets = np.append(0, np.cumsum(end - start)).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[at]))])
    return words, begins, row, np.diff(off)


def _first_level(docs: DataFrame, size: int) -> DataFrame:
    """Rows of all shards, with their words, for (lang, text)."""

    def run(batches):
        made = 0
        held: dict[str, list] = {}
        bytes_of: dict[str, int] = {}

        def flush(lang, full):
            nonlocal made
            words = pa.chunked_array([w for w, _ in held[lang]]).combine_chunks()
            begins = np.concatenate([b for _, b in held.pop(lang)])
            bytes_of.pop(lang)
            coded = words.dictionary_encode()
            # words in their order, so that neighbouring phrases begin alike
            order = pc.sort_indices(coded.dictionary).to_numpy()
            place_of = np.empty(len(order), np.int64)
            place_of[order] = np.arange(len(order))
            vocabulary, codes = coded.dictionary.take(pa.array(order)), place_of[coded.indices.to_numpy()]
            place = np.arange(len(codes)) + np.cumsum(begins)
            ids = np.zeros(len(codes) + int(begins.sum()) + 1, np.int32)
            ids[place] = codes + 1  # 0 ends a piece
            first = np.zeros(len(vocabulary), np.int64)
            first[codes[::-1]] = place[::-1]
            shard, made = (TaskContext.get().partitionId() << 32) + (made << 1) + full, made + 1
            keys = {"lang": pa.array([lang] * len(vocabulary), pa.string()), "gram": vocabulary.cast(pa.string())}
            return _table(shard, keys, first, np.bincount(codes, minlength=len(vocabulary)), _pack(ids), len(codes), {"lang": lang}).to_batches()

        for batch in batches:
            for part in text_slices(batch, batch.schema.names[1], min(size, 1 << 20)):
                words, begins, row, sizes = _words(part)
                langs = part.column(0).dictionary_encode()
                of = langs.indices.to_numpy()
                for k, lang in enumerate(langs.dictionary.to_pylist()):
                    own = of[row] == k
                    if own.any():
                        held.setdefault(lang, []).append((words.filter(pa.array(own)), begins[own]))
                        bytes_of[lang] = bytes_of.get(lang, 0) + int(sizes[of == k].sum())
                for lang in [x for x, n in bytes_of.items() if n >= size]:
                    yield from flush(lang, True)
                while sum(bytes_of.values()) > 4 * size:  # many languages
                    yield from flush(max(bytes_of, key=bytes_of.get), True)
        for lang in list(held):
            yield from flush(lang, False)

    return docs.mapInArrow(tidy(run), _WORDS)


def _joined(left: pa.Table, right: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The sequences of shards as one of frequent words alone, and the numbers of its words."""
    shards, at, named = right.column("shard").to_numpy(), right.column("at").to_numpy(), right.column("number").to_numpy()
    parts = [np.array([-1])]
    for shard, held in sorted(zip(left.column("shard").to_pylist(), left.column("ids").to_pylist())):
        ids, _ = _unpack(held)
        own, number_of = shards == shard, np.full(int(ids.max(initial=0)) + 1, -1)
        number_of[ids[at[own]]] = named[own]
        parts += [number_of[ids], np.array([-1])]
    numbers = np.concatenate(parts)
    ends = numbers < 0
    numbers = numbers[~(ends & np.append(False, ends[:-1]))]  # one end of a piece between
    return np.unique(numbers, return_inverse=True)[::-1]


def _next_level(shards: DataFrame, frequent: DataFrame, words: int, last: bool) -> DataFrame:
    """Rows of all shards with their phrases of so many words, from the frequent ones (shard, spot, number) of a word less.

    Before phrases of two, what was left at the end of neighbouring tasks becomes one shard for each language.
    """

    def extend(left: pa.Table, right: pa.Table) -> pa.Table:
        keys = lambda prefix, word: {"prefix": pa.array(prefix, pa.int64()), "word": pa.array(word, pa.int64())}
        none = np.zeros(0, np.int64)
        if not left.num_rows or not right.num_rows:
            return _table(0, keys(none, none), none, none, None)
        if words == 2:
            ids, numbers = _joined(left, right)
            at = np.unique(ids, return_index=True)[1][1:]
            named = numbers[ids[at]]
        else:
            ids, numbers = _unpack(left.column("ids")[0].as_py())
            at, named = right.column("at").to_numpy(), right.column("number").to_numpy()
        index = WordIndex(ids, words)
        low, back, n, first = index.phrases(at, words - 1)
        known = np.zeros(len(ids), bool)  # rows of the forward index whose phrase is frequent
        known[_ranges(low, n)[0]] = True
        low, _, n, of = index.extend_right(low, back, n)
        begin = index.forward.order[low]
        rest = known[index.forward.rank[begin + 1]]  # without its first word it is frequent too
        low, n, begin, of = low[rest], n[rest], begin[rest], of[rest]
        named = keys(named[first][of], numbers[ids[begin + words - 1]])
        shard = min(left.column("shard").to_pylist())
        if last or not len(low):
            return _table(shard, named, begin, n, None)
        # only what these phrases cover stays, with one end of a piece between
        cover = np.zeros(len(ids) + words, bool)
        starts = index.places(low, n)
        for k in range(words):
            cover[starts + k] = True
        cover = cover[: len(ids)]
        stays = cover | np.append(True, cover[:-1])
        place = np.cumsum(stays) - 1
        kept = np.append(np.where(cover, ids, 0)[stays], 0)
        used, new = np.unique(kept, return_inverse=True)
        if used[0]:  # 0 keeps its meaning
            used, new = np.append(0, used), new + 1
        return _table(shard, named, place[begin], n, _pack(new, numbers[used]))

    by = ["shard"]
    if words == 2:
        by, task = ["lang", "_group"], F.shiftright("shard", 32)
        group = F.when(F.col("shard").bitwiseAND(1) == 1, F.col("shard")).otherwise(-1 - F.floor(task / NEIGHBOURS))
        shards, frequent = shards.withColumn("_group", group), frequent.withColumn("_group", group)
    rows = shards.where("ids is not null").select(*by, *{"shard"} - {*by}, "ids")
    at = F.col("spot").bitwiseAND((1 << 32) - 1).alias("at")
    picked = frequent.select(*by, *{"shard"} - {*by}, at, "number")
    return rows.groupBy(*by).cogroup(picked.groupBy(*by)).applyInArrow(extend, _PHRASES)


def phrase_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = 30, most_words: int = 4, size: int = SHARD) -> tuple[DataFrame, list[DataFrame]]:
    """(lang, n), the number of all words of each language, and for each length from 1 the phrases (lang, gram, f) that occur ``least`` times or more."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    rows, path = materialize(_first_level(texts, size), "words", "zstd")
    words, _ = materialize(rows.where("ids is not null").groupBy("lang").agg(F.sum("spot").alias("n")), "languages")
    out, key = [], ["lang", "gram"]
    for length in range(1, most_words + 1):
        frequent, frequent_path = materialize(_frequent(rows.where(F.col(key[1]).isNotNull()), key, least), f"phrases-{length}", "zstd")
        out.append(_named(frequent.where("one"), out))
        sweep(spark)
        if length < most_words:
            rows, new = materialize(_next_level(rows, frequent, length + 1, length + 1 == most_words), "phrases", "zstd")
            discard(spark, path)
            path, key = new, ["prefix", "word"]
        discard(spark, frequent_path)
        sweep(spark)
    discard(spark, path)
    return words, out


def _frequent(grams: DataFrame, key: list[str], least: int) -> DataFrame:
    """(shard, key, spot, f, number, one): the rows of phrases that occur ``least`` times or more in all shards, with that sum and a number for the phrase; one of each phrase's rows is marked.

    A phrase has a row a shard at most. Rows are dealt by phrase; words are put in order by a hash
    first, made after they are dealt, as texts are slow to compare. A phrase's number is the least of those of its rows.
    """
    dealt = grams.select("shard", *key, "spot").repartition(*key).withColumn("_h", F.xxhash64(*key)).withColumn("_nth", F.monotonically_increasing_id())
    own = Window.partitionBy("_h", *key)
    summed = dealt.select("shard", *key, "spot", F.sum(F.shiftright("spot", 32)).over(own).alias("f"), F.min("_nth").over(own).alias("number"), "_nth")
    return summed.where(F.col("f") >= least).select("shard", *key, "spot", "f", "number", (F.col("_nth") == F.col("number")).alias("one"))


def _named(phrases: DataFrame, before: list[DataFrame]) -> DataFrame:
    """(number, lang, gram, f) of phrases, written: a text is that of its prefix and that of its last word, which have their texts already."""
    if before:
        prefix, word = before[-1].select(F.col("number").alias("prefix"), "lang", F.col("gram").alias("_begin")), before[0].select(F.col("number").alias("word"), F.col("gram").alias("_end"))
        phrases = phrases.join(prefix, "prefix").join(word, "word").withColumn("gram", F.concat_ws(" ", "_begin", "_end"))
    return materialize(phrases.select("number", "lang", "gram", "f"), "named-phrases")[0]


def _part(first: int, words: int, of: int):
    """words words of a phrase of ``of`` words, from the one numbered first on."""
    return F.substring_index(F.substring_index("gram", " ", first + words), " ", -words) if first + words < of else F.substring_index("gram", " ", -words)


def collocations(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = 30, most_words: int = 4, share: int = 80, top: int = 2000, scale: int = 2_000_000, size: int = SHARD
) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score, as ``op12`` defines them.

    Texts that are null count as empty, a null language as ``und``; a language without words has no
    row. Every row counts, repeated ones too; ids and other columns are not read. Equal scores go by
    count, then phrase in the order of its bytes, so ranks are unique. A text may have any
    length; a piece is never cut. Eager: the levels run when it is called.
    """
    words, levels = phrase_counts(docs, lang_col, text_col, least, most_words, size)
    union = lambda parts: reduce(DataFrame.unionAll, parts)
    levels = [level.drop("number") for level in levels]
    parts_of = union(levels[:-1])
    cuts = union([
        level.select("lang", "gram", F.col("f").alias("a"), F.lit(k).alias("k"), _part(0, k, m).alias("first"), _part(k, m - k, m).alias("rest"))
        for m, level in enumerate(levels[1:], 2) for k in range(1, m)
    ])
    cuts = cuts.join(parts_of.toDF("lang", "first", "l"), ["lang", "first"]).join(parts_of.toDF("lang", "rest", "r"), ["lang", "rest"])
    score = F.expr(f"CAST(a AS DECIMAL(20,0)) * CAST({scale} AS DECIMAL(17,0)) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    scored = cuts.groupBy("lang", "gram", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    inside = [
        level.select("lang", _part(i, w, m).alias("gram"), "f") for m, level in enumerate(levels[2:], 3) for w in range(2, m) for i in range(m - w + 1)
    ]
    if inside:
        longer = union(inside).groupBy("lang", "gram").agg(F.max("f").alias("longer"))
        scored = scored.join(longer, ["lang", "gram"], "left")
        held = F.col("longer").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * share
        scored = scored.where(F.col("longer").isNull() | ~held)
    best = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), F.asc("gram"))
    ranked = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(words, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), F.col("gram").alias("phrase"), "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score")
    )
