"""SimHash near-duplicates found through Golay-code fuzzy hashing.

A fingerprint has 64 bits, and two that link differ in ``3`` or fewer. Cut each into three
segments: A and B of 23 bits, C of 18. The perfect binary Golay code [23, 12, 7] decodes A or B to
the index of the nearest codeword (12 bits); a word at the rim of its sphere, three errors away,
also gets the five codewords at distance four. Two words with one error between them then share
an index (if their nearest codewords differ, both lie at their spheres' rims, and each one's
codeword is at distance four of the other). Keys join two or three segments, so that each has 30
bits or more and random fingerprints rarely meet. Where the three errors may be:

  none in C: A or B has one at most: C and an index of A, or C and an index of B
  two or three in C: one at most in A and B together: A and an index of B, or B and an index of A
  one in C: half of C has none, and of A and B
    one has none: A and the half of C, or B and the half of C
    both have one: half of each has none: a half of A, of B and of C

So a fingerprint has about 33 keys, links share one, and a join of equal keys with an exact count of
differing bits finds every link and nothing else.

Three differing bits reach pairs that share nearly all their shingles: at a Jaccard similarity of
0.8 two fingerprints differ in about ten bits, too many for keys that are selective. Where a
similarity is asked for, ``near_duplicates`` therefore adds links of a second kind: sketches of
shingle minima give banded keys, pairs whose sketches are clearly too unlike are left out, and the
others are decided by the exact Jaccard similarity of their sets of shingles.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, join_groups, materialize, mix64, sweep, text_slices, tidy
from .graph import components

#: The Golay code's generator polynomial x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GOLAY = 0b110001110101
#: Fixed value: the seed of the shingles' hash.
SEED = 42

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


#: Bands that give keys, minima in each of them, and minima in a sketch, each of a hash function of its own.
BANDS, ROWS = 20, 6
SKETCH = BANDS * ROWS
#: Sketches less similar than asked for by more than this are not held against each other exactly: five standard errors.
MARGIN = 0.18
_DRAWN = np.random.default_rng(SEED)
_FLIP, _FACTOR = _DRAWN.integers(0, 1 << 32, SKETCH, np.uint32), _DRAWN.integers(0, 1 << 31, SKETCH, np.uint32) * np.uint32(2) + np.uint32(1)


def shingle_hashes(text: bytes, n: int) -> np.ndarray:
    """XXH64 of a text's word shingles, repeats included; of the whole sequence if it is shorter; none without words."""
    words = text.translate(_LOWER).split()
    if len(words) < n:
        shingles = [b" ".join(words)] if words else []
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(n))))
    return np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64)


def fingerprint(text: bytes, n: int = 3) -> int:
    """SimHash of a text's word shingles; 0 if it has no word."""
    return _simhash(shingle_hashes(text, n))


def sketch(h: np.ndarray) -> np.ndarray:
    """The smallest hash of a text's shingles under each of the functions; h isn't empty."""
    low = (h >> np.uint64(32)).astype(np.uint32) ^ h.astype(np.uint32)
    out = np.full(SKETCH, 0xFFFFFFFF, np.uint32)
    for part in np.array_split(low, max(1, len(low) // 256)):
        mixed = (part[:, None] ^ _FLIP) * _FACTOR
        np.minimum(out, ((mixed ^ mixed >> np.uint32(15)) * _FACTOR[::-1]).min(0), out=out)
    return out


def sketch_similarity(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of pairs of sketches, a pair a row."""
    return (a == b).mean(1)


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each sketch."""
    keys = np.full((len(sketches), BANDS), np.arange(1, BANDS + 1), np.uint64)
    for r in range(ROWS):
        keys = mix64(keys * np.uint64(31) + sketches[:, r::ROWS].astype(np.uint64))
    return keys


class Banding(NamedTuple):
    """How sketches make keys: a function from sketches to a row of keys each, the minima in a sketch, and how far below the similarity an estimate may lie."""

    keys: Callable[[np.ndarray], np.ndarray]
    width: int
    margin: float


PLAIN = Banding(band_keys, SKETCH, MARGIN)


def _simhash(h: np.ndarray) -> int:
    if not len(h):
        return 0
    ones = np.zeros(64, np.int64)
    for part in np.array_split(h, max(1, len(h) // 8192)):
        ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3, with_sketch: bool = False) -> DataFrame:
    """(id, fp[, node, of, sketch]) of every row; fp is the 64 bits as a signed long.

    node is a hash of the text's set of shingles, of one of the text. Null and empty texts get
    fingerprint 0 and neither node nor sketch.
    """

    def run(batches):
        for batch in batches:
            prints, sketches, sets = np.zeros(batch.num_rows, np.uint64), [], []
            for i, text in enumerate(batch.column(1).cast(pa.binary())):
                h = shingle_hashes(text.as_py() or b"", n)
                prints[i] = _simhash(h)
                if with_sketch:
                    sketches.append(sketch(h).tobytes() if len(h) else None)
                    sets.append(np.uint64(xxhash.xxh64_intdigest(np.unique(h), SEED)).astype(np.int64) if len(h) else None)
            columns, names = [batch.column(0), pa.array(prints.view(np.int64))], [id_col, "fp"]
            if with_sketch:
                columns, names = [*columns, pa.array(sets, pa.int64()), batch.column(2), pa.array(sketches, pa.binary())], [*names, "node", "of", "sketch"]
            yield pa.record_batch(columns, names)

    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(id_col, text_col, *[F.xxhash64(text_col).alias("_of")] * with_sketch)
    return texts.mapInArrow(tidy(run), f"`{id_col}` {kind}, fp long" + ", node long, of long, sketch binary" * with_sketch)


def shingle_sets(texts: DataFrame, n: int) -> DataFrame:
    """(node, shingles) for (node, text): the distinct hashes of each text's shingles."""

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text", 1 << 20):
                held = [np.unique(shingle_hashes(text.as_py(), n)).view(np.int64) for text in part.column(1).cast(pa.binary())]
                yield pa.record_batch([part.column(0), pa.array(held, pa.list_(pa.int64()))], ["node", "shingles"])

    return texts.select("node", "text").mapInArrow(tidy(run), "node long, shingles array<long>")


def alike(a: list[np.ndarray], b: list[np.ndarray], similarity: float) -> np.ndarray:
    """For each pair of two lists of sets (sorted arrays of distinct numbers) whether their Jaccard similarity reaches the one asked for.

    As whole numbers of millionths, so that a similarity of exactly 0.8 counts.
    """
    sets, n = [*a, *b], len(a)
    size = np.array([len(x) for x in sets], np.int64)
    of, number = np.repeat(np.arange(len(sets)), size), np.unique(np.concatenate(sets), return_inverse=True)[1]
    left, right = np.bincount(number[of < n], minlength=number.max() + 1), np.bincount(number[of >= n], minlength=number.max() + 1)
    column = np.cumsum((left > 0) & (right > 0)) - 1  # others count for no pair
    used = ((left > 0) & (right > 0))[number]
    of, at = of[used], column[number[used]]
    shared = np.zeros((n, len(b)), np.int64)
    for lo in range(0, int(at.max(initial=-1)) + 1, 8192):
        part = (at >= lo) & (at < lo + 8192)
        held = np.zeros((len(sets), min(8192, int(at.max()) + 1 - lo)), np.float32)
        held[of[part], at[part] - lo] = 1
        shared += np.rint(held[:n] @ held[n:].T).astype(np.int64)
    return shared * 1_000_000 >= (size[:n, None] + size[None, n:] - shared) * round(similarity * 1_000_000)


def _of_blocks(rows: DataFrame, found, schema: str) -> DataFrame:
    """What ``found`` makes of each block: a table of the rows (key, i, j, side, node, root, ...) that share (key, i, j)."""

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            keys = np.stack([held.column(c).to_numpy() for c in ("key", "i", "j")])
            cut = np.append(0, np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1)
            for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
                yield from found(held.slice(lo, hi - lo).combine_chunks())
            held = held.slice(int(cut[-1]))
        if held is not None and held.num_rows:
            yield from found(held.combine_chunks())

    return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(tidy(run), schema)


def _likely_in_block(rows: DataFrame, similarity: float, banding: Banding) -> DataFrame:
    """Rows (key, i, j, side, node, root) of those of (..., sketch) that some row of the block's other side, of another root, may be similar to."""

    def likely(block):
        side, root = block.column("side").to_numpy(), block.column("root").to_numpy()
        sketches = np.frombuffer(b"".join(block.column("sketch").to_pylist()), np.uint32).reshape(-1, banding.width)
        x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        least, keep = (similarity - banding.margin) * banding.width, np.zeros(len(side), bool)
        for a in np.array_split(x, -(-len(x) // 256) or 1):
            for b in np.array_split(y, -(-len(y) // 256) or 1):
                if len(a) and len(b):
                    same = np.zeros((len(a), len(b)), np.uint16)
                    for k in range(banding.width):
                        same += sketches[a, k][:, None] == sketches[b, k][None, :]
                    pairs = (same >= least) & (root[a][:, None] != root[b][None, :])
                    keep[a] |= pairs.any(1)
                    keep[b] |= pairs.any(0)
        return block.select(["key", "i", "j", "side", "node", "root"]).filter(pa.array(keep)).to_batches()

    return _of_blocks(rows, likely, "key long, i int, j int, side int, node long, root long")


def _block_links(rows: DataFrame, similarity: float) -> DataFrame:
    """(a, b) from rows (key, i, j, side, node, root, shingles): links between the sides of each block (key, i, j), of different roots.

    Pairs are held against each other where the block is and never become rows; of the links of a
    node those to one root are one.
    """

    def links(block):
        side = block.column("side").to_numpy()
        node, root = block.column("node").to_numpy(), block.column("root").to_numpy()
        sets = [x.values.to_numpy() for x in block.column("shingles")]
        x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(x) or not len(y):
            return
        size = np.array([len(s) for s in sets])

        def parts(of):  # by size, of 256 sets and a million shingles or so, or of one set
            of = of[np.argsort(size[of], kind="stable")]
            return np.split(of, np.flatnonzero(np.diff(np.cumsum(size[of]) // 1_000_000) | np.diff(np.arange(len(of)) // 256)) + 1)

        for a in parts(x):
            for b in parts(y):
                if min(size[a[-1]], size[b[-1]]) < similarity * max(size[a[0]], size[b[0]]) - 1:
                    continue  # the larger sets of one are too small for the smaller sets of the other
                at, to = np.nonzero(alike([sets[k] for k in a], [sets[k] for k in b], similarity) & (root[a][:, None] != root[b][None, :]))
                if len(at):
                    _, first = np.unique(np.stack([at, root[b[to]]]), axis=1, return_index=True)
                    yield pa.record_batch([pa.array(node[a[at[first]]]), pa.array(node[b[to[first]]])], ["a", "b"])

    return _of_blocks(rows, links, "a long, b long")


def similar_links(nodes: DataFrame, similarity: float, sets_of, banding: Banding = PLAIN, rows: int = 2048, shingles: int = 2_000_000) -> DataFrame:
    """(a, b) for nodes (node, sketch), nodes being distinct: links that join what all links within buckets join.

    First every node is held against a representative of each of its buckets: the node that meets
    most others over all its buckets, which in a family of edited copies is the one that they were
    made from, and the smallest. Then the members of a bucket that these links haven't joined to
    its largest component are held against all its members, in blocks whose sides hold ``rows``
    members or ``shingles`` shingles at most on average: no pair is left out but those that are
    joined already, and none becomes a row unless it links. Buckets of the same members are one.

    Pairs are decided by their sets of shingles, which ``sets_of`` gives as (node, shingles) for a
    table of nodes; only those whose sketches come near the similarity.
    """
    spark = nodes.sparkSession

    def keys(batches):
        for batch in batches:
            if batch.num_rows:
                sketches = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, banding.width)
                k = banding.keys(sketches).view(np.int64)
                yield pa.record_batch([pa.array(k.ravel()), pa.array(np.repeat(batch.column(0).to_numpy(), k.shape[1]))], ["key", "node"])

    def verify(batches):
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint32).reshape(-1, banding.width) for i in (2, 3))
                yield batch.select([0, 1]).filter(pa.array(sketch_similarity(a, b) >= similarity - banding.margin))

    def verified(pairs):
        a, b = nodes.toDF("node", "_sa"), nodes.toDF("other", "_sb")
        both = pairs.join(a, "node").join(b, "other").select("node", "other", "_sa", "_sb")
        likely, likely_path = materialize(both.mapInArrow(tidy(verify), "a long, b long"), "likely-links")
        exact = likely.join(sets.toDF("a", "_ha"), "a").join(sets.toDF("b", "_hb"), "b")
        shared = F.size(F.array_intersect("_ha", "_hb")).cast("long")
        same = shared * 1_000_000 >= (F.size("_ha") + F.size("_hb") - shared) * F.lit(round(similarity * 1_000_000)).cast("long")
        links, _ = materialize(exact.where(same).select("a", "b"), "similar-links")
        discard(spark, likely_path)
        return links

    keyed_nodes, path = materialize(nodes.select("node", "sketch").mapInArrow(tidy(keys), "key long, node long"), "sketch-keys")
    counts = keyed_nodes.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared, shared_path = materialize(keyed_nodes.join(counts, "key"), "shared-keys")
    discard(spark, path)
    # once for both steps, as every row's text shuffles for it
    sets, sets_path = materialize(sets_of(shared.select("node").distinct()), "shingle-sets")
    sweep(spark)
    degree = shared.groupBy("node").agg(F.sum("n").alias("degree"))
    ranked = shared.join(degree, "node").select("key", "node", F.struct(F.col("degree"), F.col("node")).alias("rank"))
    heads = ranked.groupBy("key").agg(F.max("rank")["node"].alias("hub"), F.min("node").alias("low"))
    pairs = shared.join(heads, "key").select("node", F.explode(F.array("hub", "low")).alias("other")).where("node <> other").distinct()
    star = verified(pairs)
    sweep(spark)
    first, first_path = components(star)
    roots = shared.join(first, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    labelled, labelled_path = materialize(roots, "sketch-labels")
    discard(spark, shared_path, first_path)
    sizes = sets.select("node", F.size("shingles").cast("long").alias("size"))
    by_root = labelled.join(sizes, "node").groupBy("key", "root").agg(
        F.count("*").alias("n"), F.sum("size").alias("size"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("mark")
    )
    of_key = by_root.groupBy("key").agg(
        F.max(F.struct("n", "root", "size")).alias("most"), F.sum("n").alias("n"), F.sum("size").alias("size"), F.sum("mark").alias("mark"), F.count("*").alias("roots")
    )
    # of buckets with the same members one
    of_key = of_key.where("roots > 1").groupBy("n", "mark").agg(F.min(F.struct("key", "most", "size")).alias("one")).select("n", "one.*")
    blocks = lambda n, size: F.ceil(F.greatest(n / rows, size / shingles)).cast("int")
    of_key = of_key.select(
        "key", F.col("most.root").alias("most"), blocks(F.col("n") - F.col("most.n"), F.col("size") - F.col("most.size")).alias("nx"), blocks(F.col("n"), F.col("size")).alias("ny")
    )
    open_, open_path = materialize(labelled.join(of_key, "key"), "open-keys")
    dealt = lambda k, n: F.pmod(F.xxhash64(F.lit(k), F.col("node")), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    x = open_.where("root <> most").select("key", dealt(1, "nx").alias("i"), every("ny").alias("j"), F.lit(0).alias("side"), "node", "root")
    y = open_.select("key", every("nx").alias("i"), dealt(2, "ny").alias("j"), F.lit(1).alias("side"), "node", "root")
    # sketches go first: sets travel only to where a pair may be similar
    all_rows = x.unionAll(y).join(nodes.select("node", "sketch"), "node").select("key", "i", "j", "side", "node", "root", "sketch")
    likely, likely_path = materialize(_likely_in_block(all_rows, similarity, banding), "likely-in-block")
    sweep(spark)
    more, _ = materialize(_block_links(likely.join(sets, "node").select("key", "i", "j", "side", "node", "root", "shingles"), similarity), "block-links")
    discard(spark, likely_path)
    discard(spark, labelled_path, open_path, sets_path)
    sweep(spark)
    return star.unionAll(more)


def _golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of all 23-bit words' two parts, and by syndrome the error patterns that lead to codewords."""

    def syndrome(x: int) -> int:
        for i in range(22, 10, -1):
            if x >> i & 1:
                x ^= GOLAY << (i - 11)
        return x

    low = np.array([syndrome(x) for x in range(1 << 12)], np.int64)
    high = np.array([syndrome(x << 12) for x in range(1 << 11)], np.int64)
    unit = [syndrome(1 << i) for i in range(23)]
    errors: list[list[int]] = [[] for _ in range(1 << 11)]
    rim = set()
    for weight in range(5):
        for places in combinations(range(23), weight):
            s = e = 0
            for p in places:
                s, e = s ^ unit[p], e | 1 << p
            if weight < 4 or s in rim:
                errors[s].append(e)
            if weight == 3:
                rim.add(s)
    table = np.array([e + [-1] * (6 - len(e)) for e in errors], np.int64)
    return low, high, table


_TABLES: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []


def golay_indices(words: np.ndarray) -> np.ndarray:
    """For each 23-bit word the indices of its near codewords: 1 or 6, padded with -1."""
    if not _TABLES:
        _TABLES.append(_golay_tables())
    low, high, table = _TABLES[0]
    errors = table[low[words & 0xFFF] ^ high[words >> 12]]
    return np.where(errors < 0, -1, (words[:, None] ^ errors) >> 11)


def keys_of(fp: np.ndarray) -> np.ndarray:
    """The keys of each fingerprint, padded with -1: a kind in the high bits, then the parts that it joins."""
    fp = fp.view(np.uint64)
    part = lambda at, n: ((fp >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64)
    a, b, c = part(0, 23), part(23, 23), part(46, 18)
    near_a, near_b = golay_indices(a), golay_indices(b)
    halves = [(x & 0xFFF, x >> 12) for x in (a, b)] + [(c & 0x1FF, c >> 9)]
    out = []

    def add(*parts: tuple[np.ndarray, int], near: np.ndarray | None = None) -> None:
        key = np.full(len(fp), len(out) + 1, np.int64)
        for values, bits in parts:
            key = key << bits | values
        out.append(key[:, None] if near is None else np.where(near < 0, -1, key[:, None] << 12 | near))

    add((c, 18), near=near_a)
    add((c, 18), near=near_b)
    add((a, 23), near=near_b)
    add((b, 23), near=near_a)
    for half in halves[2]:
        add((a, 23), (half, 9))
        add((b, 23), (half, 9))
        for x in halves[0]:
            for y in halves[1]:
                add((x, 12), (y, 12), (half, 9))
    return np.hstack(out)


def keyed(prints: DataFrame) -> DataFrame:
    """(key, fp) for each key of each fingerprint."""

    def run(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            keys = keys_of(np.ascontiguousarray(fp))
            rows, cols = np.nonzero(keys >= 0)
            yield pa.record_batch([pa.array(keys[rows, cols]), pa.array(fp[rows])], ["key", "fp"])

    return prints.select("fp").mapInArrow(tidy(run), "key long, fp long")


def link_components(prints: DataFrame, most_bits: int = 3) -> tuple[DataFrame, list[str]]:
    """(fp, root) of those distinct fingerprints that link to another one.

    Exact: nothing is capped. First every fingerprint is held against the smallest of each of its
    buckets, which gives as many links as keys at most; the components of these already join what
    a dense bucket holds. Then the pairs of a bucket are compared, and only links between
    fingerprints of different components are emitted, so a dense group never yields all its pairs.
    """
    if not 0 <= most_bits <= 3:
        raise ValueError("the keys hold for 3 differing bits at most")
    near = lambda x, y: F.bit_count(F.col(x).bitwiseXOR(F.col(y))) <= most_bits
    spark = prints.sparkSession
    keys, keys_path = materialize(keyed(prints), "golay-keys")
    low = keys.groupBy("key").agg(F.min("fp").alias("low"), F.count("*").alias("n")).where("n > 1").select("key", "low")
    star = keys.join(low, "key").where((F.col("fp") != F.col("low")) & near("fp", "low")).select(F.col("fp").alias("a"), F.col("low").alias("b"))
    first, first_path = components(star)
    labelled, labelled_path = materialize(
        keys.join(first.withColumnRenamed("node", "fp"), "fp", "left").select("key", "fp", F.coalesce("root", "fp").alias("root")), "golay-labels"
    )
    x, y = labelled.toDF("key", "a", "ra"), labelled.toDF("key", "b", "rb")
    rest = x.join(y, (x["key"] == y["key"]) & (F.col("a") < F.col("b")) & (F.col("ra") != F.col("rb")) & near("a", "b")).select("ra", "rb")
    # what the first links joined is one node now
    second, second_path = components(rest, "ra", "rb")
    roots = labelled.select("fp", "root").distinct().join(second.toDF("root", "top"), "root", "left").select("fp", F.coalesce("top", "root").alias("root"))
    out, path = materialize(roots, "golay-roots")
    discard(spark, keys_path, first_path, labelled_path, second_path)
    return out, [path]


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3, most_bits: int = 3, similarity: float | None = None) -> DataFrame:
    """One row per input row: id, fp (long), component_id (smallest id among all that its links reach).

    With a similarity, texts link too whose sets of shingles share that part or more, counted
    exactly, if their sketches meet in a band: at 0.8 all but about 0.2 % of such pairs do. docs
    are read again for these sets.

    Texts that are null, empty or blank all get fingerprint 0 and link like any other; repeated
    rows come back as often as they went in; a component without any id that isn't null has a
    null component_id. Columns other than id and text are neither read nor returned.
    """
    prints, prints_path = materialize(fingerprints(docs, id_col, text_col, n, similarity is not None), "fingerprints")
    distinct, distinct_path = materialize(prints.groupBy("fp").agg(F.min(id_col).alias("least")), "distinct-fingerprints")
    roots, _ = link_components(distinct)
    sweep(docs.sparkSession)
    if similarity is not None:
        # fingerprints are the nodes of all links; texts of one fingerprint link as they are
        nodes, nodes_path = materialize(prints.where("sketch is not null").groupBy("node").agg(F.first("sketch").alias("sketch"), F.min("of").alias("of")), "sketches")
        # one set of shingles may have several fingerprints, as these count repeats: all of them link to one
        held = prints.where("sketch is not null").select("node", "fp").distinct()
        rooted, rooted_path = materialize(held.join(roots, "fp").select("node", "root").distinct(), "node-roots")
        known = rooted.groupBy("node").agg(F.min("root").alias("root"))
        own = rooted.join(known.toDF("node", "rb"), "node").where("root <> rb").select(F.col("root").alias("ra"), "rb")

        def sets_of(wanted):
            texts = docs.select(F.xxhash64(text_col).alias("of"), F.col(text_col).alias("text"))
            # of several rows with one text, one
            held = texts.join(nodes.select("node", "of").join(wanted, "node"), "of").groupBy("node").agg(F.first("text").alias("text"))
            return shingle_sets(held, n)

        ends = similar_links(nodes.select("node", "sketch"), similarity, sets_of)
        ends = ends.join(known.toDF("a", "ra"), "a").join(known.toDF("b", "rb"), "b").select("ra", "rb").unionAll(own)
        more, _ = components(ends, "ra", "rb")
        roots, _ = materialize(roots.join(more.toDF("root", "top"), "root", "left").select("fp", F.coalesce("top", "root").alias("root")), "roots")
        slim, _ = materialize(prints.select(id_col, "fp"), "fingerprints")
        discard(docs.sparkSession, prints_path, nodes_path, rooted_path)
        prints = slim
    of_root = distinct.join(roots, "fp").groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("prints"))
    of_root, of_root_path = materialize(of_root, "of-root")
    by_print = join_groups(roots, of_root, "root", "prints", roots.count()).select("fp", "component_id")
    sizes = prints.groupBy("fp").agg(F.count("*").alias("rows"))
    by_print, _ = materialize(by_print.join(sizes, "fp"), "components")
    discard(docs.sparkSession, distinct_path, of_root_path)
    return join_groups(prints, by_print, "fp", "rows", prints.count()).select(id_col, "fp", "component_id")
