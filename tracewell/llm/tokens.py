"""Token ids in raw binary shards, with a minimal perfect hash index for keyed access.

A written folder holds
  shard-NNNNN.bin   ids of its documents, end id included, one after another: little-endian unsigned 16 bits
                    if the vocabulary and the end id fit, else 32
  index-NNNNN.npz   a part of the index: the keys whose hash falls into it
  MANIFEST.json     bytes of an id, shards with their ids and documents, the number of index parts
Shards follow each other in ascending order of document ids.

The index finds a key in constant time: its hash names the part; within it, levels of bit arrays
hold each key alone at one place, and the number of set bits before that place is the key's slot,
from 0 to the number of keys less one. A slot holds the key's fingerprint, so that foreign keys
are told, then shard, offset, count and repetition.
"""

from __future__ import annotations

import io
import json
import re
import struct
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from .common import SLICE, mix64, text_slices, tidy, utf8_parts
from .stores import Staged, open_store, write_file

#: Places of a worker's table of chunks, ids that it holds at most, and other chunks and pieces remembered beside it (of each
#: up to twice as many): about 70 MB, which a worker keeps after its tasks.
SLOTS, POOL, CHUNKS, PIECES = 1 << 20, 1 << 23, 30_000, 30_000
#: Keys in a part of the index, about.
PART_KEYS = 1 << 16
#: Fixed value: the places at which the tokenizer cuts a text before it merges bytes.
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Control characters that libraries class differently.
_ODD = "[\x1c-\x1f\x85]"
#: Bytes that begin no white space after a space; of C2, E1, E2 and E3 some characters do.
_SOLID = np.zeros(256, bool)
_SOLID[0x21:0x7F] = _SOLID[0xC3:0xF5] = True
_SOLID[[0xE1, 0xE2, 0xE3]] = False
_PERHAPS = np.zeros(256, bool)
_PERHAPS[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_LETTER = np.array([chr(c).isalpha() and c < 128 for c in range(256)])
_NO_LETTER = ~_LETTER & (np.arange(256) < 128)
_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(8)] + [(1 << 64) - 1], np.uint64)


def chunk_starts(data: np.ndarray, off: np.ndarray, whole: list[int]) -> np.ndarray:
    """First bytes of the chunks of all rows; rows in whole are one chunk.

    A chunk begins where a row does, at a space that other than white space follows, and at an ASCII
    character after an ASCII letter that is none itself.
    """
    cut = np.zeros(len(data), bool)
    if len(data) > 1:
        after = data[1:]
        space = data[:-1] == 32
        cut[:-1] = space & _SOLID[after]
        at = np.flatnonzero(space & _PERHAPS[after])
        if len(at):
            lead, second, third = (data.take(at + k, mode="clip") for k in (1, 2, 3))
            white = (lead == 0xC2) & ((second == 0x85) | (second == 0xA0))
            white |= (lead == 0xE1) & ((second == 0x9A) | (second == 0xA0))
            white |= (lead == 0xE2) & (((second == 0x80) & ((third < 0x90) | (third > 0xA7))) | (second == 0x81))
            white |= (lead == 0xE3) & (second == 0x80) & (third == 0x80)
            cut[at] = ~white
        cut[1:] |= _LETTER[data[:-1]] & _NO_LETTER[after]
    held = np.diff(off) > 0
    last = off[1:][held] - 1  # what follows a row's last space is another row's
    cut[last] = (data[last] == 32) & _LETTER[data[np.maximum(last - 1, 0)]] | (data[last] != 32) & cut[last]
    for row in whole:
        cut[off[row] : off[row + 1]] = False
    cut[off[:-1][held]] = True
    return np.flatnonzero(cut)


class _Encoder:
    """Ids of texts by the tokenizers library; ids of chunks that came before are looked up.

    The tokenizer never joins what a space followed by other than white space begins with what
    stands before it, nor letters with what isn't one, so a text may be cut there and its chunks
    encoded each for itself. Chunks of 16 bytes or fewer, nearly all, lie in a table with one place for each hash, and are told by
    all their bytes; a slice's chunks are looked up there at once. Texts with control characters that
    libraries class differently, or with the string of an added token, go to the tokenizer whole.
    """

    def __init__(self, file: str):
        self.tokenizer = Tokenizer.from_file(file)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.type = "H" if self.width == 2 else "I"
        self.tokenize = self.tokenizer.model.tokenize
        own = json.loads(self.tokenizer.to_str())
        self.plain = own["normalizer"] is None and own["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        # in a text, the string of an added token is that token
        self.odd = "|".join([_ODD, *(re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values())])
        self.pieces_of = regex.compile(_PIECES).findall
        chars = _byte_chars()
        self.byte_chars, self.space = str.maketrans(dict(enumerate(chars))), chars[32]
        self.chunks, self.pieces = _Memo(self._long, CHUNKS), _Memo(self._piece, PIECES)
        self.head, self.tail = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.uint64)
        self.size, self.count, self.at = np.zeros(SLOTS, np.uint8), np.zeros(SLOTS, np.uint8), np.zeros(SLOTS, np.int64)
        self.pool, self.used = np.zeros(POOL, f"<u{self.width}"), 0

    def packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.type}", *ids)

    def _piece(self, piece: str) -> list[int]:
        shown = piece.encode().decode("latin-1").translate(self.byte_chars)
        return [t.id for t in self.tokenize(shown)]

    def _chunk(self, chunk: bytes) -> list[int]:
        text = chunk.decode()
        if text.isascii():
            word = text[1:] if text[0] == " " else text
            if word.isalpha():
                return [t.id for t in self.tokenize(self.space + word if word is not text else text)]
        return [i for p in self.pieces_of(text) for i in self.pieces[p]]

    def _long(self, chunk: bytes) -> tuple[int, ...]:
        return tuple(self._chunk(chunk))

    def _make_room(self, most: int) -> None:
        """Once the pool is full, move what the table still points to together."""
        if self.used + most <= POOL:
            return
        held = np.flatnonzero(self.size)
        count = self.count[held].astype(np.int64)
        before = np.cumsum(count) - count
        ids = self.pool[np.repeat(self.at[held] - before, count) + np.arange(count.sum())]
        self.at[held], self.used = before, len(ids)
        self.pool = np.zeros(max(POOL, self.used + most), self.pool.dtype)
        self.pool[: self.used] = ids

    def encode_slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after another, and where each text's begin (n + 1)."""
        data, off = utf8_parts(texts)
        self._make_room(len(data))  # a byte gives one id at most
        whole = np.flatnonzero(pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False)) if self.plain else np.arange(len(off) - 1)
        start = chunk_starts(data, off, whole.tolist())
        first = np.searchsorted(start, off)
        n = np.diff(np.append(start, len(data)))
        padded = np.zeros(len(data) + 16, np.uint8)
        padded[8:-8] = data
        eight = np.ndarray((len(data) + 9,), "<u8", padded, strides=(1,))  # the eight bytes from each byte on
        head = eight[start + 8] & _LOW_BYTES[np.minimum(n, 8)]
        tail = np.where(n > 8, eight[start + n], np.uint64(0))
        slot = (mix64(head ^ mix64(tail + n.astype(np.uint64))) >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)
        short = n <= 16
        short[first[whole][off[whole] < off[whole + 1]]] = False
        hit = short & (self.size[slot] == n) & (self.head[slot] == head) & (self.tail[slot] == tail)
        at, count = self.at[slot], self.count[slot].astype(np.int64)
        missed, known, raw, fresh, base = np.flatnonzero(~hit), {}, data.tobytes(), [], self.used
        odd = set(start[first[whole]].tolist()) if len(start) and len(whole) else ()
        places, counts = [], []
        for i, size in zip(start[missed].tolist(), n[missed].tolist()):
            chunk = raw[i : i + size]
            place = known.get(chunk)
            if place is None or i in odd:
                if i in odd:
                    ids = self.tokenizer.encode(chunk.decode(), add_special_tokens=False).ids
                else:
                    ids = self._chunk(chunk) if size <= 16 or size > 64 else self.chunks[chunk]
                place = base + len(fresh), len(ids)
                fresh.extend(ids)
                if i not in odd:
                    known[chunk] = place
            places.append(place[0])
            counts.append(place[1])
        at[missed], count[missed] = places, counts
        self.used += len(fresh)
        self.pool[base : self.used] = fresh
        new = missed[short[missed]]
        to = slot[new]
        self.head[to], self.tail[to], self.size[to], self.at[to], self.count[to] = head[new], tail[new], n[new], at[new], count[new]
        before = np.concatenate([[0], np.cumsum(count)])
        ids = self.pool[np.repeat(at - before[:-1], count) + np.arange(before[-1])]
        return ids, before[first]

    def encode_all(self, texts: pa.Array):
        """Little-endian ids of ``width`` bytes each, text by text; null counts as empty."""
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = pc.fill_null(texts, "")
        for part in text_slices(pa.record_batch([texts], ["text"]), "text", SLICE):
            ids, begin = self.encode_slice(part.column(0))
            for i, j in zip(begin[:-1].tolist(), begin[1:].tolist()):
                yield ids[i:j].tobytes()


class _Memo(dict):
    """Values by key, up to twice ``most``; those that have not been asked for lately go first."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def _byte_chars() -> list[str]:
    """The printable stand-in of each byte: itself where it is visible Latin-1, the next free code point from 256 on elsewhere."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(free)) for b in range(256)]


_ENCODERS: dict[str, _Encoder] = {}


def encoder(file: str) -> _Encoder:
    if file not in _ENCODERS:
        _ENCODERS[file] = _Encoder(file)
    return _ENCODERS[file]


def key_bytes(doc_id, repetition: int) -> bytes:
    return f"{doc_id}#{repetition}".encode()


def key_hashes(ids, repetitions) -> np.ndarray:
    """128 bits of each key, as two numbers of 64: no two keys of a corpus share them."""
    return np.frombuffer(b"".join(xxhash.xxh128_digest(key_bytes(i, r), 1) for i, r in zip(ids, repetitions)), ">u8").reshape(-1, 2).astype(np.uint64)


class PerfectHash:
    """A minimal perfect hash of distinct 128-bit hashes (n, 2): levels of bits, each key alone at one place."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.before = []
        total = 0
        for bits in levels:
            self.before.append(total + np.concatenate([[0], np.cumsum(bits)[:-1]]))
            total += int(bits.sum())
        self.size = total

    @staticmethod
    def _at(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix64(hashes[:, 0] + mix64(hashes[:, 1] + np.uint64(level + 1))) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, hashes: np.ndarray) -> PerfectHash:
        left, levels = np.unique(hashes, axis=0), []
        if len(left) != len(hashes):
            raise ValueError("a key stands twice")
        while len(left):
            size = max(8, 2 * len(left))
            at = cls._at(left, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[at]]
        return cls(levels)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for those that are surely foreign."""
        out = np.full(len(hashes), -1, np.int64)
        for k, bits in enumerate(self.levels):
            at = self._at(hashes, k, len(bits))
            hit = (out < 0) & bits[at]
            out[hit] = self.before[k][at[hit]]
        return out


def _fingerprints(hashes: np.ndarray) -> np.ndarray:
    return mix64(hashes[:, 1] ^ np.uint64(0x5BD1E995)) >> np.uint64(32)


_ROW = np.dtype([("fingerprint", "<u4"), ("shard", "<u4"), ("offset", "<u8"), ("count", "<u8")])


def _save_part(hashes: np.ndarray, shard, offset, count) -> bytes:
    index = PerfectHash.build(hashes)
    rows = np.zeros(len(hashes), _ROW)
    at = index.slots(hashes)
    rows["fingerprint"][at] = _fingerprints(hashes)
    rows["shard"][at], rows["offset"][at], rows["count"][at] = shard, offset, count
    out = io.BytesIO()
    sizes = np.array([len(b) for b in index.levels], np.int64)
    np.savez(out, rows=rows, sizes=sizes, bits=np.packbits(np.concatenate(index.levels)) if index.levels else np.zeros(0, np.uint8))
    return out.getvalue()


def _load_part(data: bytes) -> tuple[PerfectHash, np.ndarray]:
    got = np.load(io.BytesIO(data))
    bits = np.unpackbits(got["bits"], count=int(got["sizes"].sum())).astype(bool)
    return PerfectHash(np.split(bits, np.cumsum(got["sizes"])[:-1]) if len(got["sizes"]) else []), got["rows"]


def _find(part: tuple[PerfectHash, np.ndarray], hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys the part holds, and the rows of those."""
    index, rows = part
    slots = index.slots(hashes)
    known = slots >= 0
    known[known] = rows["fingerprint"][slots[known]] == _fingerprints(hashes[known])
    return known, rows[slots[known]]


def write_tokens(
    docs: DataFrame, path: str, tokenizer_file: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", shards: int | None = None
) -> dict:
    """Encode every whole text, append the end id, write shards and index to path; returns the manifest.

    Documents are range-sorted by id, null ids first; repeated ids keep all their rows, told apart
    by repetition 0, 1, ... in order of their texts. Null and empty texts have the end id alone. A
    row's text shuffles once. An empty table gives no shard and one empty part of the index.
    """
    if not 0 <= end_id < 1 << 8 * encoder(tokenizer_file).width:
        raise ValueError("the end id doesn't fit")
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    shards = shards or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def encode(batches):
        from pyspark import TaskContext

        store, at = open_store(path)
        own, number = encoder(tokenizer_file), TaskContext.get().partitionId()
        end, offset, before, repetition = own.packed([end_id]), 0, object(), 0
        with Staged(store, f"{at}/shard-{number:05d}.bin") as out:
            for batch in batches:
                ids, counts, offsets, repetitions = batch.column(0), [], [], []
                for i, coded in zip(ids.to_pylist(), own.encode_all(batch.column(1))):
                    data = coded + end
                    out.write(data)
                    repetition = repetition + 1 if i == before else 0
                    before = i
                    offsets.append(offset)
                    counts.append(len(data) // own.width)
                    repetitions.append(repetition)
                    offset += len(data)
                yield pa.record_batch(
                    [ids, pa.array(repetitions, pa.int64()), pa.array([number] * len(ids), pa.int32()), pa.array(offsets, pa.int64()), pa.array(counts, pa.int64())],
                    ["id", "repetition", "shard", "offset", "count"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    store, at = open_store(path)
    store.create_dir(at)
    ranged = rows.repartitionByRange(shards, "id").sortWithinPartitions("id", "text")
    placed = ranged.mapInArrow(tidy(encode), f"id {kind}, repetition long, shard int, offset long, count long")
    placed.write.parquet(f"{path}/places")
    placed = spark.read.schema(placed.schema).parquet(f"{path}/places")
    totals = placed.groupBy("shard").agg(F.count("*").alias("documents"), F.sum("count").alias("ids")).orderBy("shard").collect()
    parts = max(1, -(-sum(r["documents"] for r in totals) // PART_KEYS))

    def index(key, pdf):
        store, at = open_store(path)
        hashes = _hashes_of(pdf)
        write_file(store, f"{at}/index-{key[0]:05d}.npz", _save_part(hashes, pdf["shard"].to_numpy(), pdf["offset"].to_numpy(), pdf["count"].to_numpy()))
        return pd.DataFrame({"part": [key[0]], "keys": [len(pdf)]})

    hashed = _hashed(placed).withColumn("part", F.pmod("hash", F.lit(parts)).cast("int"))
    done = {r["part"]: r["keys"] for r in hashed.groupBy("part").applyInPandas(index, "part int, keys long").collect()}
    manifest = {"end_id": end_id, "id_bytes": encoder(tokenizer_file).width, "shards": [r.asDict() for r in totals], "parts": parts, "keys": {str(k): v for k, v in sorted(done.items())}}
    write_file(store, f"{at}/MANIFEST.json", json.dumps(manifest).encode())
    return manifest


def _hashed(keys: DataFrame) -> DataFrame:
    """keys (id, repetition, ...) with the 128-bit hash of each, as hash and hash2."""

    def run(batches):
        for batch in batches:
            h = key_hashes(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            both = [pa.array(np.ascontiguousarray(h[:, k]).view(np.int64)) for k in (0, 1)]
            yield pa.record_batch([*batch.columns, *both], [*batch.schema.names, "hash", "hash2"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keys.schema)
    return keys.mapInArrow(tidy(run), f"{schema}, hash long, hash2 long")


def _hashes_of(pdf: pd.DataFrame) -> np.ndarray:
    return np.ascontiguousarray(pdf[["hash", "hash2"]].to_numpy(np.int64)).view(np.uint64)


def read_manifest(path: str) -> dict:
    store, at = open_store(path)
    with store.open_input_stream(f"{at}/MANIFEST.json") as f:
        return json.loads(f.read())


def locate(keys: DataFrame, path: str) -> DataFrame:
    """(id, repetition, shard, offset, count) of those keys (id, repetition) that the index holds."""
    parts = read_manifest(path)["parts"]

    def look(key, pdf):
        store, at = open_store(path)
        pdf = pdf.reset_index(drop=True)
        name = f"{at}/index-{key[0]:05d}.npz"
        if store.get_file_info(name).is_file:
            with store.open_input_stream(name) as f:
                known, rows = _find(_load_part(f.read()), _hashes_of(pdf))
        else:
            known, rows = np.zeros(len(pdf), bool), np.zeros(0, _ROW)
        found = pdf.loc[known, ["id", "repetition"]].reset_index(drop=True)
        return found.assign(shard=rows["shard"].astype(np.int32), offset=rows["offset"].astype(np.int64), count=rows["count"].astype(np.int64))

    kind = keys.schema["id"].dataType.simpleString()
    hashed = _hashed(keys.select("id", "repetition")).withColumn("part", F.pmod("hash", F.lit(parts)).cast("int"))
    return hashed.groupBy("part").applyInPandas(look, f"id {kind}, repetition long, shard int, offset long, count long")


def read_tokens(places: DataFrame, path: str, digest_only: bool = True) -> DataFrame:
    """Read located documents from their shards: (id, repetition, start, n_tokens, ids_crc32[, ids]).

    start is the number of ids of all documents before. Places of a shard are read in the order
    of their offsets; a shard's reads may spread over several tasks.
    """
    manifest, before, starts = read_manifest(path), 0, {}
    width = manifest["id_bytes"]
    for s in manifest["shards"]:
        starts[s["shard"]] = before
        before += s["ids"]

    def read(batches):
        store, at = open_store(path)
        opened, file = None, None
        for batch in batches:
            starts_, counts, crcs, payloads = [], batch.column(4), [], []
            for shard, offset, count in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), counts.to_pylist()):
                if shard != opened:
                    opened, file = shard, store.open_input_file(f"{at}/shard-{shard:05d}.bin")
                file.seek(offset)
                data = np.frombuffer(file.read(width * count), f"<u{width}").astype("<u4").tobytes()
                starts_.append(starts[shard] + offset // width)
                crcs.append(zlib.crc32(data))
                if not digest_only:
                    payloads.append(data)
            columns = [batch.column(0), batch.column(1), pa.array(starts_, pa.int64()), counts, pa.array(crcs, pa.int64())]
            names = ["id", "repetition", "start", "n_tokens", "ids_crc32"]
            if not digest_only:
                columns, names = [*columns, pa.array(payloads, pa.binary())], [*names, "ids"]
            yield pa.record_batch(columns, names)

    kind = places.schema["id"].dataType.simpleString()
    schema = f"id {kind}, repetition long, start long, n_tokens long, ids_crc32 long" + ("" if digest_only else ", ids binary")
    ordered = places.select("id", "repetition", "shard", "offset", "count").repartitionByRange("shard", "offset").sortWithinPartitions("shard", "offset")
    return ordered.mapInArrow(tidy(read), schema)


def keys_of(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, repetition) of every row: repeated ids are numbered from 0."""
    nth = F.row_number().over(Window.partitionBy("id").orderBy("id"))
    return docs.select(F.col(id_col).alias("id")).select("id", (nth - 1).cast("long").alias("repetition"))
