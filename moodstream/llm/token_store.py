"""Token ids in files: one zstandard dictionary, each document a frame.

Layout of a store (a folder that Spark's Parquet writer commits, so a lost
executor or a second attempt leaves no half file, on any file system):

- ``dictionary``: one row with the dictionary, its SHA-256, the bytes per id (2
  if all ids of the vocabulary fit, else 4, little-endian) and the end id.
- ``blocks``: rows in document order, with the least and greatest id (``first_id``,
  ``last_id``), by which a reader skips blocks. A block holds the frames of some hundred
  documents one after another (``blob``), the offset index (``doc_ids``, ``ends``:
  where each frame ends, ``n_tokens``), the number of ids before it in its
  shard (``first_token``) and the hash of the dictionary that its frames need.

A frame is one document's ids with the end id, compressed alone with the shared
dictionary, so a short document is read by its block's index and one small
decompression (``fetch``), not by unpacking its neighbours; the dictionary makes
up for what short inputs lack. The dictionary is trained on the serialised ids
of about ``sample_docs`` documents (documented bound; chosen by a hash of id and
text over all documents, equal rows once). All their ids are used as long as
they fit into ``sample_bytes``; if not, one number of pieces that no document
may exceed is set from all lengths, and longer documents give that many, evenly
spaced (at least one). The order of arrival plays no part, and a store with
documents always has a dictionary.

Documents are dealt by ranges of (id, hash of the text) and sorted, so shards,
blocks and frames are in ascending id order; the number of ids before a shard
is a running sum over one row per shard.

Ids come from the tokenizers library's model, which encodes each word once per
task memory; the words are cut here, where the vocabulary's splitting pattern
can't match across (see ``bpe.Encoder``). The pattern sees a character's class
only, so every character outside ASCII of a word not seen before is compared
with the library's own cut, and a text with one that the two class differently goes to
the library whole.

Defined cases: null and empty texts hold the end id alone; rows with a null id
come first; repeated rows are stored each; an empty table gives an empty store;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from moodstream.llm import bpe
from moodstream.llm.common import hash_sample, level, prepare, spaced, unit_hash

LEVEL, BLOCK_DOCS, ROW_GROUP = 3, 512, 4 << 20
# Bytes of ids that a long document gives at a time to the dictionary.
PIECE = 2048
# Pieces that a worker remembers, some 200 bytes each.
REMEMBER = 1_000_000


class NotAlone(Exception):
    """A piece that cannot be encoded apart from its neighbours."""


class Foreign(Exception):
    """A character that the library may class differently."""


class Memory(dict):
    """Remembers what ``make`` gives for a key. Words seen early are mostly
    the frequent ones, so a full memory forgets its newer half."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key: str) -> bytes:
        value = self[key] = self.make(key)
        return value

    def trim(self, bound: int) -> None:
        if len(self) > bound:
            for key in list(islice(self, bound // 2, None)):
                del self[key]


class LibraryEncoder(bpe.Encoder):
    """Words that are not remembered are encoded by the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__(bpe.vocabulary(path))
        self.library = Tokenizer.from_file(path)
        self.tokenize, self.pieces = self.library.model.tokenize, self.library.pre_tokenizer.pre_tokenize_str
        self.foreign = Memory(self._foreign)
        self.printed = str.maketrans({b: c for c, b in bpe.byte_names().items()})
        self.spaced, self.bare = Memory(lambda p: self._piece(" ", p)), Memory(lambda p: self._piece("", p))
        self.words = Memory(self._word)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        self.spaced.trim(REMEMBER)
        self.bare.trim(REMEMBER // 8)
        self.words.trim(REMEMBER // 8)
        out, apart = [], []
        for t in texts:
            try:
                out.append(b"".join([self._stretch(k % 2, s) for k, s in enumerate(self._stretches(t))]))
            except Foreign:
                apart.append(len(out))
                out.append(b"")
        for k, e in zip(apart, self.library.encode_batch([texts[k] for k in apart], add_special_tokens=False), strict=True):
            out[k] = array("I", e.ids).tobytes()
        return [np.frombuffer(o, np.uint32) for o in out]

    def _foreign(self, ch: str) -> bool:
        """Whether the library classes a character differently from the regex
        module, or from what ``isalpha`` and ``isspace`` are used for."""
        if ch.isascii():
            return False
        letter, number, other = cuts = [self.pieces(f"{side}{ch}{side}") for side in "a1!"]
        if any([f"{side}{ch}{side}"[a:b] for _, (a, b) in cut] != self.find(f"{side}{ch}{side}") for side, cut in zip("a1!", cuts, strict=True)):
            return True
        space = len(letter) > 1 and len(number) > 1 and len(other) > 1
        return (ch.isalpha() and len(letter) > 1) or (space and not ch.isspace())

    def _stretch(self, added: int, text: str) -> bytes:
        if added:
            return array("I", [self.vocabulary.added[text]]).tobytes()
        if not text:
            return b""
        pieces = text.split(" ")
        try:
            return b"".join([self.bare[pieces[0]], *map(self.spaced.__getitem__, islice(pieces, 1, None))])
        except NotAlone:
            return b"".join(map(self._known, self.find(text)))

    def _word(self, word: str) -> bytes:
        if not word.isascii() and any(map(self.foreign.__getitem__, word)):
            raise Foreign
        return array("I", [t.id for t in self.tokenize(word.encode().decode("latin-1").translate(self.printed))]).tobytes()

    def _piece(self, lead: str, piece: str) -> bytes:
        if piece.isalpha():
            return self._word(lead + piece)
        if not piece or piece[0].isspace() or piece[-1].isspace():
            raise NotAlone
        return b"".join(map(self._known, self.find(lead + piece)))

    def _known(self, word: str) -> bytes:
        if word[0] == " " and word[1:].isalpha():
            return self.spaced[word[1:]]
        return self.words[word]


@lru_cache(maxsize=2)
def library_encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


def _serialised(path: str, end_id: int, dtype: str):
    """Texts -> ids with the end id, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = library_encoder(path)
        for b in batches:
            for _, texts in bpe.stretches(b.column(0).to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array([np.append(i, end_id).astype(dtype).tobytes() for i in enc.encode(texts)], pa.binary())], names=["ids"])

    return run


def _samples(most: int):
    """The ids of each document as one sample, or ``most`` evenly spaced pieces of a longer one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids in b.column(0).to_pylist():
                n = -(-len(ids) // PIECE)
                out = [ids] if n <= most else [ids[at * PIECE : (at + 1) * PIECE] for at in spaced(n, most)]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["ids"])

    return run


def _train(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        samples = sorted(ids for b in batches for ids in b.column(0).to_pylist())
        try:
            data = zstandard.train_dictionary(size, samples, k=256, d=8).as_bytes()
        except (zstandard.ZstdError, ValueError):  # too little to train on: the ids themselves serve as a raw dictionary
            data = b"".join(samples)[-size:]
        yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["data"])

    return run


def _blocks(path: str, end_id: int, dtype: str, dictionary: bytes, dict_hash: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard = library_encoder(path), TaskContext.get().partitionId()
        shared = zstandard.ZstdCompressionDict(dictionary)
        shared.precompute_compress(level=LEVEL)
        pack = zstandard.ZstdCompressor(dict_data=shared, write_dict_id=False).compress
        block, before = 0, 0
        for b in batches:
            names = b.column("_id").to_pylist()
            for at, texts in bpe.stretches(b.column("_text").to_pylist()):
                ids = enc.encode(texts)
                for lo in range(0, len(texts), BLOCK_DOCS):
                    part = [np.append(i, end_id).astype(dtype) for i in ids[lo : lo + BLOCK_DOCS]]
                    frames, counts = [pack(i.tobytes()) for i in part], [len(i) for i in part]
                    held = [i for i in names[at + lo : at + lo + len(part)] if i is not None]
                    yield pa.RecordBatch.from_pydict({
                        "first_id": pa.array([held[0] if held else None], pa.int64()), "last_id": pa.array([held[-1] if held else None], pa.int64()),
                        "shard": pa.array([shard], pa.int32()), "block": pa.array([block], pa.int32()), "dict_hash": [dict_hash],
                        "first_token": pa.array([before], pa.int64()), "tokens": pa.array([sum(counts)], pa.int64()),
                        "doc_ids": pa.array([names[at + lo : at + lo + len(part)]], pa.list_(pa.int64())),
                        "n_tokens": pa.array([counts], pa.list_(pa.int64())),
                        "ends": pa.array([np.cumsum([len(f) for f in frames]).tolist()], pa.list_(pa.int64())),
                        "blob": pa.array([b"".join(frames)], pa.binary())})
                    block, before = block + 1, before + sum(counts)

    return run


BLOCK_SCHEMA = ("first_id long, last_id long, shard int, block int, dict_hash string, first_token long, tokens long, doc_ids array<bigint>, "
                "n_tokens array<bigint>, ends array<bigint>, blob binary")


def write_store(docs: DataFrame, folder: str, vocabulary: str, end_id: int = 0, dict_bytes: int = 112640, sample_docs: int = 2000,
                sample_bytes: int = 32 << 20, id_col: str = "doc_id", text_col: str = "text") -> None:
    spark = prepare(docs.sparkSession)
    dtype = "<u2" if len(bpe.vocabulary(vocabulary).tokens) <= 1 << 16 else "<u4"
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    total = rows.count()
    sample = hash_sample(rows, sample_docs, total, "_id", "_text", seed=2).distinct()
    encode = _serialised(vocabulary, end_id, dtype)
    serialised = sample.select("_text").mapInArrow(encode, "ids binary").checkpoint()
    lengths = [r[0] for r in serialised.select(F.length("ids")).collect()]
    if total and not lengths:  # the hash chose none
        first = rows.orderBy(unit_hash("_id", "_text", seed=2), "_id", "_text").limit(1)
        serialised = first.select("_text").mapInArrow(encode, "ids binary")
    most = level([-(-n // PIECE) for n in lengths], sample_bytes // PIECE) if lengths else max(1, sample_bytes // PIECE)
    found = serialised.mapInArrow(_samples(most), "ids binary").repartition(1).mapInArrow(_train(dict_bytes), "data binary").collect()
    dictionary = bytes(found[0]["data"]) if found else b""
    if total and not dictionary:
        raise ValueError("no dictionary for a store with documents")
    dict_hash = hashlib.sha256(dictionary).hexdigest()
    spark.range(1).select(F.lit(dict_hash).alias("dict_hash"), F.lit(dictionary).alias("data"), F.lit(int(dtype[-1])).alias("id_bytes"),
                          F.lit(end_id).alias("end_id")).write.parquet(f"{folder}/dictionary")
    # Rows of one id, or without one, are in any order: a hash of the text lets them go to several shards.
    ordered = rows.withColumn("_h", F.xxhash64("_text")).repartitionByRange("_id", "_h").sortWithinPartitions("_id", "_h", "_text").drop("_h")
    blocks = ordered.mapInArrow(_blocks(vocabulary, end_id, dtype, dictionary, dict_hash), BLOCK_SCHEMA)
    # Frames are compressed already. Small row groups: a reader skips those whose range of ids it does not need.
    blocks.write.option("compression", "none").option("parquet.block.size", ROW_GROUP).parquet(f"{folder}/blocks")


class Frames:
    """Reads single documents of blocks with the store's dictionary."""

    def __init__(self, dict_hash: str, dictionary: bytes, id_bytes: int):
        if hashlib.sha256(dictionary).hexdigest() != dict_hash:
            raise ValueError("the dictionary does not have the hash that the store names")
        self.dict_hash, self.dtype = dict_hash, f"<u{id_bytes}"
        self.unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)).decompress

    def ids(self, dict_hash: str, blob: memoryview, ends: list[int], k: int) -> np.ndarray:
        if dict_hash != self.dict_hash:
            raise ValueError("the block was written with another dictionary")
        return np.frombuffer(self.unpack(blob[ends[k - 1] if k else 0 : ends[k]]), self.dtype)


def _open(spark: SparkSession, folder: str) -> tuple[str, bytes, int]:
    d = spark.read.parquet(f"{folder}/dictionary").first()
    return d["dict_hash"], bytes(d["data"]), d["id_bytes"]


def _read_blocks(opened: tuple[str, bytes, int], wanted, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames = Frames(*opened)
        for b in batches:
            for row in range(b.num_rows):
                r = {n: b.column(n)[row] for n in b.schema.names}
                names, counts, ends = (r[n].as_py() for n in ("doc_ids", "n_tokens", "ends"))
                blob, hashed = memoryview(r["blob"].as_buffer()), r["dict_hash"].as_py()
                first = np.cumsum([r["first_token"].as_py(), *counts])
                ks = [k for k, name in enumerate(names) if wanted is None or name in wanted]
                out = {"shard": pa.array([r["shard"].as_py()] * len(ks), pa.int32()), "doc_id": pa.array([names[k] for k in ks], pa.int64()),
                       "in_shard": pa.array([int(first[k]) for k in ks], pa.int64())}
                ids = (frames.ids(hashed, blob, ends, k).astype("<u4") for k in ks)
                if digest:
                    read = [(len(i), zlib.crc32(i.tobytes())) for i in ids]
                    out |= {"n_tokens": pa.array([n for n, _ in read], pa.int64()), "ids_crc32": pa.array([c for _, c in read], pa.int64())}
                else:
                    out |= {"ids": pa.array([i.tolist() for i in ids], pa.list_(pa.int64()))}
                yield pa.RecordBatch.from_pydict(out)

    return run


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """One row per stored document, computed from the files: doc_id, start,
    n_tokens, ids_crc32."""
    prepare(spark)
    blocks = spark.read.parquet(f"{folder}/blocks")
    read = blocks.drop("tokens", "block", "first_id", "last_id").mapInArrow(_read_blocks(_open(spark, folder), None, True), "shard int, doc_id long, in_shard long, n_tokens long, ids_crc32 long")
    shards = blocks.groupBy("shard").agg(F.sum("tokens").alias("tokens"))
    before = shards.select("shard", (F.sum("tokens").over(Window.orderBy("shard")) - F.col("tokens")).alias("before"))
    return read.join(before, "shard").select("doc_id", (F.col("before") + F.col("in_shard")).alias("start"), "n_tokens", "ids_crc32")


def fetch(spark: SparkSession, folder: str, doc_ids: list[int]) -> DataFrame:
    """The ids of a few documents (with the end id). Row groups and blocks
    whose range of ids holds none of them are skipped by the reader; of the
    blocks left only the frames asked for are unpacked."""
    prepare(spark)
    wanted = F.lit(False)
    for d in sorted(set(doc_ids)):
        wanted = wanted | ((F.col("first_id") <= int(d)) & (F.col("last_id") >= int(d)))
    blocks = spark.read.parquet(f"{folder}/blocks").where(wanted)
    schema = "shard int, doc_id long, in_shard long, ids array<bigint>"
    return blocks.drop("tokens", "block", "first_id", "last_id").mapInArrow(_read_blocks(_open(spark, folder), frozenset(doc_ids), False), schema).select("doc_id", "ids")
