"""Byte-level BPE encoding and decoding with a compiled lexicon.

Frequent words go into a minimal acyclic transducer (``lexicon.py``) whose
output is their token ids. The words are counted over the whole corpus: each
task sums what it reads, the sums meet in one aggregate, and the ``bound`` most
frequent words (a documented size of the lexicon; ties at the border stay out)
are compiled on the driver. The file is handed to every executor by Spark and
mapped into memory. It only saves work: words that are not in it are merged
exactly by rank, so ids never depend on it.

Encoding splits a text at its added tokens, then into pieces before each single
space between non-space characters. The public splitting pattern can't match
across such a place, so each piece is encoded alone and once per task memory;
a text with any other space next to white space is split by the pattern as a
whole. Unknown pieces of some megabytes of text are resolved together: one
walk of the transducer, then one merge of all words left, where each round
merges the best pair of every word at once. Words longer than ``LONG`` bytes
are merged by a heap in n log n steps, so a long run without spaces is no
special case.

The pattern sees a character's class only (letter, number, space, other), and
the library's Unicode tables class some characters differently from the regex
module and from ``isalpha``. So each character outside ASCII is compared with the
library's own cut when it is first seen (``Classes``); a text is cut with a
stand-in of the right class in the place of each that differs.

The vocabulary file is read by the workers from its path (the package that
holds it is installed on all machines). It must be byte-level BPE with the
usual splitting pattern and no normaliser.

Defined cases: null and empty texts have no tokens (the hashes of nothing);
repeated rows are encoded each; null ids are carried; an empty table gives an
empty result; extra columns are ignored, or carried with ``with_ids`` (one that
has the name of a made column gets ``_`` behind its name).
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import tempfile
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodstream.llm.common import prepare
from moodstream.llm.lexicon import Transducer, compile_words

# Fixed value: the splitting pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG = 48
# Characters of text that are resolved together, and pieces that a worker remembers.
STRETCH, REMEMBER = 2_000_000, 400_000
NO_PAIR = np.int32(2**31 - 1)


def byte_names() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files:
    a byte that prints stands for itself, the others follow from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(prints)]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens, merges and added tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or spec["normalizer"] or split.get("type") != "ByteLevel" or split.get("add_prefix_space"):
            raise ValueError(f"{path}: not plain byte-level BPE")
        names, ids = byte_names(), model["vocab"]
        self.tokens = [b""] * (1 + max([*ids.values(), *(a["id"] for a in spec["added_tokens"])]))
        for text, i in ids.items():
            self.tokens[i] = bytes(names[c] for c in text)
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        for text, i in self.added.items():
            self.tokens[i] = text.encode()
        if any(a[k] for a in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"{path}: added tokens that reach beyond themselves")
        self.added_pattern = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.byte_id = np.zeros(256, np.int32)
        for c, b in names.items():
            self.byte_id[b] = ids[c]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right = (np.array([ids[p[k]] for p in pairs], np.int64) for k in (0, 1))
        merged = np.array([ids[a + b] for a, b in pairs], np.int64)
        key, rank = left << 20 | right, np.arange(len(pairs), dtype=np.int32)
        order = np.argsort(key, kind="stable")
        self.key, self.rank, self.merged = key[order], rank[order], merged.astype(np.int32)
        self.decimal = [b"%d" % i for i in range(len(self.tokens))]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NO_PAIR`` where there is no merge."""
        want = left.astype(np.int64) << 20 | right
        at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        return np.where((self.key[at] == want) & (right >= 0), self.rank[at], NO_PAIR)

    def merge_short(self, words: list[bytes]) -> list[bytes]:
        """Ids (as bytes of uint32) of many words; each round merges every
        word's best pair."""
        out = [b""] * len(words)
        order = sorted(range(len(words)), key=lambda k: len(words[k]))
        for at in range(0, len(order), 16384):
            chosen = order[at : at + 16384]
            width = len(words[chosen[-1]]) + 1  # one column of padding stays at the end
            raw = np.frombuffer(b"".join([words[k].ljust(width, b"\0") for k in chosen]), np.uint8).reshape(-1, width)
            n = np.array([len(words[k]) for k in chosen])
            ids = np.where(np.arange(width) < n[:, None], self.byte_id[raw], np.int32(-1))
            ranks, part, cols = self.ranks(ids[:, :-1], ids[:, 1:]), np.array(chosen), np.arange(width)
            while len(part):
                best = ranks.argmin(axis=1)
                rows = np.arange(len(part))
                low = ranks[rows, best]
                done = low == NO_PAIR
                if done.any():
                    ready = ids[done]
                    ends = np.cumsum((ready >= 0).sum(axis=1) * 4).tolist()
                    flat, begin = ready[ready >= 0].astype(np.uint32).tobytes(), 0
                    for k, end in zip(part[done].tolist(), ends, strict=True):
                        out[k], begin = flat[begin:end], end
                    go = ~done
                    part, ids, ranks, best, low = part[go], ids[go], ranks[go], best[go], low[go]
                    rows = rows[: len(part)]
                ids[rows, best] = self.merged[low]
                after = np.minimum(cols + (cols > best[:, None]), width - 1)  # all right of the pair moves left
                ids = ids[rows[:, None], after]
                ranks = ranks[rows[:, None], np.minimum(after[:, :-1], width - 2)]
                for place in (best - 1, best):
                    inside = place >= 0
                    r, q = rows[inside], place[inside]
                    ranks[r, q] = self.ranks(ids[r, q], ids[r, q + 1])
        return out

    def merge_long(self, word: bytes) -> bytes:
        """The same for one long word: a heap of pairs over a linked list."""
        ids = self.byte_id[np.frombuffer(word, np.uint8)]
        n = len(ids)
        first = self.ranks(ids[:-1], ids[1:])
        heap = [(int(r), int(i)) for i, r in enumerate(first) if r != NO_PAIR]
        heapq.heapify(heap)
        pair_rank = first.tolist() + [int(NO_PAIR)]
        ids, after, before = ids.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        merges = self.pair_ranks()
        while heap:
            rank, i = heapq.heappop(heap)
            if pair_rank[i] != rank:
                continue  # one of the two has been merged since
            j = after[i]
            ids[i], after[i], pair_rank[j], ids[j] = int(self.merged[rank]), after[j], int(NO_PAIR), -1
            if after[i] < n:
                before[after[i]] = i
            for left in (before[i], i):
                if left >= 0:
                    right = after[left]
                    r = merges.get(ids[left] << 20 | ids[right], int(NO_PAIR)) if right < n else int(NO_PAIR)
                    pair_rank[left] = r
                    if r != NO_PAIR:
                        heapq.heappush(heap, (r, left))
        return np.array([i for i in ids if i >= 0], np.uint32).tobytes()

    @lru_cache
    def pair_ranks(self) -> dict[int, int]:
        return dict(zip(self.key.tolist(), self.rank.tolist(), strict=True))

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.tokens.__getitem__, ids.tolist())).decode("utf-8", "replace")


class Classes(dict):
    """Character -> the character that stands for it when text is cut: itself
    where regex module and library agree, else one of the library's class."""

    # One of each class: letter (in no contraction), number, other, space (not the one that leads a word).
    STAND_INS = {"a": "a", "1": "0", "!": "!"}
    SPACE = "\u2003"

    def __init__(self, find):
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__({chr(c): chr(c) for c in range(128)})
        self.find, self.pieces = find, ByteLevel(add_prefix_space=False).pre_tokenize_str

    def __missing__(self, ch: str) -> str:
        whole = [side for side in self.STAND_INS if len(self.pieces(f"{side}{ch}{side}")) == 1]
        here = [side for side in self.STAND_INS if len(self.find(f"{side}{ch}{side}")) == 1]
        agree = whole == here and ch.isalpha() == (whole == ["a"]) and (bool(whole) or ch.isspace())
        self[ch] = ch if agree else self.STAND_INS[whole[0]] if whole else self.SPACE
        return self[ch]

    def plain(self, text: str) -> str:
        """The text with its stand-ins; the same object if there are none."""
        if text.isascii():
            return text
        stood = "".join(map(self.__getitem__, text))
        return text if stood == text else stood


class Encoder:
    """Texts to token ids, with a memory of the pieces seen."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Transducer | None = None):
        pattern = regex.compile(PATTERN)
        self.vocabulary, self.lexicon, self.find, self.spans = vocabulary, lexicon, pattern.findall, pattern.finditer
        self.classes = Classes(self.find)
        # Ids as bytes of a piece with the space before it, of one without, and of single words; None: not alone.
        self.spaced: dict[str, bytes | None] = {}
        self.bare: dict[str, bytes | None] = {}
        self.words: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        for memory in (self.spaced, self.bare, self.words):
            if len(memory) > REMEMBER:
                memory.clear()
        cut, spaced, bare = [], set(), set()
        for text in texts:
            parts = []
            for k, stretch in enumerate(self._stretches(text)):
                if k % 2:
                    parts.append(stretch)
                elif stretch:
                    pieces = stretch.split(" ")
                    bare.add(pieces[0])
                    spaced.update(pieces[1:])
                    parts.append((stretch, pieces))
            cut.append(parts)
        self._learn([p for p in spaced if p not in self.spaced], " ", self.spaced)
        self._learn([p for p in bare if p not in self.bare], "", self.bare)
        return [np.frombuffer(b"".join([self._ids(p) for p in parts]), np.uint32) for parts in cut]

    def _stretches(self, text: str) -> list[str]:
        """Plain text and added tokens by turns."""
        pattern = self.vocabulary.added_pattern
        return [text] if pattern is None or not any(a in text for a in self.vocabulary.added) else pattern.split(text)

    def _ids(self, part) -> bytes:
        if isinstance(part, str):
            return np.uint32(self.vocabulary.added[part]).tobytes()
        stretch, pieces = part
        try:
            return b"".join([self.bare[pieces[0]], *map(self.spaced.__getitem__, pieces[1:])])
        except TypeError:  # a piece that isn't to be read alone
            words = self._cut(stretch, self.classes.plain(stretch))
            self._merge([w for w in set(words) if w not in self.words])
            return b"".join(map(self.words.__getitem__, words))

    def _cut(self, text: str, seen: str) -> list[str]:
        """The words of a text; ``seen``: the text with its stand-ins."""
        return self.find(text) if seen is text else [text[m.start() : m.end()] for m in self.spans(seen)]

    def _learn(self, pieces: list[str], lead: str, memory: dict[str, bytes | None]) -> None:
        words, plain, mixed = self.words, [], []
        for p in pieces:
            seen = self.classes.plain(p)
            if seen.isalpha():
                plain.append(p)
            elif p and not seen[0].isspace() and not seen[-1].isspace():
                mixed.append((p, self.find(lead + p) if seen is p else self._cut(lead + p, lead + seen)))
            else:
                memory[p] = None
        needed = {lead + p for p in plain}
        for _, ws in mixed:
            needed.update(ws)
        self._merge([w for w in needed if w not in words])
        for p in plain:
            memory[p] = words[lead + p]
        for p, ws in mixed:
            memory[p] = b"".join([words[w] for w in ws])

    def _merge(self, texts: list[str]) -> None:
        data = [w.encode() for w in texts]
        rows = self.lexicon.rows(data) if self.lexicon else np.full(len(data), -1)
        rest = []
        for k, row in enumerate(rows.tolist()):
            if row >= 0:
                self.words[texts[k]] = self.lexicon.token_ids(row).astype(np.uint32).tobytes()
            elif len(data[k]) > LONG:
                self.words[texts[k]] = self.vocabulary.merge_long(data[k])
            else:
                rest.append(k)
        for k, ids in zip(rest, self.vocabulary.merge_short([data[k] for k in rest]), strict=True):
            self.words[texts[k]] = ids


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=2)
def encoder(path: str, lexicon: str | None = None) -> Encoder:
    """One per worker process and lexicon; its memory serves all its tasks."""
    return Encoder(vocabulary(path), Transducer(SparkFiles.get(lexicon)) if lexicon else None)


def stretches(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of about ``STRETCH`` characters each."""
    at, held, part = 0, 0, []
    for k, t in enumerate(texts):
        part.append(t or "")
        held += len(part[-1])
        if held >= STRETCH:
            yield at, part
            at, held, part = k + 1, 0, []
    if part:
        yield at, part


def _count_words(longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, texts in stretches(b.column(0).to_pylist()):
                counts = Counter()
                for t in texts:
                    counts.update(t.split(" "))
                words = [w for w in counts if len(w) <= longest and w.isalpha()]
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([counts[w] for w in words], pa.int64())], names=["word", "n"])

    return run


def frequent_words(docs: DataFrame, text_col: str, bound: int, least: int = 8, longest: int = 24) -> list[str]:
    """At most ``bound`` words, all that occur more often than those left out;
    a word counts if it has letters only, at most ``longest`` of them, and
    occurs ``least`` times."""
    counted = docs.select(text_col).mapInArrow(_count_words(longest), "word string, n long")
    counts = counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least).checkpoint()
    ladder = counts.groupBy("n").agg(F.count("*").alias("words"))
    ladder = ladder.select("n", F.sum("words").over(Window.orderBy(F.desc("n"))).alias("upto")).where(F.col("upto") <= bound)
    border = ladder.agg(F.min("n")).first()[0]
    return [] if border is None else [r["word"] for r in counts.where(F.col("n") >= border).select("word").collect()]


def ship_lexicon(docs: DataFrame, path: str, text_col: str, bound: int) -> str:
    """Compiles the lexicon and gives it to all executors; its file's name."""
    words = [" " + w for w in frequent_words(docs, text_col, bound)]
    data = [w.encode() for w in words]
    table = compile_words(data, [np.frombuffer(i, np.uint32) for i in vocabulary(path).merge_short(data)])
    name = f"lexicon-{hashlib.sha256(table).hexdigest()[:24]}.bin"
    sc = docs.sparkSession.sparkContext
    if name not in [os.path.basename(f) for f in sc.listFiles]:
        local = os.path.join(tempfile.mkdtemp(prefix="lexicon-"), name)
        with open(local, "wb") as f:
            f.write(table)
        sc.addFile(local)
    return name


def _encode(path: str, lexicon: str | None, with_ids: bool, body: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, vocab = encoder(path, lexicon), vocabulary(path)
        for b in batches:
            rest = [n for n in b.schema.names if n != body]
            for at, texts in stretches(b.column(body).to_pylist()):
                ids = enc.encode(texts)
                listed = [i.tolist() for i in ids]
                sha = [hashlib.sha256(b",".join(map(vocab.decimal.__getitem__, i))).hexdigest() for i in listed]
                back = [hashlib.sha256(vocab.decode(i).encode()).hexdigest() for i in ids]
                columns = [b.column(n).slice(at, len(texts)) for n in rest]
                columns += [pa.array([len(i) for i in ids], pa.int64()), pa.array(sha), pa.array(back)]
                names = [*rest, "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    ends = np.cumsum([0, *(len(i) for i in ids)]).astype(np.int32)
                    flat = np.concatenate(ids).astype(np.int32) if ids else np.empty(0, np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
                    names.append("input_ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def encode_documents(docs: DataFrame, path: str, lexicon_words: int = 65536, with_ids: bool = False,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_tokens, ids_sha256, decoded_sha256; with
    ``with_ids`` also the other columns (without the text) and ``input_ids``."""
    prepare(docs.sparkSession)
    lexicon = ship_lexicon(docs, path, text_col, lexicon_words)
    made = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    made += [T.StructField("input_ids", T.ArrayType(T.IntegerType()))] * with_ids
    rest = [c for c in docs.columns if c != text_col] if with_ids else [id_col]
    taken = {*rest, *(f.name for f in made)}

    def free(name: str) -> str:
        while name in taken:
            name += "_"
        taken.add(name)
        return name

    body = free("_text")
    carried = {c: free(c) if any(c == f.name for f in made) else c for c in rest}
    texts = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in carried.items()], F.col(text_col).alias(body))
    schema = T.StructType([T.StructField(n, docs.schema[c].dataType) for c, n in carried.items()] + made)
    return texts.mapInArrow(_encode(path, lexicon, with_ids, body), schema)
