"""BPE, its lexicon and the token store against the tokenizers library."""

import hashlib
import random
import tempfile
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
from fixtures import no_documents, odd_documents, rows, rows_of_odd_documents
from tokenizers import Tokenizer

from pyspark.sql import functions as F

from moodstream.llm import bpe, lexicon, token_store

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def _texts():
    rnd = random.Random(1)
    parts = list("ab c  \n\t 　'sé漢😀!?-12\x1c\x85") + ["<|endoftext|>", "'ll", "'re", "  ", " \n", "\r\n", " the", "ing", " un", "believ", "able"]
    made = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    return made + ["", " ", "  ", "a" * 3000, "ab" * 999 + " " + "x" * 49, "é" * 100] + [r[1] for r in rows_of_odd_documents() if r[1]][:15]


def test_encoder_gives_the_librarys_ids_and_texts(library, tmp_path):
    vocab, texts = bpe.Vocabulary(PATH), _texts()
    words = [(" " + w).encode() for w in ("the", "then", "believable", "able", "un", "alpha", "beta")]
    (tmp_path / "lex").write_bytes(lexicon.compile_words(words, [np.frombuffer(i, np.uint32) for i in vocab.merge_short(words)]))
    for enc in (bpe.Encoder(vocab), bpe.Encoder(vocab, lexicon.Transducer(str(tmp_path / "lex"))), token_store.LibraryEncoder(PATH)):
        for text, ids in zip(texts, enc.encode(texts), strict=True):
            want = library.encode(text, add_special_tokens=False).ids
            assert ids.tolist() == want
            assert vocab.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_characters_of_other_unicode_tables_go_to_the_library(library):
    # Assigned or classed differently by the tables of Python, regex and the library.
    odd = [chr(c) for c in (0x558, 0x58B, 0x88F, 0xC5C, 0x208F, 0xA7CE, 0xA7F1, 0xAB6C, 0x107BB, 0x3FC3D)]
    texts = [t for c in odd for t in (f"a{c}b", f"1{c}2 {c}", f"!{c}? x  {c}{c} é", f"{c} <|endoftext|>{c}")]
    enc = token_store.LibraryEncoder(PATH)
    assert [i.tolist() for i in enc.encode(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert not any(enc.foreign[c] for c in "é漢😀\x85　½")
    # A table that has no letter é.
    enc = token_store.LibraryEncoder(PATH)
    enc.find = regex.compile(bpe.PATTERN.replace("\\p{L}", "a-zA-Z").replace(" ?a-zA-Z+", " ?[a-zA-Z]+")).findall
    text = "café1 société2 über3 Größe4"
    assert enc.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_words_are_cut_by_the_librarys_classes(library):
    """Every character that regex module, ``isalpha`` or ``isspace`` class otherwise than the library, beside all that a class matters to."""
    enc = bpe.Encoder(bpe.Vocabulary(PATH))
    every = [chr(c) for c in range(128, 0x110000) if not 0xD800 <= c < 0xE000]
    odd = [c for c in every if enc.classes[c] != c]
    assert len(odd) > 10000
    around = ("{0}'s", "{0}'re x", "a{0}'ll", "x {0}", " {0}{0}", "1{0}2", "a{0}b c", "!{0}?", "{0} ", " {0}  {0}", "\t{0}\n", "{0}1 {1}", "{1}{0}'d", "é{0}漢 {0}'m",
              "<|endoftext|>{0}'t", "{0}\u3000'{0}s {1}'ve", " '{0}s")
    texts = [form.format(c, odd[(k * 7919) % len(odd)]) for k, c in enumerate(odd) for form in around]
    for at in range(0, len(texts), 20000):
        part = texts[at : at + 20000]
        assert [i.tolist() for i in enc.encode(part)] == [e.ids for e in library.encode_batch(part, add_special_tokens=False)]


def test_long_and_short_merges_agree():
    vocab, rnd = bpe.Vocabulary(PATH), random.Random(4)
    words = ["".join(rnd.choice("abcdeinrstth") for _ in range(rnd.randint(1, 60))).encode() for _ in range(400)]
    assert [vocab.merge_long(w) for w in words] == vocab.merge_short(words)


def test_transducer_is_minimal_and_finds_only_its_words(tmp_path):
    words = [b"tap", b"taps", b"top", b"tops", b"stop", b"stops", b""]
    ids = [np.arange(len(w)) + 7 for w in words]
    (tmp_path / "lex").write_bytes(lexicon.compile_words(words, ids))
    t = lexicon.Transducer(str(tmp_path / "lex"))
    found = t.rows(words[:-1])
    assert sorted(found.tolist()) == list(range(1, 7))
    assert all((t.token_ids(r) == ids[k]).all() for k, r in enumerate(found.tolist()))
    assert t.rows([b"ta", b"stopss", b"x", b"sto"]).tolist() == [-1] * 4
    # "ta" and "to" are one state, and "sto" the same: start, t, s, st, ta|to|sto, ..p, ..ps.
    assert len(t.final) == 7


def _digests(library, data):
    out = []
    for r in data:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        out.append((r[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    return sorted(out, key=str)


def test_documents_are_encoded_as_the_library_does(spark, library):
    docs, data = odd_documents(spark), rows_of_odd_documents()
    assert sorted(rows(bpe.encode_documents(docs, PATH, lexicon_words=5)), key=str) == _digests(library, data)
    clash = docs.withColumnsRenamed({"fp": "n_tokens", "score": "input_ids"}).withColumn("my col", F.struct(F.lit(1).alias("a b"), F.lit("x").alias("n-c")))
    carried = bpe.encode_documents(clash, PATH, with_ids=True)
    assert carried.columns == ["doc_id", "lang", "source", "n_chars", "_id", "_text", "n_tokens_", "input_ids_", "_hash", "my col", "n_tokens", "ids_sha256",
                               "decoded_sha256", "input_ids"]
    assert sorted(rows(carried.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")), key=str) == _digests(library, data)
    assert {r["my col"]["a b"] for r in carried.collect()} == {1}
    wide = bpe.encode_documents(docs, PATH, with_ids=True)
    assert wide.columns == ["doc_id", "lang", "source", "n_chars", "_id", "_text", "fp", "score", "_hash", "n_tokens", "ids_sha256", "decoded_sha256", "input_ids"]
    for r in wide.collect():
        assert hashlib.sha256(",".join(map(str, r["input_ids"])).encode()).hexdigest() == r["ids_sha256"]
    assert bpe.encode_documents(no_documents(spark), PATH).count() == 0


def test_frequent_words_are_the_most_frequent(spark):
    docs = spark.createDataFrame([("aa aa aa bb bb cc 12 aa,",), ("aa bb cc cc cc dd",), (None,)], "text string")
    # aa 4, cc 4, bb 3, dd 1: two words are above the border, a third would fit, none of a tie is taken in part.
    assert sorted(bpe.frequent_words(docs, "text", 2, least=1)) == ["aa", "cc"]
    assert bpe.frequent_words(docs, "text", 1, least=1) == []
    assert sorted(bpe.frequent_words(docs, "text", 9, least=3)) == ["aa", "bb", "cc"]


def test_token_store_round_trip(spark, library, tmp_path):
    data, folder = rows_of_odd_documents(), str(tmp_path / "store")
    token_store.write_store(odd_documents(spark), folder, PATH)
    want, at = [], 0
    for r in sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array(library.encode(r[1] or "", add_special_tokens=False).ids + [0], "<u4")
        want.append((r[0], at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(rows(token_store.read_digests(spark, folder)), key=str) == sorted(want, key=str)
    got = {r["doc_id"]: r["ids"] for r in token_store.fetch(spark, folder, [3, 12]).collect()}
    assert got == {k: library.encode(data[k][1], add_special_tokens=False).ids + [0] for k in (3, 12)}
    head = spark.read.parquet(f"{folder}/dictionary").first()
    assert hashlib.sha256(bytes(head["data"])).hexdigest() == head["dict_hash"]
    with pytest.raises(ValueError):
        token_store.Frames(head["dict_hash"], b"another dictionary", 2)


def test_empty_token_store(spark):
    folder = tempfile.mkdtemp() + "/store"
    token_store.write_store(no_documents(spark), folder, PATH)
    assert token_store.read_digests(spark, folder).count() == 0


def test_dictionary_does_not_depend_on_arrival_or_one_long_document(spark, tmp_path):
    rnd = random.Random(6)
    data = [(i, " ".join(rnd.choice("alpha beta gamma delta epsilon".split()) for _ in range(200))) for i in range(60)]
    huge = (60, "zeta eta " * 40_000)  # more ids than the whole bound
    found = set()
    for k, given in enumerate(([huge, *data], [*data, huge], [*reversed(data), huge])):
        folder = str(tmp_path / f"store{k}")
        token_store.write_store(spark.createDataFrame(given, "doc_id long, text string").coalesce(1), folder, PATH, sample_bytes=40_000)
        found.add(bytes(spark.read.parquet(f"{folder}/dictionary").first()["data"]))
    assert len(found) == 1 and found.pop()
    folder = str(tmp_path / "none_chosen")
    token_store.write_store(spark.createDataFrame(data, "doc_id long, text string"), folder, PATH, sample_docs=0)
    assert spark.read.parquet(f"{folder}/dictionary").first()["data"]
