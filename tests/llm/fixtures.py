"""Documents with every odd case, and brute-force versions of the operators."""

from __future__ import annotations

import re


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id string, _text string, fp long, score double, _hash string"


def rows_of_odd_documents():
    base = [f"word{i % 7} alpha{i % 5} beta gamma delta{i % 3} epsilon zeta eta{i % 11}" for i in range(40)]
    texts = [None, "", " \t\n", "one", "one two", "One  Two", "a b c", "a b c ", "abc", "ab\tc", "x" * 30000, "long word " * 20000,
             "don't 12 é漢😀 <|endoftext|> x", "ÀÉ ÀÉ", "idiot and moron\nagain", *base, *base[:5]]
    out = [(i, t, ("en", "fr", None)[i % 3], f"src{i % 4}" if i % 9 else None, None if i % 5 else i, "clash", "clash", -1, 0.5, "zz") for i, t in enumerate(texts)]
    out.append(out[7])  # a repeated row
    out.append((None, "a null id text here", "en", "src1", 1, None, None, None, None, None))
    return out


def odd_documents(spark):
    return spark.createDataFrame(rows_of_odd_documents(), SCHEMA).repartition(3, "text")


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return [tuple(r) for r in df.collect()]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def union_find(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return {n: root(n) for n in nodes}


def held_out(ids, modulus, value):
    import zlib

    return {i: i is not None and zlib.crc32(str(i).encode()) % modulus == value for i in ids}
