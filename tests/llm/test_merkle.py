"""Manifest against a plain recursion over lists and against its SQL."""

import hashlib
import zlib
from collections import Counter

import duckdb
import pytest

from trawl.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, g string, other string, at long"


def h(t):
    return hashlib.sha256(t.encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tree(nodes):
    """(root, per node the list of (left, right))"""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = nodes[i // 8 * 8:i // 8 * 8 + 8]
            paths[k].append(("".join(run[:i % 8]), "".join(run[i % 8 + 1:])))
            at[k] = i // 8
        nodes = [h("".join(nodes[i:i + 8])) for i in range(0, len(nodes), 8)]
    return nodes[0], paths


def brute(rows):
    by_lang = {}
    for doc_id, text, lang, source, n_chars in rows:
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        low = text and text.translate({c: c + 32 for c in range(65, 91)})
        now = leaf(doc_id, source, lang, n_chars, low if hit else text)
        by_lang.setdefault(lang, []).append((doc_id is not None, doc_id or 0, leaf(doc_id, source, lang, n_chars, text), doc_id, now))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    sub = {x: tree([r[2] for r in sorted(by_lang[x])]) for x in langs}
    root, above = tree([sub[x][0] for x in langs])
    out = []
    for x, up in zip(langs, above, strict=True):
        for (_, _, first, doc_id, now), path in zip(sorted(by_lang[x]), sub[x][1], strict=True):
            path = path + up
            for a, b in path:
                now = h(a + now + b)
            out.append((doc_id, first, sub[x][0], root, h("".join(a + b for a, b in path)), now, now == root))
    return out


def rows_of(n, langs):
    return [(7 * i % n, None if i % 11 == 0 else f"Text {i} É" * (i % 4), langs[i * i % len(langs)],
             None if i % 5 == 0 else f"s{i % 3}", None if i % 7 == 0 else i) for i in range(n)]


CASES = {
    "one": [(0, "A", "en", "s", 1)],
    "nulls": [(None, None, None, None, None), (None, "x", None, "s", 2), (3, "", None, None, 0), (3, "", None, None, 0)],
    "many": rows_of(700, ["en", "en", "en", None, "fr", "ÿ", "Z", "日本"]) + [(5, "again A", "en", "s", 1)] * 3,
    "languages": rows_of(150, [f"l{i}" for i in range(90)]),
    "long": [(1, "Ab" * 500_000, "en", "s", 1), (2, "B", "en", "s", 1)],
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("depth", [1, 4])
def test_equals_recursion(spark, case, depth):
    rows = CASES[case]
    docs = spark.createDataFrame([(*r, "clash", "clash", 9) for r in rows], SCHEMA).repartition(3)
    got = [tuple(r) for r in merkle.audit(docs, depth).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()]
    assert Counter(got) == Counter(brute(rows))


def test_empty(spark):
    assert merkle.audit(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sql():
    con = duckdb.connect()
    con.execute("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    rows = con.execute("select doc_id, text, lang, source, n_chars from documents").fetchall()
    assert Counter(con.execute(merkle.ORACLE_SQL).fetchall()) == Counter(brute(rows))


def test_witness_grows_as_siblings_complete():
    tree_ = merkle.Appender(2, 8, True)
    first = tree_.append("a")
    assert first == []
    for c in "bcdefgh":
        tree_.append(c)
    assert first == [("", "bcdefgh")]
    for i in range(56):
        tree_.append(str(i % 10))
    assert len(first) == 2 and first[1][0] == "" and len(first[1][1]) == 7 * 64
