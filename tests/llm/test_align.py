"""Alignment of two tokenisations against a plain loop over byte ranges."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given
from hypothesis import strategies as st

from trawl.llm import align

FILES = (P.path("byte_bpe_50k.json"), P.PATTERN, P.path("piece_bpe_32k.model"))
TEXTS = [None, "", " ", "a", "The cat sat on the mat, unbelievably.", "Ärger über Öl 日本 👍 <|endoftext|> <s> don't",
         "two  spaces\tand\nlines \n\n end ", "▁ is a space there", "x" * 3000, "0x41 <0x41> 12345.678",
         " ".join(f"w{i % 977}x" for i in range(30_000)), "The cat sat on the mat, unbelievably.", "\x00\x01é́", "ﬁ ½ Ａ"]


@given(st.sets(st.integers(0, 400)), st.sets(st.integers(0, 400)))
def test_gallop_is_the_rank(a, b):
    a, b = np.array(sorted(a), np.int64), np.array(sorted(b), np.int64)
    assert align.gallop(a, b).tolist() == np.searchsorted(b, a).tolist()


def library_tokens(text):
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(FILES[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=FILES[2])
    name_a, name_b = a.id_to_token, b.id_to_piece
    alphabet = align.byte_alphabet()
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    return ([(i, bytes(alphabet[c] for c in name_a(i))) for i in ids_a],
            [(i, bytes([int(name_b(i)[3:5], 16)]) if b.is_byte(i) else name_b(i).replace("▁", " ").encode())
             for i in ids_b])


def brute(texts):
    rows, counts = [], Counter()
    for text in texts:
        a, b = library_tokens(text) if text else ([], [])
        whole = (" " + (text or "")).encode()
        if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            a, b = [], []
        ends = [np.cumsum([len(x) for _, x in t]).tolist() for t in (a, b)]
        both = sorted(set(ends[0]) & set(ends[1]))
        links, j = [], 0
        for i, e in enumerate(ends[0]):
            start = e - len(a[i][1])
            while j < len(b) and ends[1][j] <= start:
                j += 1
            k = j
            while k < len(b) and ends[1][k] - len(b[k][1]) < e:
                links.append((a[i][0], b[k][0]))
                k += 1
        parts, last = [], 0
        for e in both:
            parts.append("|".join(",".join(str(i) for (i, _), x in zip(t, es, strict=True) if last < x <= e)
                                  for t, es in ((a, ends[0]), (b, ends[1]))))
            last = e
        counts.update(links)
        rows.append((len(a), len(b), len(both), links,
                     hashlib.sha256(";".join(parts).encode()).hexdigest() if a else ""))
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(top.get(b, 0), n)
    return [(n_a, n_b, n_g, len(ls), sum(counts[x] == top[x[1]] for x in ls), sum(counts[x] for x in ls), h)
            for n_a, n_b, n_g, ls, h in rows]


@pytest.mark.parametrize("hot", [align.HOT, 20])
def test_equals_brute_force(spark, hot):
    texts = [t for t in TEXTS if t is None or len(t) < 5000]
    rows = [(i, t, 5, "x", "y") for i, t in enumerate(texts)] + [(2, texts[4], 1, "p", "q"), (None, "no id", 1, "p", "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key long, pair string, total string").repartition(3)
    got = align.align(docs, *FILES, hot=hot).collect()
    want = Counter(zip([r[0] for r in rows], brute([r[1] for r in rows]), strict=True))
    assert Counter((r.doc_id, (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256))
                   for r in got) == want
    assert sum(r.n_a == 0 for r in got) >= 3


def test_groups_and_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert align.align(none, *FILES).count() == 0 and align.groups(none, *FILES).count() == 0
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    digests = {r.doc_id: (r.n_groups, r.groups_sha256) for r in align.align(docs, *FILES).collect()}
    got = {}
    for r in align.groups(docs, *FILES).orderBy("doc_id", "row").collect():
        got.setdefault(r.doc_id, []).extend(",".join(map(str, g.a)) + "|" + ",".join(map(str, g.b)) for g in r.groups)
    for i in range(len(TEXTS)):
        n, h = digests[i]
        assert n == len(got.get(i, []))
        assert h == (hashlib.sha256(";".join(got[i]).encode()).hexdigest() if n else "")
