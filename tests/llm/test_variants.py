import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from foldspark.llm import variants

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOW = {c: c + 32 for c in range(65, 91)}


def _words(rows, shortest, least):
    count = Counter()
    for i, text in rows:
        for run in _RUN.findall(text or ""):
            run = run.translate(_LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    return {w: n for w, n in count.items() if n >= least and len(w) >= shortest}


def _is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def _brute(rows, shortest=5, least=3):
    n = _words(rows, shortest, least)
    near = {w: [v for v in n if abs(len(v) - len(w)) <= 1 and _is_near(v, w)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted(((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n), key=str)


def _found(docs, **more):
    return sorted((tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in variants.variants(docs, **more).collect()), key=str)


def test_variants_of_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    assert _found(docs) == _brute([tuple(r) for r in docs.collect()])


@pytest.fixture(scope="module")
def crowded(spark):
    """Words of two letters' alphabet, so that most have near words, over many lengths; accents and capitals."""
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choice("abÀ") for _ in range(rng.randint(5, 9))) for _ in range(60)) for _ in range(60)]
    texts += ["letter letter lettre Letter ÉCOLE École école écolE", None, "", "a", "x" * 50_000, "straße×÷ straße×÷ strasse"]
    rows = [(i, t, "z", 1) for i, t in enumerate(texts)] + [(None, texts[0], "z", 1), (3, texts[3], "z", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, word string, n int")


def test_variants_in_crowded_blocks(crowded, monkeypatch):
    want = _brute([(r.doc_id, r.text) for r in crowded.collect()])
    assert _found(crowded) == want
    # many tiles a block and many groups a tile give the same
    monkeypatch.setattr(variants, "TILE", 8)
    monkeypatch.setattr(variants, "GROUP", 3)
    assert _found(crowded) == want


def test_chains_end_at_their_root(spark):
    texts = ["aaaaa " * 3 + "aaaab " * 8 + "aaabb " * 20 + "aabbb " * 50 + "abbbb " * 130 + "bbbbb " * 300 + "tieaa " * 3 + "tieab " * 9 + "tieac " * 9]
    docs = spark.createDataFrame([(5, t) for t in texts], "doc_id long, text string")
    found = _found(docs)
    assert found == _brute([(5, texts[0])])
    assert {r[2] for r in found if set(r[0]) <= set("ab")} == {"bbbbb"}


def test_no_words(spark, no_docs):
    assert variants.variants(no_docs).count() == 0
    assert variants.variants(spark.createDataFrame([(1, None), (2, "one two")], "doc_id long, text string")).count() == 0


def test_one_edit():
    rng = random.Random(7)
    for _ in range(2000):
        a, b = ("".join(rng.choice("ab") for _ in range(n)) for n in (5, rng.choice((5, 6))))
        got = variants.one_edit(*(np.frombuffer(w.encode(), np.uint8)[None, :] for w in (a, b)))
        assert bool(got[0]) == _is_near(a, b)
