import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from foldspark.llm import packing, rules
from foldspark.llm.shared import tokenizer_path


def _brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    covered = {k + j for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
    )


@pytest.mark.parametrize(
    "text",
    ["", " \n\t", "a b c d e a b c d e", "a " * 30, "x\nx\n\n\nx y\n", "#a *b\n#a *b", "1 2 3 4 5 6 1 2 3 4 5 6 7 3 4 5 6 7"],
)
def test_measure(text):
    assert rules.measure(text) == _brute(text)


def test_measures_of_documents(documents, odd_docs):
    for docs in (documents, odd_docs):
        got = rules.host_rules(docs.select("doc_id", "text", "source"))
        for r in got.collect():
            assert tuple(r[name] for name in rules.MEASURES) == _brute(r.text or "")
        assert got.count() == docs.count()


def test_verdicts_of_hosts(spark):
    good, bad = " ".join(f"w{k}" for k in range(40)), " ".join(f"#w{k}" for k in range(40))
    rows = [(k, good if k % 10 else bad, f"h{k % 4}") for k in range(400)]
    rows += [(1000 + k, bad if k % 10 else good, "junk") for k in range(100)]
    rows += [(2000, bad, "small"), (2001, good, None), (2002, "few words", "h1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r.doc_id: r for r in rules.host_rules(docs, columns=["doc_id", "source"], write_once=True).collect()}
    assert {r.source for r in found.values() if r.bad_host} == {"junk", "small"} or {
        r.source for r in found.values() if r.bad_host
    } == {"junk"}
    assert all(found[k].kept for k in range(400))  # strict failures on a good host stay
    assert [found[1000 + k].kept for k in range(20)] == [k % 10 == 0 for k in range(20)]  # clean documents stay
    assert found[2001].kept and not found[2002].kept
    assert rules.host_rules(docs.limit(0)).count() == 0


def _lengths_fit(patterns, histogram, size):
    used = Counter()
    for pattern, count in patterns:
        assert sum(pattern) <= size and count > 0
        for length in pattern:
            used[length] += count
    assert used == Counter(histogram)


def test_patterns_hold_every_length():
    rng = np.random.default_rng(1)
    for size in (8, 64, 1024):
        for n in (1, 7, 5000):
            histogram = Counter((rng.integers(1, size + 1, n)).tolist())
            patterns = packing.patterns_of(dict(histogram), size)
            _lengths_fit(patterns, histogram, size)
    assert packing.patterns_of({}, 8) == []
    # 6 + 2 and 5 + 3 leave nothing
    assert packing.patterns_of({6: 1, 5: 1, 3: 1, 2: 1}, 8) == [((5, 3), 1), ((6, 2), 1)]


def _check_packing(docs, size):
    path = tokenizer_path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = packing.pack(docs, path, 0, size).withColumn("crc", F.crc32("ids")).collect()
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        want[r.doc_id, tuple(library.encode(r.text or "", add_special_tokens=False).ids) + (0,)] += 1
    got = Counter()
    by_sequence, pieces = {}, {}
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length <= size and r.crc == zlib.crc32(ids.astype("<u4").tobytes())
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault(r.doc_id, []).append((r.start, tuple(ids), r.doc_tokens))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= size
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for doc, parts in pieces.items():
        if sum(1 for start, _, _ in parts if start == 0) == 1:
            parts = sorted(parts)
            assert [p[0] for p in parts] == list(np.cumsum([0, *(len(p[1]) for p in parts[:-1])]))
            ids = sum((p[1] for p in parts), ())
            assert all(p[2] == len(ids) for p in parts)
            got[doc, ids] += 1
    assert all(want[key] == n for key, n in got.items())
    assert sum(r.length for r in rows) == sum(len(ids) * n for (_, ids), n in want.items())
    return rows


def test_packing_of_documents(documents, odd_docs, no_docs):
    rows = _check_packing(documents, 1024)
    sequences = 1 + max(r.sequence_id for r in rows)
    assert sum(r.length for r in rows) > 0.97 * 1024 * (sequences - 1)
    _check_packing(odd_docs, 16)
    assert packing.pack(no_docs, tokenizer_path("byte_bpe_50k.json"), 0).count() == 0
