import re
import zlib

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from foldspark.llm import pii, rules
from foldspark.llm.shared import tokenizer_path
from tests.llm.test_dedup import components


def _bad_hosts(failed):
    """Brute force of the hosts whose shrunk rate is over 0.3; ``failed``: host to a list of 0 and 1."""
    n = {h: len(x) for h, x in failed.items()}
    total = sum(n.values())
    mean = sum(map(sum, failed.values())) / total
    between = sum(n[h] * (sum(x) / n[h] - mean) ** 2 for h, x in failed.items())
    spread = (between - (len(n) - 1) * mean * (1 - mean)) / (total - sum(k * k for k in n.values()) / total)
    strength = max(mean * (1 - mean) / spread - 1, 0) if spread > 0 else float("inf")
    rates = {h: mean if strength == float("inf") else (sum(x) + mean * strength) / (n[h] + strength) for h, x in failed.items()}
    return {h for h, rate in rates.items() if rate > 0.3}


def _brute_rows(docs):
    """Rows that the first three stages keep."""
    kept, failed, strict = [], {}, set()
    rows = docs.collect()
    for r in rows:
        n, chars, symbols, doubled, repeated = rules.measure(r.text or "")
        base = n < 10 or 100 * repeated > 20 * n
        hard = base or 100 * symbols > 5 * chars or doubled > 3
        failed.setdefault(r.source, []).append(int(hard))
        strict |= {r.doc_id} if hard else set()
        if not base:
            kept.append((r.doc_id, r.text))
    bad = _bad_hosts(failed)
    gone = {r.doc_id for r in rows if r.source in bad} & strict
    kept = [(i, t) for i, t in kept if i not in gone]
    groups = {}
    for i, t in kept:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t), []).append((-len(t), i, t))
    kept = sorted((i, t) for _, i, t in (min(g) for g in groups.values()))
    first = {i for i, _, _, is_first in components(kept, 5, 80) if is_first}
    return [(i, t) for i, t in kept if i in first]


def test_run_against_brute_force(spark, folder, documents):
    want = _brute_rows(documents)
    frame = spark.createDataFrame(want, "doc_id long, text string")
    want = {r.doc_id: r.text for r in pii.pseudonymise(frame, corpus_pipeline.PII_KEY).collect()}
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    pieces = {}
    places = {}
    for r in corpus_pipeline.run(spark, folder).collect():
        pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(pieces) == sorted(want)
    for i, text in want.items():
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4")
        parts = sorted(pieces[i])
        assert sum(p[1] for p in parts) == len(ids) == parts[0][3]
        for start, length, crc, _ in parts:
            assert zlib.crc32(ids[start : start + length].tobytes()) == crc
    for parts in places.values():
        parts.sort()
        assert [p[0] for p in parts] == list(np.cumsum([0, *(p[1] for p in parts[:-1])]))
        assert sum(p[1] for p in parts) <= 1024


def test_stages_keep_columns_and_stand_odd_rows(spark, odd_docs, no_docs, folder):
    extra = odd_docs.withColumn("_row", F.lit("r")).withColumn("_digest", F.lit(1)).withColumn("n_pii", F.lit("n")).withColumn("n_words", F.lit(2))
    for docs in (extra, no_docs, extra.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, docs, folder)
            if name == "packing":
                assert found.columns[:3] == ["doc_id", "start", "length"]
            else:
                assert found.dtypes == docs.dtypes
                assert found.count() <= docs.count()
            found.collect()


def test_pseudonyms_leave_clean_rows_alone(spark, documents, folder):
    found = {r.doc_id: r for r in corpus_pipeline.pseudonyms(spark, documents, folder).collect()}
    for r in documents.collect():
        new = found[r.doc_id]
        if new.text == r.text:
            assert new == r
        else:
            assert new.n_chars == len(new.text) and re.search("[0-9@]", r.text)
