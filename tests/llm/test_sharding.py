import hashlib
import zlib
from collections import Counter

from foldspark.llm import sharding


def _brute(rows, shards, seed=0):
    """Rows (id, text, source) to (id, size, crc, shard, slot), sorted."""
    def lot(i):
        return hashlib.md5(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:16]

    plain = [(i, (t or "").encode(), s) for i, t, s in rows]
    full = [(lot(i), i is not None, i or 0, len(b) + 16, zlib.crc32(b), s) for i, b, s in plain]
    by = {}
    for r in full:
        by.setdefault(r[5], []).append(r)
    mixed = sorted((((2 * k + 1) / (2 * len(own)), *r) for own in by.values() for k, r in enumerate(sorted(own, key=lambda r: r[:5]))), key=lambda r: r[:6])
    n = len(mixed)
    out = []
    for p, (_, _, known, i, size, crc, _) in enumerate(mixed):
        k = p * shards // n
        out.append((i if known else None, size, crc, k, p - -(-k * n // shards)))
    return sorted(out, key=str)


def _found(docs, shards, seed=0):
    rows = sharding.interleave(docs, shards, seed).collect()
    return sorted(((r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in rows), key=str)


def test_shards_equal_brute_force(spark, documents, odd_docs):
    for docs, shards in ((documents, 40), (odd_docs, 3), (odd_docs, 40), (odd_docs.unionAll(odd_docs), 5)):
        rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
        assert _found(docs, shards) == _brute(rows, shards)


def test_joined_counts_give_the_same(spark, odd_docs, monkeypatch):
    before = _found(odd_docs, 4, 9)
    monkeypatch.setattr(sharding, "BROADCAST_ROWS", -1)
    assert _found(odd_docs, 4, 9) == before


def test_every_shard_has_the_mixture(spark):
    # one source holds two thirds
    docs = spark.range(6000).selectExpr(
        "id AS doc_id", "repeat('x', cast(id % 50 as int)) AS text",
        "CASE WHEN id % 3 > 0 THEN 'hot' ELSE concat('s', id % 12) END AS source", "1 AS shard", "2 AS slot", "3 AS part",
    )
    rows = sharding.interleave(docs, 40).collect()
    sizes = Counter(r.shard for r in rows)
    assert len(sizes) == 40 and max(sizes.values()) - min(sizes.values()) <= 1
    for k in range(40):
        assert sorted(r.slot for r in rows if r.shard == k) == list(range(sizes[k]))
    per = Counter((r.shard, r.source) for r in rows)
    for source, n in Counter(r.source for r in rows).items():
        assert all(abs(per[k, source] - n / 40) <= 3 for k in range(40))
    other = sharding.interleave(docs, 40, seed=1).collect()
    assert {(r.doc_id, r.shard) for r in rows} != {(r.doc_id, r.shard) for r in other}


def test_very_long_and_no_rows(spark, no_docs):
    docs = spark.createDataFrame([(1, "é" * 3_000_000, "a"), (2, "", "a")], "doc_id long, text string, source string")
    assert [r[1] for r in _found(docs, 2)] == [6_000_016, 16]
    assert sharding.interleave(no_docs).count() == 0


def test_written_shards_hold_whole_rows(spark, odd_docs, tmp_path):
    folder = str(tmp_path / "shards")
    sharding.write(odd_docs, folder, shards=4)
    back = spark.read.parquet(folder)
    assert Counter(tuple(r.row) for r in back.collect()) == Counter(tuple(r) for r in odd_docs.collect())
    assert {r.shard for r in back.select("shard").collect()} == {0, 1, 2, 3}
