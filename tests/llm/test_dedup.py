import hashlib
import random
import re
from pathlib import Path

import numpy as np

from foldspark.llm import blocknames, forest

_WHITE = re.compile(r"[\x20\x09-\x0D]")


def _groups(rows):
    """Brute force of the exact groups: (id, text) rows to (keep_id, size, digest) per row."""
    by = {}
    for i, t in rows:
        by.setdefault(_WHITE.sub("", t or ""), []).append((-len(t or ""), i is None, i))
    out = []
    for i, t in rows:
        body = _WHITE.sub("", t or "")
        keep = min(by[body], key=lambda x: (x[0], x[1], x[2] or 0))[2]
        out.append((i, keep, len(by[body]), i == keep, hashlib.sha256(body.encode()).hexdigest()))
    return sorted(out, key=str)


def _check(docs, **more):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in blocknames.exact_duplicates(docs, **more).collect()), key=str)
    assert got == _groups(rows)


def test_block_names_of_odd_rows(odd_docs, no_docs):
    _check(odd_docs, block=4)
    assert blocknames.exact_duplicates(no_docs).count() == 0


def test_block_names_over_many_levels(spark):
    rng = random.Random(3)
    base = "".join(rng.choice("abc ") for _ in range(300))
    texts = [base, base[:-1] + "z", base.replace(" ", "\n"), "z" + base[1:], base[:150], base[:150] * 2, base, base + " "]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for block in (1, 3, 16, 4096):
        _check(docs, block=block)


def test_block_names_of_documents(documents):
    _check(documents)


def test_keep_one_returns_whole_rows(odd_docs):
    kept = blocknames.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    want = {(i, _WHITE.sub("", t or "")) for (i, t), g in zip(sorted(rows, key=str), _groups(rows)) if g[3]}
    got = [(r.doc_id, _WHITE.sub("", r.text or "")) for r in kept.collect()]
    bodies = [body for _, body in got]
    assert len(bodies) == len(set(bodies)) == len({_WHITE.sub("", t or "") for _, t in rows})
    assert want


def _sets(texts, words):
    out = []
    for t in texts:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        out.append({tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set())
    return out


def components(rows, words, percent):
    """Brute force: smallest reachable id and set size per row."""
    sets = _sets([t for _, t in rows], words)
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(rows[a][0]), find(rows[b][0])
                parent[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i), find(i) == i) for (i, _), s in zip(rows, sets))


def _check_near(docs, words, percent):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = forest.near_duplicates(docs, words=words, percent=percent).select("doc_id", "n_shingles", "component_id", "kept")
    assert sorted(map(tuple, got.collect())) == components(rows, words, percent)


def test_forest_on_documents(documents):
    _check_near(documents, 3, 85)
    _check_near(documents, 5, 80)


def _copies(spark, n, edits, seed, size=300):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(4000)]
    base = [rng.choice(vocabulary) for _ in range(size)]
    texts = [" ".join(base)]
    for _ in range(n):
        copy = list(base)
        for _ in range(edits):
            copy[rng.randrange(size)] = rng.choice(vocabulary)
        texts.append(" ".join(copy))
    texts += [" ".join(rng.choice(vocabulary) for _ in range(size)) for _ in range(30)]
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def test_star_of_copies(spark):
    # copies are linked with the original only
    _check_near(_copies(spark, 12, 7, 1), 3, 85)


def test_dense_group_beyond_the_reach(spark):
    _check_near(_copies(spark, forest.REACH + 60, 4, 2), 3, 85)
    _check_near(_copies(spark, forest.REACH + 60, 7, 5), 3, 85)


def test_confirmation_takes_one_worker_a_task(spark, capsys):
    values = [bytes(np.arange(n, dtype=np.uint64)) for n in (20, 19, 18, 10)]
    sets = spark.createDataFrame([(i, bytes([i]), v) for i, v in enumerate(values)], "node long, set_digest binary, values binary")
    pairs = spark.createDataFrame([(0, 1), (1, 2), (0, 2), (0, 3)], "a long, b long").coalesce(1)
    found = forest.confirmed(pairs, sets, 85)
    found.explain()
    plan = capsys.readouterr().out
    assert plan.count("MapInArrow") == 1 and "EvalPython" not in plan
    links = {tuple(r) for r in found.collect()}
    assert links < {(0, 1), (1, 2), (0, 2)} and {x for link in links for x in link} == {0, 1, 2}


def test_few_rows_take_few_tasks(spark, shared_folder):
    # where the session shuffles into many partitions, frames of a few hundred rows are not written in as many files
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    there = set(Path(shared_folder).rglob("part-*"))
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        _check_near(_copies(spark, forest.REACH + 60, 4, 2), 3, 85)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(set(Path(shared_folder).rglob("part-*")) - there) < 500


def test_forest_on_odd_rows(spark, odd_docs, no_docs):
    found = forest.near_duplicates(odd_docs, words=3, percent=85).collect()
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, []).append(r)
    assert len(found) == odd_docs.count()
    assert all(r.n_shingles == 0 and r.component_id == r.doc_id and r.kept for i in (0, 1, 2) for r in by_id[i])
    assert {(r.component_id, r.kept) for r in by_id[3]} == {(3, True)}
    # a null id is linked with rows of an equal set only
    assert sorted((r.component_id is None, r.component_id) for r in by_id[None]) == [(False, 3), (True, None)]
    assert forest.near_duplicates(no_docs).count() == 0
    kept = forest.keep_one(odd_docs, words=3, percent=85)
    assert kept.columns == odd_docs.columns
    assert [r.text for r in kept.collect()].count("a") == 1


def test_candidates_beyond_the_closest_are_confirmed(spark, monkeypatch):
    monkeypatch.setattr(forest, "KEPT", (1, 1))
    _check_near(_copies(spark, 25, 7, 9), 3, 85)


def test_pages_of_one_template(spark, monkeypatch):
    """Pages that share most words but do not link, a few copies among them, and chains between groups."""
    rng = random.Random(21)
    template = [f"t{k}" for k in range(150)]
    pages = [template + [f"p{rng.randrange(10**6)}" for _ in range(60)] for _ in range(220)]
    for k in range(0, 200, 9):
        copy = list(pages[k])
        copy[170] = "changed"
        pages.append(copy)
    rows = [(i, " ".join(p)) for i, p in enumerate(pages)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    _check_near(docs, 3, 85)
    # the same with cells of a few rows, and without any help of the first rounds
    monkeypatch.setattr(forest, "CELL", 40)
    monkeypatch.setattr(forest, "CELL_BYTES", 20_000)
    monkeypatch.setattr(forest, "KEPT", (0, 0))
    monkeypatch.setattr(forest, "CROWD", 100)
    _check_near(docs, 3, 85)


def test_star_over_many_batches_and_partitions(spark):
    # each variant is linked with the original only, which is in one batch of many
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    docs = _copies(spark, 6000, 6, 11).repartition(16)
    texts = {r.doc_id: r.text for r in docs.collect()}
    first, *others = _sets([texts[i] for i in range(6001)], 3)
    want = {i for i, s in enumerate(others, 1) if 100 * len(first & s) >= 85 * len(first | s)}
    assert len(want) > 3000
    try:
        spark.conf.set(name, "100")
        found = forest.near_duplicates(docs, words=3, percent=85).collect()
    finally:
        spark.conf.set(name, before)
    parts = {r.doc_id: r.component_id for r in found}
    assert not [i for i in want if parts[i] != 0]


def test_checkpoints_leave_no_shuffle_files(spark):
    import glob
    import time

    from foldspark.llm.shared import checkpoint

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    chosen = spark.conf.get(name, None)
    folders = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs())
    files = lambda: {f for d in folders for f in glob.glob(f"{d}/*/shuffle_*")}
    before = files()
    rows = spark.range(1000).selectExpr("id % 7 as k").groupBy("k").count()
    kept = checkpoint(rows.join(rows.withColumnRenamed("count", "n"), "k"))
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    assert kept.count() == 7 and kept.agg({"n": "sum"}).first()[0] == 1000
    assert spark.conf.get(name, None) == chosen
