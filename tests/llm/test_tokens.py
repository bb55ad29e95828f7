import uuid
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from foldspark.llm import bpe, repair
from foldspark.llm.shared import shared_folder as folder_of
from foldspark.llm.shared import tokenizer_path
from foldspark.llm.tokens import library_encoder
from tests.llm.conftest import ODD_TEXTS

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


@pytest.mark.parametrize("name", FILES)
def test_pieces_give_the_ids_of_whole_texts(name, documents):
    path = tokenizer_path(name)
    library, encode = Tokenizer.from_file(path), library_encoder(path)
    texts = [r.text for r in documents.select("text").collect()][:120] + ODD_TEXTS
    for batch in (pa.array(texts), pa.array(texts).slice(7, 40), pa.array([], pa.string())):
        ids, offsets = encode(batch)
        for k, text in enumerate(batch.to_pylist()):
            want = library.encode(text or "", add_special_tokens=False).ids
            assert ids[offsets[k] : offsets[k + 1]].tolist() == want


@pytest.mark.parametrize("name", FILES)
def test_stops_behind_every_kind_of_character(name):
    path = tokenizer_path(name)
    library, encode = Tokenizer.from_file(path), library_encoder(path)
    # all of the first blocks, where letters, marks and digits change their case in odd ways, and a part of the rest
    points = [*range(0x20, 0x600), *range(0x1E00, 0x2200), *range(0x600, 0x1E00, 13), *range(0x2200, 0xD800, 97), *range(0xFB00, 0xFB10)]
    texts = [f"one tw{chr(c)}. So{chr(c)}, {chr(c)}. {chr(c)}.\nx" for c in points] + ["KADIKÖYİ. Son", "İ. İ, aİ.\nb"]
    ids, offsets = encode(pa.array(texts))
    for k, text in enumerate(texts):
        assert ids[offsets[k] : offsets[k + 1]].tolist() == library.encode(text, add_special_tokens=False).ids, ascii(text)


def test_rounds_go_on_until_no_pair_pays():
    rng = np.random.default_rng(6)
    passage = rng.integers(0, 5000, 700).tolist()
    ids, offsets = _shard([[*rng.integers(0, 5000, 50).tolist(), *passage] for _ in range(40)])
    symbols, _, rules = repair.compress(ids, offsets, 5000)
    # the passage of every document is a few symbols in the end
    assert len(symbols) < 40 * 60 and len(rules) > 6
    left = Counter(zip(symbols[:-1].tolist(), symbols[1:].tolist()))
    assert max(left.values()) < 2 * repair.LEAST  # runs of one pair may overlap


def test_rank_arrays_against_the_library(documents, odd_docs, no_docs):
    path = tokenizer_path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    for docs in (documents, odd_docs):
        got = Counter((r.doc_id, tuple(r.ids), r.decoded) for r in bpe.encode_and_decode(docs, path).collect())
        want = Counter()
        for r in docs.select("doc_id", "text").collect():
            ids = library.encode(r.text or "", add_special_tokens=False).ids
            want[r.doc_id, tuple(ids), library.decode(ids, skip_special_tokens=False)] += 1
        assert got == want
    assert bpe.encode_and_decode(no_docs, path).count() == 0


def test_long_words_merge_in_the_same_order():
    merger = bpe._of(tokenizer_path("byte_bpe_50k.json"))[0].merger
    rng = np.random.default_rng(4)
    for n in (2, 5, 40, 200):
        for alphabet in (b"ab", b"aeinrst", bytes(range(97, 123))):
            word = bytes(rng.choice(list(alphabet), n).tolist())
            parts = [merger.of_byte[b] for b in word]
            assert merger._scan(list(parts)) == merger._queue(list(parts))


def test_malformed_bytes_decode_to_replacements():
    vocabulary = bpe._of(tokenizer_path("byte_bpe_50k.json"))[0]
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    ids = [i for i, b in enumerate(vocabulary.bytes) if b in (b"\xe9", b"\xc3")][:2] + [64]
    assert vocabulary.decode(np.array(ids), np.array([0, len(ids)])) == [library.decode(ids)]


def _shard(documents_):
    ids = np.array([i for d in documents_ for i in d], np.uint32)
    return ids, np.cumsum([0, *map(len, documents_)])


def test_shards_round_trip():
    rng = np.random.default_rng(2)
    cases = [
        [[1]],
        [[5] * 999, [5] * 1000, [1]],
        [rng.integers(0, 4, 500).tolist() for _ in range(20)],
        [rng.integers(0, 49_408, 300).tolist() for _ in range(5)],
        [([7, 8, 9] * 50 + [1]) for _ in range(30)],
        [],
    ]
    for documents_ in cases:
        ids, offsets = _shard(documents_)
        shard = repair.Shard(repair.to_bytes(ids, offsets, least=2))
        assert [shard.document(i).tolist() for i in range(shard.documents)] == documents_
        whole, bounds = shard.documents_at(0, shard.documents)
        assert whole.tolist() == ids.tolist() and bounds.tolist() == offsets.tolist()
    repeated = cases[4]
    ids, offsets = _shard(repeated)
    shard = repair.Shard(repair.to_bytes(ids, offsets, least=2))
    assert len(shard.symbols) < len(ids) / 10


def test_overlapping_pairs_keep_documents_apart():
    ids, offsets = _shard([[3, 3, 3], [3, 3], [3]])
    symbols, first, rules = repair.compress(ids, offsets, 4, least=2)
    assert len(rules) >= 1 and first.tolist() == [0, 2, 3, 4]


@pytest.mark.parametrize("shard_tokens", [50, 1_500_000])
def test_files_hold_the_library_ids_in_order(spark, documents, odd_docs, shard_tokens):
    path = tokenizer_path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    for docs in (documents, odd_docs):
        files = f"{folder_of(spark)}/test-grammar-{uuid.uuid4().hex}"
        repair.write(docs, files, path, 1, shard_tokens)
        got = sorted(
            (r.start, r.doc_id, r.n_tokens, r.crc)
            for r in repair.read(spark, files).withColumn("crc", F.crc32("ids")).collect()
        )
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        order = [i for _, i, _, _ in got]
        assert order == sorted(order, key=lambda i: (i is not None, i or 0))
        want = Counter()
        for i, text in rows:
            ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
            want[i, len(ids), zlib.crc32(ids.tobytes())] += 1
        assert Counter((i, n, c) for _, i, n, c in got) == want
        assert [s for s, _, _, _ in got] == list(np.cumsum([0, *(n for _, _, n, _ in got[:-1])]))


def test_an_empty_table_writes_no_document(spark, no_docs):
    files = f"{folder_of(spark)}/test-grammar-{uuid.uuid4().hex}"
    repair.write(no_docs, files, tokenizer_path("word_bpe_49k.json"), 1)
    assert repair.read(spark, files).count() == 0


def test_words_by_rank_have_the_ids_of_the_library():
    import random

    from tokenizers import Tokenizer

    from foldspark.llm.shared import tokenizer_path
    from foldspark.llm.tokens import _spelled_letters, _word_encoder

    path = tokenizer_path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    encode, letters, pick = _word_encoder(path, tokenizer), _spelled_letters(), random.Random(3)
    words = ["".join(pick.choices("etaoinshrßéøµ", k=pick.randint(1, 12))) for _ in range(5000)]
    words += ["a" * n for n in range(1, 200)] + ["the", "ÿ"]
    ids = [[x.id for x in tokenizer.model.tokenize(w.translate(letters))] for w in words]
    assert [memoryview(x).cast("I").tolist() for x in encode(words)] == ids
    assert encode([]) == []
    # a vocabulary without a mark of its own at words' ends is left to the other ways
    path = tokenizer_path("byte_bpe_50k.json")
    assert _word_encoder(path, Tokenizer.from_file(path)) is None


def test_new_words_take_no_step_of_their_own():
    from foldspark.llm.tokens import PieceEncoder

    path = tokenizer_path("word_bpe_49k.json")
    library, made = Tokenizer.from_file(path), library_encoder(path)
    alone = []
    encoder = PieceEncoder(lambda pieces: alone.append(pieces) or made.encode(pieces), lower=True, words=made.words)
    rng = np.random.default_rng(8)
    letters = list("etaoinshrdluETAßéÉÄøµªº")
    others = list("etaéÉ0123456789.,;:!?#$%&()*+-/=@[]^_`{|}~\"<>")
    texts = []
    for k in range(300):
        words = ["".join(rng.choice(letters if rng.random() < 0.7 else others, rng.integers(1, 14))) for _ in range(40)]
        texts.append(("\n" if k % 3 else " ").join(words).replace("<|", "<"))
    # an apostrophe, another alphabet, two blanks in a row, and a text met before
    texts += ["it's l'été 'tis d'd rock'n'roll's''s", "слово Wort λόγος.", "two  blanks", "", texts[0]]
    for batch in (pa.array(texts), pa.array(texts[::-1]), pa.array(texts[:3])):
        ids, offsets = encoder(batch)
        for k, text in enumerate(batch.to_pylist()):
            assert ids[offsets[k] : offsets[k + 1]].tolist() == library.encode(text, add_special_tokens=False).ids, ascii(text)
    plain = [p for pieces in alone for p in pieces if p.strip(" \n").isalnum() and p.isascii()]
    assert plain == [] and sum(map(len, alone)) < 400


def test_rounds_look_at_rare_pairs_once(monkeypatch):
    rng = np.random.default_rng(7)
    passages = [rng.integers(0, 20_000, 200).tolist() for _ in range(30)]
    ids, offsets = _shard([[*rng.integers(0, 20_000, 2000).tolist(), *passages[k % 30]] for k in range(300)])
    looked, frequent = [], repair._frequent
    monkeypatch.setattr(repair, "_frequent", lambda codes, *rest: looked.append(len(codes)) or frequent(codes, *rest))
    shard = repair.Shard(repair.to_bytes(ids, offsets))
    assert shard.documents_at(0, 300)[0].tolist() == ids.tolist()
    assert len(looked) > 6 and sum(looked) < 1.5 * len(ids)


def test_hidden_pairs_are_found_by_sorting(monkeypatch):
    ids, offsets = _shard([[7, 8, 9, 7, 8, 9, 1], [7, 8, 5, 1]])
    nothing = np.empty(0, np.int64)
    monkeypatch.setattr(repair, "_frequent", lambda codes, *rest: (nothing, nothing, nothing, nothing, nothing))
    shard = repair.Shard(repair.to_bytes(ids, offsets, least=2))
    assert len(shard.symbols) < len(ids) - 2 and [shard.document(i).tolist() for i in (0, 1)] == [[7, 8, 9, 7, 8, 9, 1], [7, 8, 5, 1]]


def test_a_round_counts_every_pair():
    rng = np.random.default_rng(9)
    codes = (rng.zipf(1.3, 50_000) % 60_000).astype(np.uint32) * np.uint32(60_001)
    counts = Counter(codes.tolist())
    for least in (2, 8):
        found, number, pairs, sums, waiting = repair._frequent(codes, least)
        assert dict(zip(pairs.tolist(), sums.tolist())) == {c: k for c, k in counts.items() if k >= least}
        assert found.tolist() == [i for i, c in enumerate(codes.tolist()) if counts[c] >= least]
        assert pairs[number].tolist() == codes[found].tolist() and len(waiting) == 0
    # a code and its place that do not fit 64 bits are left to the other way
    wide = np.array([1 << 62, 1 << 62, 5], np.uint64)
    assert all(len(x) == 0 for x in repair._frequent(wide, 2))
    assert repair._frequent_exactly(wide, 2)[0].tolist() == [0, 1]


def test_a_word_is_one_piece_wherever_it_stands():
    from foldspark.llm.tokens import PieceEncoder

    path = tokenizer_path("word_bpe_49k.json")
    library, made, sent = Tokenizer.from_file(path), library_encoder(path), []
    encoder = PieceEncoder(made.encode, lower=True, words=lambda words: sent.append(words) or made.words(words))
    texts = ["Alpha beta\nalpha, beta. alpha", "alpha\nbeta.", "beta,\nAlpha.", "", None]
    ids, offsets = encoder(pa.array(texts))
    for k, text in enumerate(texts):
        assert ids[offsets[k] : offsets[k + 1]].tolist() == library.encode(text or "", add_special_tokens=False).ids
    assert sorted("".join(sent).split("\0")) == ["", ",", ".", "alpha", "beta"]


def test_a_worker_reads_a_vocabulary_once(spark):
    path = tokenizer_path("word_bpe_49k.json")

    def encode(batches):
        import os

        for _ in batches:
            encoder = library_encoder(path, keep=True)
            yield pa.RecordBatch.from_pydict({"pid": [os.getpid()], "made": [id(encoder.words)], "n": [len(encoder(pa.array(["one two"]))[0])]})

    made = {}
    for _ in range(2):
        for r in spark.range(0, 4, 1, 1).mapInArrow(encode, "pid long, made long, n long").collect():
            assert r.n == 2
            made.setdefault(r.pid, []).append(r.made)
    # tasks that met the same worker, if any, met the same merges
    assert all(len(set(x)) == 1 for x in made.values())
    copies = [cloudpickle.loads(cloudpickle.dumps(library_encoder)) for _ in range(2)]
    assert copies[0](path, keep=True).words is copies[1](path, keep=True).words
    assert copies[0](path).words is not copies[0](path).words
