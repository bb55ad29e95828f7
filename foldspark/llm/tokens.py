"""Whole texts to token ids, a distinct piece of text at a time.

Both vocabularies split text at white space before any merge, so a text whose
white space is plain (single spaces, or line feeds) is the concatenation of its
space-separated pieces. Pieces repeat; each is encoded once and kept in a
bounded table, and the ids of a document are gathered with array operations.
Texts with other white space or with a special token's opening are one piece.
"""

from __future__ import annotations

import json
import os
import unicodedata
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from foldspark.llm.shared import kept


def _end_in_a_mark() -> str:
    """Letters and digits whose normal form in lower case ends in something else, such as the capital I with dot."""
    out = []
    for c in map(chr, range(0x80, 0x30000)):
        if unicodedata.category(c)[0] in "LN":
            last = unicodedata.normalize("NFC", c).lower()[-1]
            if unicodedata.category(last)[0] not in "LN":
                out.append(c)
    return "".join(rf"\x{{{ord(c):x}}}" for c in out)


def _odd() -> str:
    """Two white space characters in a row, white space at either end, any other kind of white space or control, "<|",
    and a comma or full stop before white space that is not behind a letter or digit that stays one.
    """
    return (
        r"[ \n][ \n]|^[ \n]|[ \n]$|[\x00-\x09\x0b-\x1f\x7f-\xa0]|[\x{1680}\x{180e}\x{2000}-\x{200f}]|[\x{2028}-\x{202f}\x{205f}-"
        r"\x{206f}\x{3000}\x{feff}]|<\||(?:^|[^\p{L}\p{N}]|[" + _end_in_a_mark() + r"])[.,](?:[ \n]|$)"
    )


#: fixed value: how byte-level vocabularies split text before the merges
BYTE_LEVEL_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# marks of a text's first piece, of a text that is one piece, and of a comma or full stop that ends a word
_FIRST, _ALL, _STOP = _MARKS = ("\x01", "\x02", "\x03")
# pieces of ASCII without apostrophes and letters of Latin-1: lower case is one letter for one, no letter joins another
_SIMPLE = r"^[!-&(-~\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff]{1,200}$"
# in the bytes of such pieces: 0 none, 1 letters (of Latin-1 ones, both bytes), 2 digits, 3 all else
_KIND = np.full(256, 3, np.uint8)
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]], _KIND[48:58], _KIND[0] = 1, 2, 0
#: fixed value: how the vocabulary of lower-case words splits text
WORD_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""


def _joined(table: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of many pieces in a row, and how many each has."""
    return np.frombuffer(b"".join(table), np.uint32), np.fromiter(map(len, table), np.int64, len(table)) >> 2


def _lists(ids: np.ndarray, lengths: np.ndarray) -> pa.LargeListArray:
    """One list of ids per piece."""
    return pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)])), pa.array(ids))


class PieceEncoder:
    """Ids of texts by ``encode(pieces) -> one uint32 byte string per piece``.

    ``entries`` bounds the table of pieces met before; pieces over ``longest``
    characters are not kept in it. A comma or full stop behind a letter is a
    word of its own in both vocabularies, and so it is a piece of its own. With
    ``lower`` (a vocabulary of lower-case words, which drops white space) A to Z are lowered before pieces are told apart,
    and a piece is the same wherever it stands. ``words`` gives the ids of many lower-case words and where each ends; new
    simple pieces of a call go there all at once, and are kept for one more call.
    """

    def __init__(
        self,
        encode: Callable[[list[str]], list[bytes]],
        entries: int = 200_000,
        longest: int = 48,
        lower: bool = False,
        words: Callable[[str], tuple[np.ndarray, np.ndarray]] | None = None,
    ):
        self.encode, self.entries, self.longest, self.lower, self.words = encode, entries, longest, lower, words
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        self.last, self.last_ids = pa.array([], pa.large_string()), _lists(*_joined([]))

    def _look_up(self, pieces: list[str]) -> list[bytes]:
        if len(self.known) > self.entries // 2:
            # what is met again moves to the new table, the rest is forgotten at the next turn
            self.known, self.older = {"": b""}, self.known
        known, get = self.known, self.older.get
        found = list(map(known.get, pieces))
        todo: list[int] = []
        for i, x in enumerate(found):
            if x is None:
                x = get(pieces[i])
                if x is None:
                    todo.append(i)
                else:
                    found[i] = known[pieces[i]] = x
        if todo:
            new = [pieces[i] for i in todo]
            literal = [p[1:] if p[:1] in _MARKS else p if p[:1] == "\n" else " " + p for p in new]
            for i, p, x in zip(todo, new, self.encode(literal)):
                found[i] = x
                if len(p) <= self.longest:
                    known[p] = x
        return found

    def _simple(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of simple pieces in a row, and how many each has."""
        pieces = pc.utf8_lower(pieces)
        lists = pa.ListArray.from_arrays(pa.array([0, len(pieces)], pa.int32()), pieces)
        data = np.frombuffer(pc.binary_join(lists, pa.scalar("\0", pieces.type))[0].as_buffer(), np.uint8)
        data = np.append(data, np.uint8(0))
        # words begin where the kind of character changes, and at every digit
        kind = _KIND[data]
        begins = ((kind[1:] != kind[:-1]) | (kind[1:] == 2)) & (kind[1:] > 0) & (kind[:-1] > 0)
        begins = np.flatnonzero(begins) + 1
        ids, ends = self.words(np.insert(data, begins, np.uint8(0)).tobytes().decode())
        last = np.flatnonzero(data == 0)
        last = np.arange(len(last)) + np.searchsorted(begins, last)
        return ids, np.diff(np.concatenate([[0], ends[last]]))

    def _ids(self, pieces: pa.Array) -> pa.LargeListArray:
        """Ids of distinct pieces."""
        if self.words is None:
            return _lists(*_joined(self._look_up(pieces.to_pylist())))
        # pieces of the texts before are known
        place = pc.index_in(pieces, value_set=self.last)
        new = np.flatnonzero(place.is_null())
        place = pc.fill_null(place, 0).to_numpy().astype(np.int64)
        fresh = pieces.take(pa.array(new))
        simple = pc.match_substring_regex(fresh, _SIMPLE).to_numpy(zero_copy_only=False)
        parts = [self.last_ids]
        for which, ids_of in ((simple, self._simple), (~simple, lambda x: _joined(self._look_up(x.to_pylist())))):
            if which.any():
                place[new[which]] = sum(map(len, parts)) + np.arange(int(which.sum()))
                parts.append(_lists(*ids_of(fresh.filter(pa.array(which)))))
        ids = pa.concat_arrays(parts).take(pa.array(place))
        self.last, self.last_ids = pieces, ids
        return ids

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row (uint32), and where each text begins (with the total at the end)."""
        n = len(texts)
        if n == 0:
            return np.empty(0, np.uint32), np.zeros(1, np.int64)
        texts = pc.fill_null(texts, "") if texts.null_count else texts
        small = (pc.ascii_lower(texts) if self.lower else texts).cast(pa.large_string())
        texts = texts.cast(pa.large_string())
        odd = pc.match_substring_regex(texts, kept("odd texts", _odd))
        # the blank behind gives an empty piece, which has no ids
        blank, nothing = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
        if self.lower:
            plain, stop = pc.binary_join_element_wise(pc.replace_substring(small, "\n", " "), nothing, blank), ""
        else:
            first = pa.scalar(_FIRST, pa.large_string())
            plain, stop = pc.binary_join_element_wise(first, pc.replace_substring(small, "\n", " \n"), blank, nothing), _STOP
        for sign in ",.":
            plain = pc.replace_substring(plain, f"{sign} ", f" {stop}{sign} ")
        single = pc.binary_join_element_wise(pa.scalar(_ALL, pa.large_string()), texts, nothing)
        marked = pc.if_else(odd, single, plain)
        if pc.any(odd).as_py():
            # a piece of its own: no separator may be found in it
            parts = [
                pa.array([[t]] if o else [t.split(" ")], pa.list_(pa.large_string()))
                for t, o in zip(marked.to_pylist(), odd.to_pylist())
            ]
            lists = pa.concat_arrays(parts)
        else:
            lists = pc.split_pattern(marked, " ")
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        found = self._ids(coded.dictionary).take(coded.indices)
        ids, ends = found.flatten().to_numpy(), np.cumsum(pc.list_value_length(found).to_numpy())
        bounds = np.concatenate([[0], np.cumsum(counts)])
        offsets = np.concatenate([[0], ends])[bounds]
        return ids, offsets


def spelled_bytes() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def _spelled_letters() -> dict[int, str]:
    """How byte-level vocabularies spell the characters of Latin-1."""
    spelled = spelled_bytes()
    return {c: "".join(spelled[b] for b in chr(c).encode()) for c in range(256)}


def _rank_encoding(path: str):
    """The vocabulary as a tiktoken encoding, if its ids are in the order of its merges; else None."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    model, spelled = content["model"], spelled_bytes()
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    first = len(spelled)
    plain = not (model.get("end_of_word_suffix") or model.get("continuing_subword_prefix") or content["normalizer"])
    pre = content["pre_tokenizer"] or {}
    plain = plain and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
    if not plain or any(model["vocab"].get(a + b) != first + k for k, (a, b) in enumerate(merges)):
        return None
    of_letter = {c: b for b, c in enumerate(spelled)}
    ranks = {bytes(of_letter[c] for c in token): i for token, i in model["vocab"].items()}
    return tiktoken.Encoding("vocabulary", pat_str=BYTE_LEVEL_SPLIT, mergeable_ranks=ranks, special_tokens={})


def _word_encoder(path: str, tokenizer) -> Callable[[list[str]], list[bytes]] | None:
    """Ids of lower-case words by tiktoken, for a vocabulary whose words end in a mark of their own; None if it cannot.

    Its attribute ``joined`` takes words with a zero byte behind each, and gives all ids and where each word ends.

    A zero byte stands for that mark, and is joined to its letter before any other merge. tiktoken merges by the result,
    the library by the pair; both give the same ids if every token alone is encoded as itself, which is checked here.
    """
    import tiktoken
    from tokenizers import models

    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    mark, vocabulary, spelled = model.get("end_of_word_suffix"), model["vocab"], spelled_bytes()
    if not mark or model.get("continuing_subword_prefix") or model.get("dropout"):
        return None
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    tokens = [*spelled, *(c + mark for c in spelled), *(a + b for a, b in merges)]
    first = 2 * len(spelled)
    if {vocabulary.get(t, -1) for t in tokens[:first]} != set(range(first)):
        return None
    if any(vocabulary.get(t) != first + k for k, t in enumerate(tokens[first:])):
        return None
    of_letter = {c: b for b, c in enumerate(spelled)}
    inner = models.BPE(vocab=vocabulary, merges=merges)
    ranks, is_end = {}, np.zeros(len(tokens), bool)
    for t in tokens:
        i, ends = vocabulary[t], t.endswith(mark)
        body = t[: -len(mark)] if ends else t
        if [x.id for x in (tokenizer.model if ends else inner).tokenize(body)] != [i]:
            return None
        is_end[i] = ends
        if i < len(spelled) or spelled[0] not in body:
            ranks[bytes(of_letter[c] for c in body) + (b"\0" if ends else b"")] = i
        elif i >= first:
            return None  # a merge of the byte that is to be the mark
    # the zero byte with the mark is no word's end: its id is taken by a piece that no word holds
    ranks[b"\0\0"] = vocabulary[spelled[0] + mark]
    if sorted(ranks.values()) != list(range(len(tokens))) or sum(i < len(spelled) for i in map(vocabulary.get, spelled)) != len(spelled):
        return None
    encoding = tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})

    def joined(words: str) -> tuple[np.ndarray, np.ndarray]:
        ids = encoding.encode_to_numpy(words, disallowed_special=())
        return ids, np.flatnonzero(is_end[ids]) + 1

    def encode(words: list[str]) -> list[bytes]:
        if not words:
            return []
        ids, ends = joined("\0".join(words) + "\0")
        ends = (ends * 4).tolist()
        data = ids.tobytes()
        return [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    encode.joined = joined
    return encode


def _library(path: str) -> tuple[Callable[[list[str]], list[bytes]], bool, Callable[[str], tuple[np.ndarray, np.ndarray]] | None, bool]:
    """Ids of pieces, whether words are lowered, ids of many words if they can go to tiktoken, whether ids are ranks."""
    # Spark's tasks are the threads; those of the library would keep memory of their own
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    ranked = _rank_encoding(path)
    merge, letters = tokenizer.model.tokenize, _spelled_letters()
    lower = tokenizer.normalizer is not None  # the vocabulary of lower-case words, which drops white space
    space = "" if lower else letters[32]

    def by_rank(pieces: list[str]) -> list[bytes]:
        plain = ranked.encode_ordinary
        return [array("I", plain(p) if "<|" not in p else chain([p])[0]).tobytes() for p in pieces]

    def chain(pieces: list[str]) -> list[list[int]]:
        return [x.ids for x in tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    by_word = _word_encoder(path, tokenizer) if lower and not ranked else None

    def by_library(pieces: list[str]) -> list[bytes]:
        out, rest, words, places = [], [], [], []
        for i, p in enumerate(pieces):
            before, word = (space, p[1:]) if p[:1] == " " else ("", p)
            if word.isalpha() and (word.isascii() or max(word) < "\u0100"):
                if lower:
                    word = word.lower()
                if by_word:
                    words.append(word)
                    places.append(i)
                    out.append(b"")
                    continue
                if not word.isascii():
                    word = word.translate(letters)
                out.append(array("I", [t.id for t in merge(before + word)]).tobytes())
            else:
                out.append(b"")
                rest.append(i)
        if words:
            for i, ids in zip(places, by_word(words), strict=True):
                out[i] = ids
        if rest:
            for i, ids in zip(rest, chain([pieces[i] for i in rest])):
                out[i] = array("I", ids).tobytes()
        return out

    if ranked:
        return by_rank, False, None, True
    splits = next((x["pattern"] for x in json.loads(tokenizer.to_str())["pre_tokenizer"]["pretokenizers"] if "pattern" in x), None)
    simple = by_word.joined if by_word and splits == {"Regex": WORD_SPLIT} else None
    return by_library, lower, simple, False


def library_encoder(path: str, keep: bool = False) -> PieceEncoder:
    """Encoder with the ids of the tokenizers library.

    With ``keep`` the vocabulary is read and checked once per worker, which holds it (some 30 MB) as long as it lives.
    A byte-level vocabulary whose ids are ranks is merged by tiktoken, which gives the same ids sooner.
    Otherwise a word of Latin-1 letters goes straight to the merges (those of tiktoken where they are the same), and
    any other piece through its whole chain of normaliser, splitter and merges.
    """
    encode, lower, words, ranked = kept(f"vocabulary {path}", lambda: _library(path)) if keep else _library(path)
    return PieceEncoder(encode, entries=400_000) if ranked else PieceEncoder(encode, lower=lower, words=words)


def ids_column(ids: np.ndarray, offsets: np.ndarray, end_id: int | None = None) -> pa.Array:
    """One binary value per text: its ids as little-endian unsigned 32-bit integers, and ``end_id`` behind."""
    if end_id is not None:
        n = len(offsets) - 1
        ids = np.insert(ids, offsets[1:], end_id)
        offsets = offsets + np.arange(n + 1)
    data = pa.py_buffer(np.ascontiguousarray(ids, "<u4"))
    bounds = pa.py_buffer(np.ascontiguousarray(offsets * 4, np.int64))
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, bounds, data])
