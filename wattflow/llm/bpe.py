"""Byte-pair encoding and decoding in batched numpy merge rounds.

``Vocabulary`` reads a tokenizer file; ``WordEncoder`` merges all new words of
a batch together; ``encode_texts`` / ``decode_ids`` are what tasks call.
"""

from __future__ import annotations

import functools
import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattflow.llm.common import ragged, text_groups

#: FIXED VALUE: how byte-level vocabularies write the 256 bytes as characters:
#: printable ones as themselves, the others from U+0100 on in byte order.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_OTHERS = [b for b in range(256) if b not in set(_PRINTABLE)]
BYTE_CHARS = {**{b: chr(b) for b in _PRINTABLE}, **{b: chr(256 + i) for i, b in enumerate(_OTHERS)}}
#: FIXED VALUE: the word pattern of the byte-level files that name none.
BYTE_LEVEL_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


class Vocabulary:
    """Symbols, merges and text rules of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max(max(vocab.values()), *self.special.values(), 0) + 1
        self.tokens = [""] * self.size
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        self.byte_id = np.array([vocab[BYTE_CHARS[b]] for b in range(256)], np.int64)
        self.last_id = np.array([vocab[BYTE_CHARS[b] + self.end] for b in range(256)], np.int64)

        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.merged = keys[order], order.astype(np.int64), merged[order]

        steps = spec["normalizer"]["normalizers"] if spec["normalizer"] else []
        self.lower = any(s["type"] == "Lowercase" for s in steps)
        self.nfc = any(s["type"] == "NFC" for s in steps)
        self.blank = any(s["type"] == "Replace" for s in steps)
        pre = spec["pre_tokenizer"]
        self.pattern = (pre["pretokenizers"][0]["pattern"]["Regex"] if pre["type"] == "Sequence"
                        else BYTE_LEVEL_PATTERN)
        pattern = self.pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}")
        self.words = regex.compile(pattern.replace(r"\S", r"\P{White_Space}")).findall
        self.blanks = regex.compile(r"\p{White_Space}+")
        self.split_special = regex.compile(
            "(" + "|".join(regex.escape(t) for t in self.special) + ")").split
        # decoding: the file's decoder joins bytes; without one, tokens are parted by blanks
        self.joined_by = " " if spec.get("decoder") is None else None
        self._byte_of = {c: b for b, c in BYTE_CHARS.items()}

    def normalise(self, text: str) -> str:
        if self.nfc:
            text = unicodedata.normalize("NFC", text)
        if self.blank:
            text = self.blanks.sub(" ", text)
        if self.lower:  # letter by letter: no special form of a sigma at a word's end
            text = text.replace("Σ", "σ").lower()
        return text

    def pieces(self, text: str) -> list[str | int]:
        """Words of a text, and ids where it spells a special token."""
        if not any(s in text for s in self.special):
            return self.words(self.normalise(text))
        out: list[str | int] = []
        for part in self.split_special(text):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out += self.words(self.normalise(part))
        return out

    def decode(self, ids: np.ndarray) -> str:
        names = map(self.tokens.__getitem__, ids.tolist())
        if self.joined_by is not None:
            return self.joined_by.join(names)
        data = bytes(map(self._byte_of.__getitem__, "".join(names)))
        return data.decode("utf-8", errors="replace")


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def merge_words(v: Vocabulary, symbols: np.ndarray, word: np.ndarray,
                leftmost: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Merge rounds over many words in one flat array.

    ``symbols`` are the words' first symbols one after another, ``word`` the
    number of the word of each. A round looks every adjacent pair up by
    binary search in the sorted pair keys, finds the lowest rank of each word,
    and merges that pair wherever it stands in the word (of overlapping places
    the first, third, ...; with ``leftmost`` only the first place of all, for
    vocabularies where what a merge makes may rank better). Words without a known pair leave the flat array.
    Returns final symbols and their words, in word order.
    """
    done_s, done_w = [], []
    none = np.int64(len(v.keys))

    def look_up(at: np.ndarray) -> np.ndarray:
        """Index in the sorted keys of the pairs that begin at ``at``, or ``none``."""
        ok = at[at + 1 < len(symbols)]
        out = np.full(len(at), none)
        pair = symbols[ok] * v.size + symbols[ok + 1]
        i = np.minimum(np.searchsorted(v.keys, pair), none - 1)
        out[:len(ok)] = np.where((v.keys[i] == pair) & (word[ok] == word[ok + 1]), i, none)
        return out

    ranks = np.append(v.ranks, none)
    index = look_up(np.arange(len(symbols)))
    while len(symbols):
        rank = ranks[index]
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        best = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.r_[starts, len(symbols)]))
        active = best < none
        if not active.all():
            done_s.append(symbols[~active])
            done_w.append(word[~active])
        place = np.flatnonzero(active & (rank == best))
        if leftmost:
            place = place[np.r_[True, np.diff(word[place]) > 0][:len(place)]]
        else:  # runs of overlapping hits (a a a): keep every other one
            fresh = np.r_[True, np.diff(place) > 1][:len(place)]
            run_start = place[fresh][np.cumsum(fresh) - 1]
            place = place[(place - run_start) % 2 == 0]
        symbols[place] = v.merged[index[place]]
        active[place + 1] = False
        # only the pairs that touch a merged symbol are looked up anew
        moved = (np.cumsum(active) - 1)[place]
        symbols, word, index = symbols[active], word[active], index[active]
        near = np.zeros(len(symbols), bool)
        near[moved] = near[moved[moved > 0] - 1] = True
        touched = np.flatnonzero(near)
        index[touched] = look_up(touched)
    if not done_s:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    s, w = np.concatenate(done_s), np.concatenate(done_w)
    order = np.argsort(w, kind="stable")
    return s[order], w[order]


class WordEncoder(dict):
    """word -> number; ids of all numbered words in one flat array.

    Unknown words get the next number on lookup and are merged together by
    ``flush``. Past ``max_words`` the cache starts afresh, so memory is bounded.
    """

    def __init__(self, v: Vocabulary, max_words: int = 400_000):
        super().__init__()
        self.v, self.max_words = v, max_words
        self._reset()

    def _reset(self) -> None:
        self.clear()
        self.new: list[str | int] = []
        self.ids = np.zeros(0, np.int32)
        self.length = np.zeros(0, np.int64)
        self.start = np.zeros(0, np.int64)

    def __missing__(self, w: str | int) -> int:
        n = self[w] = len(self)
        self.new.append(w)
        return n

    def begin(self) -> None:
        if len(self) > self.max_words:
            self._reset()

    def flush(self) -> None:
        if not self.new:
            return
        v = self.v
        raw = [w.encode("utf-8") if isinstance(w, str) else b"" for w in self.new]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbols = v.byte_id[data]
        ends = np.cumsum(size)[size > 0] - 1
        symbols[ends] = v.last_id[data[ends]]
        symbols, word = merge_words(v, symbols, np.repeat(np.arange(len(raw)), size))
        special = [i for i, w in enumerate(self.new) if not isinstance(w, str)]
        if special:
            symbols = np.r_[symbols, [self.new[i] for i in special]]
            word = np.r_[word, special]
            order = np.argsort(word, kind="stable")
            symbols, word = symbols[order], word[order]
        length = np.bincount(word, minlength=len(raw))
        start = np.cumsum(length) - length + len(self.ids)
        self.ids = np.r_[self.ids, symbols.astype(np.int32)]
        self.length, self.start = np.r_[self.length, length], np.r_[self.start, start]
        self.new = []


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder a worker process and file."""
    return WordEncoder(vocabulary(path))


def encode_texts(path: str, texts: list[str | None]) -> Iterator[np.ndarray]:
    """Ids (unsigned 32-bit) of each whole text, special tokens' strings in a
    text included, none added; null is empty. The texts of a group of about
    400,000 characters share their merge rounds."""
    enc = encoder(path)
    for i, j in text_groups(texts):
        enc.begin()
        words = []
        for t in texts[i:j]:
            p = enc.v.pieces(t) if t else []
            words.append(np.fromiter(map(enc.__getitem__, p), np.int64, len(p)))
        enc.flush()
        for w in words:
            yield enc.ids[ragged(enc.start[w], enc.length[w])].astype("<u4")


def decode_ids(path: str, ids: np.ndarray) -> str:
    return vocabulary(path).decode(ids)


SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = False) -> DataFrame:
    """Encode every whole text and decode its ids again.

    One row per input row, no shuffle: doc_id, n_tokens, digests of ids and
    decoded text, and with ``with_ids`` the ids themselves. Null and empty
    texts have no tokens. Each worker keeps a bounded cache of word encodings;
    a lost task only starts with an empty one. Other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, h, d, raw = [], [], [], []
            for ids in encode_texts(path, b.column(1).to_pylist()):
                n.append(len(ids))
                h.append(hashlib.sha256(ids.tobytes()).hexdigest())
                d.append(hashlib.sha256(decode_ids(path, ids).encode("utf-8")).hexdigest())
                if with_ids:
                    raw.append(ids.astype(np.int32))
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(h, pa.string()),
                    pa.array(d, pa.string())]
            if with_ids:
                cols.append(pa.array(raw, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = SCHEMA + (", ids array<int>" if with_ids else "")
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids
    src = df.select(F.col(id_col).cast("long").alias("doc_id"),
                    F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, schema)
