"""SentencePiece vocabularies of the merge type: encoding by a score-ordered agenda, and decoding.

The agendas of all short chunks that are new in a group of texts are worked
off together, as arrays: each round merges the best pair of every chunk.
"""

from __future__ import annotations

import codecs
import functools
import re
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattflow.llm.bpe import WordEncoder, merge_words
from wattflow.llm.common import prepare, ragged, row_type, text_groups, whole_row

#: FIXED VALUE: the character that stands for a blank inside pieces.
BLANK = "▁"
#: FIXED VALUE: characters of a chunk up to which its agenda is an array among others, not a heap.
FEW = 24


def _one_by_one(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("piece-bytes", _one_by_one)  # each byte that is no text becomes one mark


def joined_characters(pieces: Iterable[str]) -> list[str]:
    """Classes of characters, blanks left out: two that stand side by side in a piece are in one class."""
    parent: dict[str, str] = {}

    def top(c: str) -> str:
        while parent.setdefault(c, c) != c:
            parent[c] = c = parent[parent[c]]
        return c

    for p in pieces:
        for run in filter(None, p.split(BLANK)):
            top(run[0])
            for a, b in pairwise(run):
                parent[top(a)] = top(b)
    classes: dict[str, list[str]] = {}
    for c in sorted(parent):
        classes.setdefault(top(c), []).append(c)
    return sorted(map("".join, classes.values()), key=lambda c: (-len(c), c))


class ChunkEncoder(WordEncoder):
    """chunk -> number; ids of all numbered chunks in one flat array.

    New chunks are merged by ``flush``. Past ``max_words`` chunks or
    ``max_chars`` of them the cache starts afresh.
    """

    def __init__(self, v: PieceVocabulary, max_words: int, max_chars: int = 1 << 24):
        self.max_chars = max_chars
        super().__init__(v, max_words)

    def _reset(self) -> None:
        super()._reset()
        self.chars = 0

    cache_clear = _reset

    def begin(self) -> None:
        if self.chars > self.max_chars:
            self._reset()
        super().begin()

    def flush(self) -> None:
        if not self.new:
            return
        new, self.new = self.new, []
        ids, length = self.v.encode_chunks(new)
        start = np.cumsum(length) - length + len(self.ids)
        self.ids = np.r_[self.ids, ids]
        self.length, self.start = np.r_[self.length, length], np.r_[self.start, start]
        self.chars += sum(map(len, new))
        self.v.fresh += new

    def known(self, chunk: str) -> list[int] | None:
        n = self.get(chunk, len(self.start))
        return self.ids[self.start[n]:self.start[n] + self.length[n]].tolist() if n < len(self.start) else None


class PieceVocabulary:
    """Pieces, scores and byte ids of a model file, and a cache of encoded chunks.

    The model must not rewrite texts beyond blanks (one is put in front), must
    have a piece for every byte, and none that is kept out of encodings.
    """

    def __init__(self, path: str, cached_chunks: int = 1 << 19):
        self.library = m = sentencepiece.SentencePieceProcessor(model_file=path)
        size = m.get_piece_size()
        names = [m.id_to_piece(i) for i in range(size)]
        probe = "  ½ ﬁ\t é  "
        rewritten = m.decode(m.encode(probe)) != probe
        plain = [i for i in range(size) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i))]
        self.byte_ids = [m.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if rewritten or any(map(m.is_unused, range(size))) or not all(map(m.is_byte, self.byte_ids)):
            raise ValueError(f"{path}: not a byte-fallback model that keeps texts as they are")
        self.end = m.eos_id()
        self.id_of = {names[i]: i for i in plain}
        self.silent = {i for i in range(size) if m.is_control(i)}
        longer = {names[i]: -m.get_score(i) for i in plain if len(names[i]) > 1}
        place = {s: r for r, s in enumerate(sorted(set(longer.values())))}
        self.rank = {n: place[s] for n, s in longer.items()}  # 0 is the best score
        self.output = [b""] * size  # text bytes of each id
        for i in plain:
            self.output[i] = names[i].replace(BLANK, " ").encode("utf-8")
        for b, i in enumerate(self.byte_ids):
            self.output[i] = bytes([b])
        self.starts_blank = np.array([n.startswith(BLANK) for n in names])
        # Chunks that no merge can cross, as no piece holds the two characters at their border: a
        # blank after another character, or characters of two classes. Those in no class are alone.
        if any(re.search(f"[^{BLANK}]{BLANK}", n) for n in self.rank):
            raise ValueError(f"{path}: pieces cross from a word into a blank")
        classes = "|".join(f"[{re.escape(c)}]++" for c in joined_characters(self.rank))
        self.chunks = re.compile(f"{BLANK}*+(?:{classes})|{BLANK}++|.", re.DOTALL).findall
        # The pairs that merge, by ids of pieces: sorted keys, the ranks of the results, and their ids
        self.size = size
        self.piece_of = np.full(0x110000, -1, np.int32)  # by code point
        for n, i in self.id_of.items():
            if len(n) == 1:
                self.piece_of[ord(n)] = i
        halves = [(self.id_of[n[:k]] * size + self.id_of[n[k:]], r, self.id_of[n]) for n, r in self.rank.items()
                  for k in range(1, len(n)) if n[:k] in self.id_of and n[k:] in self.id_of]
        self.keys, ranks, self.merged = np.array(sorted(halves), np.int64).reshape(-1, 3).T.copy()
        self.ranks = np.unique(ranks, return_inverse=True)[1].astype(np.int64)
        self.fresh: list[str] = []  # chunks encoded since the last comparison with the library
        self.chunk = ChunkEncoder(self, cached_chunks)

    def encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks, one after another, and their numbers of ids."""
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        piece = self.piece_of[np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32)].astype(np.int64)
        of = np.repeat(np.arange(len(chunks)), sizes)
        few = sizes <= FEW
        few[of[piece < 0]] = False
        ids, of = merge_words(self, piece[few[of]], of[few[of]], leftmost=True)
        others = [(i, self.encode_chunk(chunks[i])) for i in np.flatnonzero(~few).tolist()]
        if others:
            ids = np.r_[ids, np.fromiter(chain.from_iterable(x for _, x in others), np.int64)]
            of = np.r_[of, np.repeat([i for i, _ in others], [len(x) for _, x in others])]
            order = np.argsort(of, kind="stable")
            ids, of = ids[order], of[order]
        return ids.astype(np.int32), np.bincount(of, minlength=len(chunks))

    def encode_chunk(self, text: str) -> list[int]:
        """Ids of one chunk. An agenda holds every adjacent pair of symbols
        that is a piece; the best score, of equal ones the leftmost, is merged
        first and puts its new neighbours' pairs on the agenda."""
        symbols = self._merge(text)
        try:
            return list(map(self.id_of.__getitem__, symbols))
        except KeyError:
            return list(chain.from_iterable(
                [self.id_of[s]] if s in self.id_of else map(self.byte_ids.__getitem__, s.encode("utf-8"))
                for s in symbols))

    def _merge(self, text: str) -> list[str]:
        """The agenda as a heap; an entry whose pair has changed since is void."""
        n, rank = len(text), self.rank.get
        symbols = list(text)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        pair = [rank(text[i:i + 2], -1) for i in range(n - 1)] + [-1]  # rank of the pair that begins here
        agenda = [(r << 32) | i for i, r in enumerate(pair) if r >= 0]
        heapify(agenda)
        while agenda:
            entry = heappop(agenda)
            i = entry & 0xFFFFFFFF
            if pair[i] != entry >> 32:
                continue
            j = after[i]
            symbols[i] = merged = symbols[i] + symbols[j]
            symbols[j], pair[j] = "", -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                pair[i] = r = rank(merged + symbols[k], -1)
                if r >= 0:
                    heappush(agenda, (r << 32) | i)
            else:
                pair[i] = -1
            h = before[i]
            if h >= 0:
                pair[h] = r = rank(symbols[h] + merged, -1)
                if r >= 0:
                    heappush(agenda, (r << 32) | h)
        return [s for s in symbols if s]

    def encode_texts(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts, without an end id; none of empty ones."""
        self.chunk.begin()
        parts = [self.chunks(BLANK + t.replace(" ", BLANK)) if t else [] for t in texts]
        numbers = [np.fromiter(map(self.chunk.__getitem__, p), np.int64, len(p)) for p in parts]
        self.chunk.flush()
        e = self.chunk
        return [e.ids[ragged(e.start[n], e.length[n])] for n in numbers]

    def encode(self, text: str) -> list[int]:
        return self.encode_texts([text])[0].tolist()

    def compare(self) -> None:
        """Raise unless the library encodes every new chunk alike. It puts a
        blank in front, which a line end parts from the chunk."""
        theirs = self.library.encode(["\n" + c for c in self.fresh], num_threads=1)
        if not self._all_alike(theirs):
            for c, ids in zip(self.fresh, theirs):
                if (self.chunk.known(c) or self.encode_chunk(c)) != ids[2:]:
                    raise ValueError(f"not as the sentencepiece library encodes it: {c[:100]!r}")
        self.fresh.clear()

    def _all_alike(self, theirs: list[list[int]]) -> bool:
        """Whether all new chunks are known, with the library's ids (two stand in front)."""
        e = self.chunk
        n = np.fromiter((e.get(c, -1) for c in self.fresh), np.int64, len(self.fresh))
        if (n < 0).any():
            return False
        length = np.fromiter(map(len, theirs), np.int64, len(theirs)) - 2
        flat = np.fromiter(chain.from_iterable(theirs), np.int32)
        after = np.cumsum(length + 2) - length
        return np.array_equal(length, e.length[n]) and np.array_equal(
            flat[ragged(after, length)], e.ids[ragged(e.start[n], length)])

    def decode(self, ids: list[int]) -> str:
        """Text of ids: control ids are nothing, blanks come back, the one in front goes."""
        out, at = [], 0
        while ids and ids[-1] in self.silent:
            ids = ids[:-1]
        if not self.silent.isdisjoint(ids):  # they also part runs of bytes
            for i in [i for i, x in enumerate(ids) if x in self.silent]:
                out.append(ids[at:i])
                at = i + 1
        out.append(ids[at:])
        text = "".join(b"".join(map(self.output.__getitem__, part)).decode("utf-8", errors="piece-bytes")
                       for part in out)
        first = next((part[0] for part in out if part), None)
        return text[1:] if first is not None and self.starts_blank[first] else text


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> PieceVocabulary:
    return PieceVocabulary(path)


def encode_pieces(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                  check: bool = True, with_row: bool = False) -> DataFrame:
    """doc_id, ids and decoded of every whole text, one row per input row.

    ``ids`` end with the model's end id; ``decoded`` is their text. With
    ``check``, all chunks that are new in an Arrow batch are encoded by the
    sentencepiece library, too, and a difference fails the task; a text's ids
    are those of its chunks. Null and empty texts have only the end id and an
    empty ``decoded``. Null ids, repeated ids and rows are encoded row by row,
    other columns ignored (``with_row`` adds the input row as the struct
    ``row_in``); an empty table gives an empty result. No shuffle. Each worker
    keeps a bounded cache of short chunks; a lost task only starts with an
    empty one. ``path`` is the same on every machine.
    """
    prepare(df.sparkSession)
    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                    *whole_row(df, with_row))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for whole in batches:
            texts = [t or "" for t in whole.column(1).to_pylist()]
            for i, j in text_groups(texts):
                b = whole.slice(i, j - i)
                ids = v.encode_texts(texts[i:j])
                if check:
                    v.compare()
                v.fresh.clear()
                ids = [np.append(x, np.int32(v.end)) for x in ids]
                ends = np.cumsum([0, *map(len, ids)])
                flat = np.concatenate(ids)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                     pa.array([v.decode(x.tolist()) for x in ids], pa.string()), *b.columns[2:]],
                    names=["doc_id", "ids", "decoded", *b.schema.names[2:]])

    return src.mapInArrow(run, "doc_id long, ids array<int>, decoded string" + row_type(src, with_row))


def pieces_query(docs: DataFrame, path: str) -> DataFrame:
    ids = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return encode_pieces(docs, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
