"""SentencePiece pieces and periodic runs against the library and brute force."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from wattflow.llm import periodic_runs, piece_bpe, registry
from wattflow.llm.common import read_table


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def pieces():
    return piece_bpe.PieceVocabulary(registry.PIECE_BPE)


def test_agenda_equals_the_library(pieces):
    rnd = random.Random(5)
    letters = " ▁\n\t aebcthe1234é世界</s><0x41>￿😀ſ\x00́"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30))) for _ in range(4000)]
    texts += [" " * 50_000 + "x" + " " * 9, "a" * 50_000, "世" * 3000, "\n" * 3000, "The cat, the CAT."]
    assert [pieces.encode(t) for t in texts] == pieces.library.encode(texts)
    for t in texts:
        ids = pieces.encode(t) + [pieces.end]
        assert pieces.decode(ids) == pieces.library.decode(ids)


def test_comparison_with_the_library(pieces):
    pieces.fresh.clear()
    pieces.encode("Some words,\nand  more " + "x" * 100 + "\t12")
    assert pieces.fresh
    pieces.compare()
    pieces.fresh.append("▁thewords")
    pieces.chunk.cache_clear()
    longest = pieces.rank.pop("▁the")
    with pytest.raises(ValueError):
        pieces.compare()
    pieces.rank["▁the"] = longest
    pieces.chunk.cache_clear()
    pieces.fresh.clear()


def test_chunks_part_words_from_marks(pieces):
    for text, parts in (("▁house,", ["▁house", ","]), ("▁(house)***", ["▁(", "house", ")***"]),
                        ("▁▁дом.12", ["▁▁дом", ".", "1", "2"]), ("a▁", ["a", "▁"]), ("\n世", ["\n", "世"])):
        assert pieces.chunks(text) == parts
    crossing = {n[i - 1:i + 1] for n in pieces.rank for i in range(1, len(n))}
    text = "".join(random.Random(9).choices(sorted({*"".join(pieces.rank), *"12\n\t😀"}), k=20_000))
    parts = pieces.chunks(text)
    assert "".join(parts) == text and not crossing & {a[-1] + b[0] for a, b in zip(parts, parts[1:])}


def test_new_chunks_are_merged_together(monkeypatch):
    v = piece_bpe.PieceVocabulary(registry.PIECE_BPE, cached_chunks=50)
    rnd = random.Random(8)
    texts = [" ".join("".join(rnd.choices("aeinstrh", k=rnd.randint(1, 23))) + rnd.choice(["", ",", "***"])
                      for _ in range(200)) for _ in range(20)] + ["", "a" * 24 + " " + "a" * 25]
    want, alone = v.library.encode(texts), []
    monkeypatch.setattr(v, "encode_chunk", lambda c, f=v.encode_chunk: alone.append(c) or f(c))
    assert [x.tolist() for x in v.encode_texts(texts)] == want
    assert alone == ["▁" + "a" * 24, "▁" + "a" * 25]  # only chunks of over 24 characters go one by one
    assert [v.encode(t) for t in texts] == want  # the cache starts afresh before each
    v.compare()


def test_decoding_of_any_ids(pieces):
    rnd = random.Random(6)
    for _ in range(4000):
        ids = [rnd.choice([rnd.randrange(1, 32000), rnd.randint(1, 262)]) for _ in range(rnd.randint(0, 9))]
        assert pieces.decode(ids) == pieces.library.decode(ids)


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_piece_rows(request, pieces, which):
    df = request.getfixturevalue(which)
    want = []
    for r in df.select("doc_id", "text").collect():
        ids = pieces.library.encode(r.text or "") + [pieces.end]
        want.append((str(r.doc_id), len(ids), sha(" ".join(map(str, ids))), sha(pieces.library.decode(ids))))
    got = piece_bpe.pieces_query(df, registry.PIECE_BPE).collect()
    assert sorted((str(r.doc_id), *tuple(r)[1:]) for r in got) == sorted(want)
    assert piece_bpe.encode_pieces(df, registry.PIECE_BPE, check=False, with_row=True).where(
        "row_in.text = decoded or row_in.text is null").count() == df.count()


def runs_by_hand(t, least, periods):
    n, out = len(t), []
    for q in range(1, n // periods + 1):
        same = np.array([t[i] == t[i + q] for i in range(n - q)] + [False])
        edges = np.flatnonzero(np.diff(np.r_[False, same].astype(int)))
        for i, j in zip(edges[::2], edges[1::2]):
            s, size = t[i:j + q], int(j - i + q)
            if size >= max(least, periods * q) and not any(s[d:] == s[:-d] for d in range(1, q)):
                out.append((int(i), size, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("seed", range(10))
def test_runs(seed):
    rnd = random.Random(seed)
    for _ in range(150):
        n = rnd.randint(0, 60)
        t = [rnd.randint(0, rnd.choice([1, 2, 3, 9])) for _ in range(n)]
        if rnd.random() < .7 and n > 8:
            a, p = rnd.randrange(n), rnd.randint(1, 8)
            t = [t[i] if i < a else t[a + (i - a) % p] for i in range(n)] + t[:rnd.randint(0, 9)]
        for least, periods in ((6, 4), (2, 2), (9, 3)):
            assert periodic_runs.find_runs(t, least, periods) == runs_by_hand(t, least, periods)


def test_long_runs():
    n = 30_000
    for q in (1, 7, 2000):
        assert periodic_runs.find_runs([i % q for i in range(n)]) == [(0, n, q)]
    assert periodic_runs.find_runs(list(range(n))) == []


def collapsed_by_hand(doc_id, text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = runs_by_hand(w, 6, 4) if n < 2000 else periodic_runs.find_runs(w)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    milli = 1000 * best[1] // best[2] if found else None
    return (str(doc_id), len(found), *best, milli, sha("".join("%d,%d,%d\n" % r for r in found)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_run_rows(request, which):
    df = request.getfixturevalue(which)
    got = periodic_runs.runs_query(df).collect()
    want = [collapsed_by_hand(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    key = lambda r: tuple(map(str, r))
    assert sorted(((str(r.doc_id), *tuple(r)[1:]) for r in got), key=key) == sorted(want, key=key)
    assert which == "odd" or sum(r.n_runs for r in got) > 5


@pytest.mark.parametrize("name", ["op12_sentencepiece", "op13_periodic_runs"])
def test_empty_documents(spark, docs, tmp_path, name):
    docs.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert registry.QUERIES[name](spark, str(tmp_path)).collect() == []
    assert read_table(spark, str(tmp_path), "documents").count() == 0
