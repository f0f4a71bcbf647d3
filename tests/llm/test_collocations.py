"""Phrase collocations against brute force."""

import collections
import re
import types
from urllib.parse import unquote, urlparse

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from wattflow.llm import collocations, registry


def phrases_by_hand(rows, least, top, percent):
    counts, totals = collections.defaultdict(collections.Counter), collections.Counter()
    for r in rows:
        lang = r.lang if r.lang is not None else "und"
        text = re.sub("[A-Z]", lambda m: m[0].lower(), r.text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, 5):
                counts[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        found = []
        kept = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        absorbed = {p[i:i + m] for p, a in kept.items() for m in range(2, len(p)) for i in range(len(p) - m + 1)
                    if 100 * a >= percent * f[p[i:i + m]]}
        for p, a in kept.items():
            score, _, left, right = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]])
                                        for k in range(1, len(p)))
            if p not in absorbed:
                found.append((-score, -a, " ".join(p).encode(), left, right))
        for i, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, i, p.decode(), -a, left, right, totals[lang], -s))
    return sorted(out)


@pytest.mark.parametrize("which,least,top", [("docs", 30, 2000), ("docs", 4, 25), ("odd", 3, 2000), ("odd", 2, 40)])
def test_collocations(request, monkeypatch, which, least, top):
    df = request.getfixturevalue(which)
    monkeypatch.setattr(collocations, "BLOCK_WORDS", 700)  # several blocks a language
    got = collocations.mine_collocations(df, least, top).collect()
    want = phrases_by_hand(df.select("text", "lang").collect(), least, top, 80)
    assert want and sorted(tuple(r) for r in got) == want


def test_pieces_and_ties(spark):
    rows = [("a b. a b\tA B, a  b\nc d", "x"), ("c d c d c d", "x"), (None, None), ("", None), ("q", None)]
    df = spark.createDataFrame(rows * 10, "text string, lang string")
    got = sorted(map(tuple, collocations.mine_collocations(df, least=10).collect()))
    assert got == phrases_by_hand(df.collect(), 10, 2000, 80)
    assert not any(r[0] == "und" for r in got)


def test_empty(spark, docs, tmp_path):
    docs.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert registry.QUERIES["op11_collocations"](spark, str(tmp_path)).collect() == []


def test_blocks_are_handled_one_by_one(spark, monkeypatch):
    """A file and a batch of several blocks would lie in memory as a whole."""
    class Spied(collocations._Step):
        def seen(self, batches):
            for b in batches:
                assert b.num_rows <= 1, f"{b.num_rows} blocks at once"
                yield b

        def hashed(self, batches):
            return super().hashed(self.seen(batches))

        def named(self, batches):
            return super().named(self.seen(batches))

        def kept(self, batches):
            return super().kept(self.seen(batches))

    files = []

    def stage(df, name, *options):
        out = whole(df, name, *options)
        if name.startswith("occurrences"):
            files.extend(unquote(urlparse(f).path) for f in out.inputFiles())
        return out

    whole = collocations.stage
    monkeypatch.setattr(collocations, "_Step", Spied)
    monkeypatch.setattr(collocations, "stage", stage)
    rows = [("a b c d " * 75_000, lang) for lang in ("x", "y", "z")]
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    df = spark.createDataFrame(rows, "text string, lang string").coalesce(1)
    got = collocations.mine_collocations(df).collect()
    assert sorted(map(tuple, got)) == phrases_by_hand(df.collect(), 30, 2000, 80)
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before
    held = [pq.ParquetFile(f).metadata for f in files]
    assert sum(m.num_rows for m in held) == 9
    assert all(m.num_row_groups == m.num_rows for m in held)


def test_phrases_leave_in_small_batches(monkeypatch):
    monkeypatch.setattr(collocations, "SENT_PHRASES", 100)
    monkeypatch.setattr(collocations, "HELD_PHRASES", 500)
    texts = [" ".join(f"é{(i * k) % 701}" for i in range(400)) for k in (1, 2, 1, 3, 1)]
    blocks = []
    for t in texts:
        block = collocations._Block("x")
        block.add(t.encode("utf-8"))
        block.close()
        blocks.append(block.keep(block.longer(), 2).row(0))
    got, want = collections.Counter(), collections.Counter()
    for b in collocations._Step(2, None, None, done=True).named(iter(blocks)):
        assert b.num_rows <= 100 and b.schema.types == [pa.string(), pa.string(), pa.int64()]
        got.update({(r["lang"], r["phrase"]): r["n"] for r in b.to_pylist()})
    for t in texts:
        words = t.split(" ")
        want.update(("x", " ".join(w)) for w in zip(words, words[1:]))
    assert got == want


def test_open_blocks_of_many_languages(monkeypatch):
    monkeypatch.setattr(collocations, "TaskContext", types.SimpleNamespace(
        get=lambda: types.SimpleNamespace(partitionId=lambda: 0)))
    monkeypatch.setattr(collocations, "BLOCK_WORDS", 50)
    monkeypatch.setattr(collocations, "OPEN_WORDS", 100)
    taken = 0

    def batches():
        nonlocal taken
        for i in range(200):
            taken += 10
            yield pa.RecordBatch.from_pydict({"lang": [f"l{i % 40}"], "text": ["w " * 10]})

    given = 0
    for b in collocations._relation(batches()):
        given += len(b.column("word")[0])
        assert b.column("lang")[0].as_py().startswith("l") and taken - given <= 100
    assert given == taken == 2000
