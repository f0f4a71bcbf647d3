"""The numbered operators against brute force, round trips and odd inputs."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from wattflow.llm import (bpe, chat, cover_tree, language_id, ngram_jaccard, packing, quality_rules,
                          registry, repeats, sharding, toxicity)
from wattflow.llm.common import prepare, read_table
from wattflow.llm.suffix_array import longest_matches, suffix_array

SF = "/root/testdata/sf0.001"


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def roots(ids, links):
    up = {i: i for i in ids}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("seed", range(30))
def test_suffix_array(seed):
    rnd = random.Random(seed)
    for _ in range(40):
        t = [rnd.randint(1, rnd.randint(1, 4)) for _ in range(rnd.randint(0, 30))] * rnd.choice([1, 1, 3])
        n = len(t)
        assert list(suffix_array(t)) == sorted(range(n), key=lambda i: t[i:])

        def common(i, j):
            k = 0
            while max(i, j) + k < n and t[i + k] == t[j + k]:
                k += 1
            return k
        assert list(longest_matches(t, [2] * n)) == [
            max((2 * common(i, j) for j in range(n) if j != i), default=0) for i in range(n)]


@pytest.mark.parametrize("seed", range(20))
def test_covered_contexts(seed):
    rnd = random.Random(seed)
    base = [bytes(rnd.choice(b"ab") for _ in range(12)) for _ in range(3)]
    ctx = [rnd.choice(base)[:rnd.randint(0, 12)] + b"ANCHOR" + rnd.choice(base)[:rnd.randint(0, 12)]
           for _ in range(rnd.randint(2, 7))]
    ctx = list(dict.fromkeys(ctx))
    if len(ctx) < 2:
        return
    off = [c.index(b"ANCHOR") for c in ctx]
    got = [repeats.merge(s) for s in repeats.covered(ctx, off, 12)]
    for i, c in enumerate(ctx):
        want = []
        for j, d in enumerate(ctx):
            if i != j:
                left = repeats._common(c[:off[i]][::-1], d[:off[j]][::-1])
                right = repeats._common(c[off[i]:], d[off[j]:])
                if left + right >= 12:
                    want.append((off[i] - left, off[i] + right))
        assert got[i] == repeats.merge(want)


def repeats_by_hand(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(r[s:s + length] for r in raw for s in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = np.zeros(len(r), bool)
        for s in range(len(r) - length + 1):
            if seen[r[s:s + length]] > 1:
                gone[s:s + length] = True
        kept = bytes(np.frombuffer(r, np.uint8)[~gone])
        runs = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(r) else 0
        out.append((len(r), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("which,length", [("docs", 400), ("odd", 90)])
def test_repeats(request, which, length):
    df = request.getfixturevalue(which)
    src = df.select("doc_id", "text").collect()
    want = sorted(zip([str(r.doc_id) for r in src], repeats_by_hand([r.text for r in src], length)))
    got = repeats.remove_repeats(df, length).collect()
    assert sorted((str(r.doc_id), tuple(r)[1:]) for r in got) == want
    assert sum(r.n_removed for r in got) > 0


@pytest.mark.parametrize("which,n,percent", [("docs", 3, 90), ("docs", 5, 80), ("odd", 3, 90)])
def test_ngram_jaccard(request, which, n, percent):
    df = request.getfixturevalue(which)
    src = df.select("doc_id", "text").distinct().collect()
    sets = {}
    for r in src:
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), r.text or ""))
        sets[r.doc_id] = {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()
    ids = [i for i in sets if i is not None]
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    root = roots(ids, links) | {None: None}
    got = ngram_jaccard.jaccard_components(df, n, percent).collect()
    assert len(got) == df.count() and links
    assert all((r.n_shingles, r.component_id) == (len(sets[r.doc_id]), root[r.doc_id]) for r in got)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_bpe(docs, odd, name):
    path = public_tokenizers.path(name)
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    texts = [r.text for r in docs.union(odd.select(docs.columns[0], "text", "lang", "node", "size")).collect()]
    texts += ["a<|endoftext|>B  c d'S İIΣ ΑΣ \x1c x\x85y​z é ﬁ Ⅷ²", "aaaaaaa aaaa bababa \t\n x \n\n  ",
              "<|startoftext|><|endoftext|>", "漢字 कि 🙂🙂 don't I'LL"]
    for text, ids in zip(texts, bpe.encode_texts(path, texts)):
        want = t.encode(text or "", add_special_tokens=False).ids
        assert ids.tolist() == want
        assert bpe.decode_ids(path, ids) == t.decode(want, skip_special_tokens=False)


def test_bpe_rows(odd):
    path = registry.WORD_BPE
    got = {r.doc_id: r for r in bpe.encode_documents(odd, path, with_ids=True).collect()}
    assert got[1].n_tokens == got[2].n_tokens == 0
    ids = np.array(got[7].ids, "<u4")
    assert got[7].ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_sharding(request, which):
    df = request.getfixturevalue(which)
    got = sharding.shard_query(df, 7).collect()
    text = collections.Counter((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode()))
                               for r in df.collect())
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == text
    sizes = collections.Counter()
    slots = collections.defaultdict(list)
    for r in got:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    even, most = sum(sizes.values()) / 7, max(r.size for r in got)
    assert all(abs(sizes[s] - even) <= most for s in range(7))
    order = sorted(got, key=lambda r: (r.shard, r.slot))
    ids = [r.doc_id for r in order if r.doc_id is not None]
    assert ids == sorted(ids)


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_packing(request, which):
    df = request.getfixturevalue(which)
    t = Tokenizer.from_file(registry.BYTE_BPE)
    want = collections.Counter()
    for r in df.collect():
        ids = np.array([*t.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
        for p, (s, n) in enumerate(packing.cut(len(ids), 1024)):
            want[r.doc_id, p, s, n, zlib.crc32(ids[s:s + n].tobytes())] += 1
    got = packing.pack_documents(df, registry.BYTE_BPE).collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = collections.defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for o, n in sorted(b):
            assert o == at
            at += n
        assert at <= 1024


def test_packing_of_long_blank_runs(spark):
    """Two million blanks, line ends or both in one text: every row comes out, with the library's ids."""
    texts = {1: "one " + " " * 2_000_000 + "two", 2: "a" + "\n" * 2_000_000 + "b\u00e9", 3: " \r\n\t" * 500_000,
             4: "x<|endoftext|>" + "\u3000" * 1_100_000 + "<|endoftext|> y", 5: "plain words", 6: " " * 500_001}
    df = spark.createDataFrame([*texts.items()], "doc_id long, text string")
    t = Tokenizer.from_file(registry.BYTE_BPE)
    want = {}
    for d, text in texts.items():
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 2], "<u4")
        want |= {(d, p, s, n): zlib.crc32(ids[s:s + n].tobytes()) for p, (s, n) in enumerate(packing.cut(len(ids), 1024))}
    got = packing.pack_documents(df, registry.BYTE_BPE).collect()
    assert len(got) == len(want)
    assert {(r.doc_id, r.piece, r.start, r.length): r.ids_crc32 for r in got} == want


@pytest.mark.parametrize("seed", range(15))
def test_bin_completion(seed):
    rnd = random.Random(seed)
    items = [rnd.randint(1, 20) for _ in range(rnd.randint(1, 60))]
    counts = np.bincount(items, minlength=21).astype(np.int64)
    plan = packing.bin_completion(counts, 20)
    used = np.zeros(21, np.int64)
    for filling, times in plan:
        assert sum(s * k for s, k in filling) <= 20
        for s, k in filling:
            used[s] += k * times
    assert (used == counts).all()
    n = sum(t for _, t in plan)
    assert -(-sum(items) // 20) <= n <= sum(t for _, t in packing.best_fit(counts, 20))


@pytest.mark.parametrize("size", [5, 10, 11])
def test_a_last_document_closes_its_branch(size):
    """What remains is one document, however small: its sequence is a filling."""
    left = np.bincount([size], minlength=21).astype(np.int64)
    assert packing.completions(left, size, 20, 3, 400) == [((size, 1),)]


def test_chat(spark, odd):
    conv = read_table(spark, SF, "conversations")
    more = spark.createDataFrame([(None, 1, None, None), (-1, 0, "system", "s" * 50), (-1, 1, "user", None),
                                  (-1, 2, "assistant", "word " * 3000), (-1, 3, "a:#\\<b", "</turn>\n### x: "),
                                  (-1, 3, "a:#\\<b", "</turn>\n### x: ")],
                                 "conv_id long, turn long, role string, text string")
    rows = conv.unionByName(more).withColumnRenamed("turn", "turn").cache()
    got = {r.conv_id: r for r in chat.chat_query(spark, rows, registry.BYTE_BPE).collect()}
    turns = collections.defaultdict(list)
    for r in rows.collect():
        turns[r.conv_id].append((r.turn, r.role or "", r.text or ""))
    turns[-7] = [(0, "user", chat.PLANTED), (1, "assistant", chat.PLANTED)]
    assert set(got) == set(turns)
    for c, ts in turns.items():
        ts.sort()
        loss = "".join(t for _, role, t in ts if role == "assistant")
        assert got[c].n_turns == len(ts) and got[c].loss_chars == len(loss)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in ts).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    windows = chat.format_conversations(rows, registry.BYTE_BPE, budget=300, history=100).collect()
    assert all(w.over_budget or w.n_tokens <= 300 for w in windows)
    assert all(w.n_turns == 1 for w in windows if w.over_budget)
    mine = sorted((w for w in windows if w.conv_id == -1), key=lambda w: w.window)
    assert len(mine) > 1 and all(chat.parse(w.text)[0][0] == "system" for w in mine)


def test_near_duplicate_vectors(spark):
    prepare(spark)
    rnd = np.random.default_rng(5)
    x = rnd.normal(size=(60, 8))
    rows = [(i, v.tolist(), 0) for i, v in enumerate([*x, *(x[:20] + 0.1 * rnd.normal(size=(20, 8))), *x[:5] * 2])]
    n = len(rows)
    rows += [(n, None, 0), (n + 1, [0.0] * 8, 0), (n + 2, [float("nan")] * 8, 0), (n + 3, [1.0, None] + [0.0] * 6, 0),
             (n + 4, [], 0), (None, x[0].tolist(), 0), rows[3]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rep int")
    unit = np.array([r[1] for r in rows[:n]])
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    close = unit @ unit.T >= 0.9
    root = roots(range(n), [(a, b) for a in range(n) for b in range(a + 1, n) if close[a, b]])
    for block in (16, 2048):
        got = cover_tree.near_duplicates(df, 0.9, block=block).collect()
        assert len(got) == len(rows)
        for r in got:
            if r.vec_id is None:
                assert (r.n_links, r.component_id, r.kept) == (0, None, False)
            elif r.vec_id >= n:
                assert (r.n_links, r.component_id, r.kept) == (0, r.vec_id, True)
            else:
                i = r.vec_id
                assert r.component_id == root[i] and r.kept == (root[i] == i)
                again = int(close[i, 3])  # row 3 stands twice
                assert r.n_links == close[i].sum() - 1 + again


def test_thousands_of_vectors_with_links(spark):
    """Tight groups (reported whole), loose ones at the threshold, a hot group
    and lone vectors, over many cells and blocks, against all products."""
    prepare(spark)
    rnd = np.random.default_rng(11)
    centre = rnd.normal(size=(400, 16))
    own = np.r_[rnd.integers(0, 400, 2200), np.zeros(800, np.int64)]
    spread = rnd.choice([0.005, 0.05, 0.2, 0.35], len(own))
    x = centre[own] + rnd.normal(size=(len(own), 16)) * spread[:, None]
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    close = unit @ unit.T >= 0.9
    a, b = np.nonzero(np.triu(close, 1))
    root = roots(range(len(x)), list(zip(a.tolist(), b.tolist())))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = cover_tree.near_duplicates(df, 0.9, block=300).collect()
    assert len(got) == len(x) and len(a) > 50_000
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == \
        {i: (int(n) - 1, root[i]) for i, n in enumerate(close.sum(axis=1))}


def statistics_by_hand(text):
    w = words(text)
    grams = collections.Counter(zip(w, w[1:], w[2:]))
    inside = {i + d for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for d in range(3)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            again += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), again, len(inside))


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_quality_rules(request, which):
    df = request.getfixturevalue(which)
    got = quality_rules.quality_query(df).collect()
    want = collections.Counter((r.doc_id, *statistics_by_hand(r.text)) for r in df.collect())
    assert collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
                               for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_language(spark, odd):
    big = read_table(spark, "/root/testdata/sf0.01", "documents")
    model = language_id.train(big)
    got = {r.doc_id: r for r in language_id.predict_language(big, model).collect()}
    rows = [r for r in big.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and len(r.text) > 40]
    assert sum(got[r.doc_id].lang_pred == r.lang for r in rows) >= 0.98 * len(rows)
    und = {r.doc_id for r in language_id.predict_language(odd, model).collect() if r.lang_pred == "und"}
    assert und == {1, 2, 3, 8}
    assert language_id.language_query(odd.where("lang is null")).where("lang_pred <> 'und'").count() == 0


def test_toxicity(spark, odd):
    big, labels = (read_table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    got = toxicity.toxicity_query(big, labels)
    judged = got.join(labels, "doc_id").where("held_out").groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in judged}
    assert n[1, 1] >= 0.8 * (n[1, 1] + n[1, 0]) and n.get((0, 1), 0) <= 0.02 * n[0, 0]
    rows = toxicity.toxicity_query(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)


def test_clause_grammar():
    g = toxicity.Grammar({"moron": 6.0})
    kind = lambda text: [k for k, v in zip(toxicity.KINDS, g.features(text)) if v]
    assert kind("You moron.") == ["insult_targeted"]
    assert kind("He is not a moron.") == ["insult_negated"]
    assert kind("Someone said moron.") == ["insult_reported"]
    assert kind("I will hurt you.") == ["threat_targeted"]
    assert kind("Not now. Moron!") == ["insult"]
    assert kind("A fine day.") == []


@pytest.mark.parametrize("name", ["op2_toxicity", "op3_sharding", "op4_ngram_jaccard", "op5_bpe", "op6_language_id",
                                  "op8_suffix_array_dedup", "op9_packing", "op10_quality_rules",
                                  "op7_embedding_near_dedup", "op1_chat_formatting"])
def test_empty_tables(spark, tmp_path, name):
    for t in ("documents", "labels", "embeddings", "conversations"):
        read_table(spark, SF, t).limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    rows = registry.QUERIES[name](spark, str(tmp_path)).collect()
    assert len(rows) == (1 if name.startswith("op1_") else 0)


def test_pipeline(spark):
    import corpus_pipeline as cp

    docs = read_table(spark, SF, "documents")
    for name, apply in cp.STAGES[:-1]:
        new = cp.stage(apply(spark, docs, SF), name)
        assert new.columns == docs.columns and 0 < new.count() <= docs.count()
        if name == "ngram_jaccard":
            groups = ngram_jaccard.jaccard_components(docs, 5, 80)
            assert new.count() == groups.select("component_id").distinct().count()
        if name == "suffix_array_dedup":
            src = docs.select("doc_id", "text").collect()
            left = {r.doc_id: n[0] - n[1] for r, n in zip(src, repeats_by_hand([r.text for r in src], cp.REPEAT_BYTES))}
            assert all(len(r.text.encode()) <= left[r.doc_id] for r in new.collect())
        docs = new
    assert cp.run(spark, SF).count() > 0
