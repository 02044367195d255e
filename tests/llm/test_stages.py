"""Stages and operators on odd tables: clashing names, maps, nulls, repeated rows; order of the mix; ids of the tokenizer; the network by hand."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

llm = pytest.importorskip("loomspark.llm")
import corpus_pipeline  # noqa: E402
from loomspark.llm import hilbert, langid, linededup, minhash, mixing, packing, secrets  # noqa: E402
from loomspark.llm._common import stage  # noqa: E402
from tests.llm.test_native_and_packing import exact_bins, frame, odd_rows, words  # noqa: E402

ODD = "doc_id long, text string, lang string, source string, n_chars long, _mix string, _times string, _row string, row string, n_lines string, `__t` string, `__drop` string, drop string, m map<string,int>, key string, position string, `a.b` int"


def odd_frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, len(t or ""), *"ABCDEFGH", {"k": 1}, "K", "P", 5) for i, t, lang, s in rows], ODD)


def odd_rows_more():
    rows = odd_rows()
    return [(i, t and t.replace(" beta", "\n"), lang, s) for i, t, lang, s in rows]


@pytest.mark.parametrize("function", [mixing.mixed_documents, minhash.keep_one, linededup.remove_boilerplate])
def test_columns_pass_through(spark, function):
    rows = odd_rows_more()
    out = stage(function(odd_frame(spark, rows)), "test")
    made = ["n_lines", "n_removed"] if function is linededup.remove_boilerplate else []
    assert out.columns == [c for c in odd_frame(spark, []).columns if c not in made] + made
    for r in out.collect():
        assert (r._mix, r._times, r._row, r.row, r["__t"], r["__drop"], r.m, r.key, r["a.b"]) == ("A", "B", "C", "D", "F", "G", {"k": 1}, "K", 5)
    plain = Counter((r.doc_id, r.text) for r in function(frame(spark, rows)).collect())
    assert Counter((r.doc_id, r.text) for r in out.collect()) == plain and plain
    assert function(odd_frame(spark, [])).collect() == []


@pytest.mark.parametrize("name,function", corpus_pipeline.STAGES)
def test_stages_on_odd_tables(spark, sf, name, function):
    docs = frame(spark, odd_rows_more()).select("doc_id", "text", "lang", "source", "n_chars")
    assert function(spark, docs.limit(0), sf).collect() == []
    out = stage(function(spark, docs, sf), "test").collect()
    assert out if name != "quality rules" else all(len(words(r.text)) >= 50 for r in out)
    nothing = docs.select("doc_id", *[F.lit(None).cast(t).alias(c) for c, t in docs.dtypes[1:]])
    assert len(function(spark, nothing, sf).collect()) == (0 if name in ("quality rules", "source mix") else nothing.count())


def test_mix_is_in_the_schedule_order(spark):
    """Every stretch of the mix has each source's share; a plain listing of what is taken would not."""
    rng = random.Random(1)
    rows = [(i, " ".join(f"w{rng.randrange(99)}" for _ in range(50)), "en", "abc"[min(2, i % 6 // 2)] if i % 6 else "d") for i in range(1200)]
    out = mixing.mixed_documents(frame(spark, rows), block_words=100, one_order=True)
    mixed = [r.source for r in out.collect()]
    share, seen = Counter(mixed), Counter()
    for k, s in enumerate(mixed, 1):
        seen[s] += 1
        assert all(abs(seen[x] - k * n / len(mixed)) < 30 for x, n in share.items())
    taken = {r.doc_id: r.taken // 50 for r in mixing.mix(frame(spark, rows), block_words=100).collect()}
    assert sum(abs(Counter(r.doc_id for r in out.collect())[i] - n) for i, n in taken.items()) <= 4


def test_each_file_of_the_mix_is_in_order(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(f"w{rng.randrange(99)}" for _ in range(50)), "en", "abc"[i % 3]) for i in range(600)]
    first = {r.doc_id: r.first_position for r in mixing.mix(frame(spark, rows), block_words=100).collect()}
    parts = defaultdict(list)
    for r in mixing.mixed_documents(frame(spark, rows), block_words=100).select("doc_id", "source", F.spark_partition_id().alias("part")).collect():
        parts[r.part].append((r.doc_id, r.source))
    for mine in parts.values():
        once = [first[i] for n, (i, _) in enumerate(mine) if i not in {j for j, _ in mine[:n]}]
        assert once == sorted(once)
        assert len(mine) < 30 or len({s for _, s in mine[: len(mine) // 3]}) == 3


def test_first_position(spark):
    rows = [(i, "a b c d e f g", "en", "ab"[i % 2]) for i in range(40)]
    got = mixing.mix(frame(spark, rows), block_words=7).collect()
    assert all((r.first_position is None) == (r.taken == 0) for r in got)
    firsts = sorted((r.first_position, r.source) for r in got if r.taken)
    assert len({p for p, _ in firsts}) == len(firsts)
    assert len(Counter(s for _, s in firsts[:6])) == 2


def test_alike_rows_of_which_a_part_is_taken(spark):
    rows = [(1, "a b c d", "en", "s")] * 5 + [(2, "e f g h", "en", "s"), (3, "i j k l", "en", "t")]
    # source s has 24 words and t has 4; equal weights, t stops at twice its size
    out = Counter(r.doc_id for r in mixing.mixed_documents(frame(spark, rows), (1,), (1, 1)).collect())
    assert out[3] == 2 and out[1] + out[2] == 5
    out = Counter(r.doc_id for r in mixing.mixed_documents(frame(spark, rows), (1,), (1, 2)).collect())
    assert out[3] == 2 and out[1] + out[2] == 2


def test_equal_texts_share_shards(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["one text", "another text " * 9, f"own {i}"]), rng.choice(["en", "de", None]), f"https://site.example/{rng.randrange(9)}") for i in range(400)]
    out = hilbert.shard(frame(spark, rows)).collect()
    ranks = defaultdict(list)
    for rank, r in enumerate(sorted(out, key=lambda r: (r.shard, r.slot))):
        ranks[r.text_crc32, r["size"]].append(rank)
    assert all(v == list(range(v[0], v[0] + len(v))) for v in map(sorted, ranks.values()))


def test_whole_values_make_the_steps(spark):
    """Values that begin alike fall into different steps."""
    rows = [(i, "text", "en", f"https://site.example/{i:03d}") for i in range(160)]
    steps = {r.value: r.step for r in hilbert.value_steps(frame(spark, rows), "source").collect()}
    assert [steps[f"https://site.example/{i:03d}"] for i in range(160)] == [i // 10 for i in range(160)]
    for n in (1, 95, 96, 127, 128, 191, 192, 10_000, 12_287, 12_288, 1 << 20):
        half = 2 * n.bit_length() + (n >> max(0, n.bit_length() - 2) & 1 if n > 1 else 0) - 14
        assert spark.range(1).select(hilbert.size_step(F.lit(n).cast("long"))).head()[0] == min(15, max(0, half))


@pytest.mark.parametrize("seed", range(3))
def test_line_rule_equals_sql_on_copies(spark, tmp_path, seed):
    """Tables full of copies, short bodies and shared passages: the sketches find what the exact SQL finds."""
    from loomspark.llm import queries
    from tests.oracle import compare

    rng = random.Random(seed)
    line = lambda name: " ".join(f"{name}w{k}" for k in range(rng.choice([3, 5, 12])))
    shared, bodies = [line(f"shared{i}") for i in range(8)], [[line(f"body{i}x{j}") for j in range(rng.randrange(1, 6))] for i in range(40)]
    rows = []
    for i in range(400):
        lines = list(rng.choice(bodies)) if rng.random() < 0.5 else [line(f"own{i}x{j}") for j in range(rng.randrange(0, 4))]
        lines += rng.sample(shared, rng.randrange(0, 4))
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines) if i % 50 else None, "en", f"s{rng.randrange(9)}" if rng.random() < 0.95 else None))
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    assert compare(spark, str(tmp_path), queries.QUERIES["op10_line_spread"], queries.ORACLES["op10_line_spread"]) == 400


def test_scratch_is_deleted(spark, sf):
    import os

    from loomspark.llm import _common

    folder = _common.shared_dir(spark).removeprefix("file://")
    names = lambda: set(os.listdir(folder)) if os.path.isdir(folder) else set()
    before = names()
    n = corpus_pipeline.run(spark, sf).count()
    left = {name.split("-")[0] for name in names() - before}
    assert n and left == {"pipeline"} and len(names() - before) == 1


def test_ids_equal_those_of_tokenizers():
    from tokenizers import Tokenizer

    rng = random.Random(9)
    plain = Tokenizer.from_file(packing.default_vocabulary())
    spans = [(32, 126), (32, 126), (9, 13), (160, 0x24F), (0x300, 0x36F), (0x400, 0x4FF), (0x600, 0x6FF), (0x900, 0x97F), (0x2000, 0x206F), (0x3040, 0x30FF), (0x4E00, 0x9FFF), (0xAC00, 0xD7A3), (0x1F300, 0x1FAFF), (0, 0xD7FF), (0xE000, 0x10FFFF)]
    texts = ["".join(chr(rng.randint(*rng.choice(spans))) for _ in range(rng.randrange(1, 60))) for _ in range(4000)]
    texts += ["".join(rng.choice([" ", "  ", "\n", "\r\n", "\t", "'s", "'LL", "1", "12345", "word", "Été", "\xa0", "　", "!?", "<|endoftext|>"]) for _ in range(rng.randrange(1, 30))) for _ in range(4000)]
    assert packing.encoder(packing.default_vocabulary())(texts) == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("seed", range(4))
def test_unbounded_search_is_exact(seed):
    rng = random.Random(seed)
    items = [rng.randrange(3, 28) for _ in range(10)]
    assert sum(n for _, n in packing.complete(dict(Counter(items)), 30, None, None)) == exact_bins(items, 30)


def test_gap_to_the_bound_on_planted_histograms():
    """Sequences cut at random points can be packed without waste: what the bounded search needs beyond that."""
    rng = random.Random(0)
    for n in (20, 200):
        items = []
        for _ in range(n):
            cuts = sorted(rng.sample(range(1, 2048), 3))
            items += [b - a for a, b in zip([0, *cuts], [*cuts, 2048])]
        assert sum(k for _, k in packing.complete(dict(Counter(items)), 2048)) <= n + max(1, n // 50)


def test_every_language_is_learned(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE", 64)
    monkeypatch.setattr(langid, "EPOCHS", 1)
    rows = [(i, f"word{i % 40} " * 5, f"l{i % 40:02d}", "a") for i in range(400)]
    net = langid.learn(frame(spark, rows))
    assert len(net.labels) == 40


def test_pooled_probabilities_by_hand():
    """One byte after the other, in plain Python."""
    from math import exp, tanh

    net = langid.Network(["a", "b", "c"], hidden=3)
    text = "héllo wörld, " * 11
    k, p = 3, net.p
    sigmoid = lambda v: 1 / (1 + exp(-v))
    total, raw = [0.0] * 3, text.encode()
    for start in range(0, len(raw), langid.STEPS):
        window = list(raw[start : start + langid.STEPS])
        window += [langid.PAD] * (langid.STEPS - len(window))
        states = {}
        for d, order in (("f", range(len(window))), ("b", reversed(range(len(window))))):
            h = [0.0] * k
            for t in order:
                g = p[f"inputs_{d}"][window[t]]
                gate = [sigmoid(g[j] + sum(h[i] * p[f"gates_{d}"][i][j] for i in range(k))) for j in range(2 * k)]
                q = [sum(h[i] * p[f"state_{d}"][i][j] for i in range(k)) + p[f"bias_{d}"][j] for j in range(k)]
                new = [tanh(g[2 * k + j] + gate[k + j] * q[j]) for j in range(k)]
                h = [new[j] + gate[j] * (h[j] - new[j]) for j in range(k)]
                states[d, t] = h
        for t, byte in enumerate(window):
            if byte != langid.PAD:
                both = states["f", t] + states["b", t]
                y = [sum(both[i] * p["out"][i][j] for i in range(2 * k)) + p["out_bias"][j] for j in range(3)]
                z = sum(map(exp, y))
                total = [s + exp(v) / z for s, v in zip(total, y)]
    got, _ = langid.pooled(net, [text.encode()])
    assert np.allclose(got[0], np.array(total) / len(raw))
