"""Mixing, sharding, secrets, line dedup and packing against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

llm = pytest.importorskip("loomspark.llm")
from loomspark.llm import hilbert, linededup, mixing, packing, secrets  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _b int, rank string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, len(t or ""), 1, "x") for i, t, lang, s in rows], SCHEMA)


def odd_rows():
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "été", "x"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 60))), "en", f"s{i % 3 if i % 2 else 0}") for i in range(60)]
    return [*rows, (None, "no id here", None, None), (7, None, "de", "s1"), (8, "", None, None), (9, " \t\n", "fr", ""), (3, rows[3][1], "en", rows[3][3]), (3, rows[3][1], "en", rows[3][3]), (70, "long " * 40000, "en", "s0")]


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def test_mixing(spark):
    rows = odd_rows()
    a = mixing.mix(frame(spark, rows), block_words=16).collect()
    b = mixing.mix(frame(spark, rows).repartition(5), block_words=16).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))
    assert Counter((r.doc_id, r["size"]) for r in a) == Counter((i, len(words(t))) for i, t, _, _ in rows)
    per = defaultdict(int)
    for _, t, _, s in rows:
        per[s] += len(words(t))
    order = sorted([s for s in per if s is not None]) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, open_ = {}, set(per)
    while True:  # share, cut, share the excess again
        rest = 1.5 * sum(per.values()) - sum(target.values())
        level = rest / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * per[s]}
        if not over:
            break
        target |= {s: 2.0 * per[s] for s in over}
        open_ -= over
    target |= {s: level * weight[s] for s in open_}
    taken = defaultdict(int)
    for r in a:
        assert 0 <= r.taken <= 2 * r["size"] and r.source_size == per[r.source]
        assert r.target == pytest.approx(target[r.source])
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) < 1.001 for s in per)


def test_mixing_blocks_equal_prefix(spark):
    """What the slots take is the source's stream from its start, repeated."""
    rows = [r for r in odd_rows() if r[3] == "s0"]
    for block in (7, 64, 100000):
        got = Counter({(r.doc_id, r["size"], r.taken): 1 for r in mixing.mix(frame(spark, rows), block_words=block).collect()})
        assert got == Counter({(r.doc_id, r["size"], r.taken): 1 for r in mixing.mix(frame(spark, rows), block_words=33).collect()})


def test_schedule_is_low_discrepancy(spark):
    sizes = spark.createDataFrame([("a", 3000), ("b", 1000), ("c", 2000)], "source string, size long")
    slots = mixing.schedule(mixing.source_targets(sizes, (1, 1, 1), (1, 1)), 10).orderBy("position").collect()
    share, seen = Counter(s.source for s in slots), Counter()
    for k, s in enumerate(slots, 1):
        seen[s.source] += 1
        for name, n in share.items():
            assert abs(seen[name] - k * n / len(slots)) < 10
    for name in share:
        mine = [(s.epoch, s.block) for s in slots if s.source == name]
        assert mine == sorted(mine)


def test_mixing_empty(spark):
    assert mixing.mix(frame(spark, [])).collect() == []
    assert [r.taken for r in mixing.mix(frame(spark, [(1, None, None, "a")])).collect()] == [0]


def test_hilbert_curve(spark):
    cells = [r.cell for r in hilbert.curve(spark).orderBy("curve_index").collect()]
    assert sorted(cells) == list(range(4096))
    at = [(c // 256, c // 16 % 16, c % 16) for c in cells]
    assert all(sum(abs(x - y) for x, y in zip(a, b)) == 1 for a, b in zip(at, at[1:]))


@pytest.mark.parametrize("n", [0, 1, 5, 67])
def test_shards(spark, n):
    rows = odd_rows()[:n] if n < 67 else odd_rows()
    out = hilbert.shard(frame(spark, rows)).collect()
    crc = lambda t: zlib.crc32((t or "").encode())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in out) == Counter((i, len((t or "").encode()) + 1, crc(t)) for i, t, _, _ in rows)
    by = defaultdict(list)
    for r in out:
        assert r.law == "rows" and 0 <= r.shard < 8 and r.grown_shard is None
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    if rows:
        assert max(map(len, by.values())) - min(len(by.get(k, [])) for k in range(8)) <= 1
    runs = sorted((min(r.curve_index for r in out if r.shard == k), max(r.curve_index for r in out if r.shard == k)) for k in by)
    assert all(a[1] <= b[0] for a, b in zip(runs, runs[1:]))


def secret_brute(rows):
    base = [("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""".replace("(password", "((?i:password").replace("key)", "key))")), 2, 12), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18), ("hex", re.compile("[0-9a-f]+"), 0, 16)]
    for i, t, _, _ in rows:
        found = [(m.start(), k, name, m.end()) for k, (name, p, g, least) in enumerate(base) for m in p.finditer(t or "") if len(m[g]) >= least]
        yield i, ",".join(f"{n}:{s}:{e}" for s, _, n, e in sorted(found)), Counter(x[2] for x in found)


def test_secrets(spark):
    hexes = "0123456789abcdef0123"
    live = "Zx9" + "aB3dE5fG7hJ9kL1mN3pQ5rS7"
    rows = [
        (1, f'é Token = "{hexes}" and PASSWORD: abcdefghijkl. AKIA{"A1" * 8} end', "en", "a"),
        (2, "token: password: abcdefghijklmno secret=short api_key=ABCDEFGHIJKLMNOP", "en", "b"),
        (3, f"see {live} here \U0001f600 {hexes}", "en", "a"),
        (4, None, None, None), (5, "", "en", None), (1, f'é Token = "{hexes}" and PASSWORD: abcdefghijkl. AKIA{"A1" * 8} end', "en", "a"),
        (None, f"x {hexes}", "en", None), (6, ("password=" + hexes + " ") * 50, "en", "c"), (7, "apikey='AKIA" + "B" * 14 + "'", "en", "d"),
        (8, "\U0001f600 é " + " ".join(f"{i:020x} token={i:015d}" for i in range(1, 300)), "en", "e"),
        *[(100 + i, "example Qw3" + "aB3dE5fG7hJ9kL1mN3pQ5rS7" + " copied", "en", f"o{i}") for i in range(4)],
    ]
    got = secrets.scan(frame(spark, rows)).collect()
    want = Counter((i, hashlib.sha256(b.encode()).hexdigest(), n["assign"], n["access"], n["hex"]) for i, b, n in secret_brute(rows))
    assert Counter((r.doc_id, r.base_sha256, r.n_assign, r.n_access, r.n_hex) for r in got) == want
    spans = {r.doc_id: r.spans for r in got}
    assert "token:4:31" in spans[3].split(",") and all(not spans[100 + i] for i in range(4))
    assert set(next(b for i, b, _ in secret_brute(rows) if i == 2).split(",")) <= set(spans[2].split(","))


def test_secrets_on_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text, None, None) for r in docs.collect()]
    got = Counter((r.doc_id, r.base_sha256) for r in secrets.scan(docs).collect())
    assert got == Counter((i, hashlib.sha256(b.encode()).hexdigest()) for i, b, _ in secret_brute(rows))
    assert secrets.scan(docs.limit(0)).collect() == []


def drop_brute(rows, min_sites=5, min_words=4):
    texts = [(t, s) for _, t, _, s in rows if t is not None]
    lines = lambda t: {x.strip(" ") for x in t.split("\n") if len(words(x)) >= min_words}
    sites, witness = defaultdict(set), defaultdict(set)
    for t, s in texts:
        for x in lines(t):
            sites[x].add(s)
    for t, s in texts:
        if 2 * sum(len(words(x)) for x in lines(t) if len(sites[x]) > 1) <= len(words(t)):
            for x in lines(t):
                witness[x].add(s)
    return {x for x, s in witness.items() if len(s) >= min_sites}


def test_line_dedup(spark):
    rng = random.Random(3)
    unique = lambda i: f"body of document number {i} {rng.random()}"
    licence, passage, narrow = "Released under the MIT License.", "a passage of many words that sites share", "only three sites have this line"
    rows = [(i, "\n".join([unique(i), unique(i), passage if i % 2 else unique(i), unique(i), licence, "too short"]), "en", f"s{i % 7}" if i % 7 else None) for i in range(80)]
    rows += [(100 + i, f"{narrow}\n{unique(i)}", "en", f"s{i % 3}") for i in range(9)]
    copied = "the same document\ncopied to every single site\nwith its own lines kept"
    rows += [(200 + i, copied, "en", f"s{i % 7}") for i in range(30)]
    rows += [(None, None, None, None), (1, "", "en", "s1"), rows[5], (300, "long " * 30000, "en", "s2")]
    out = linededup.remove_boilerplate(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    drop = {licence, passage}
    assert drop_brute(rows) == drop
    want = Counter((i, None if t is None else "\n".join(x for x in t.split("\n") if x not in drop), s) for i, t, _, s in rows)
    assert Counter((r.doc_id, r.text, r.source) for r in out) == want
    assert all(r.n_removed == (0 if r.doc_id is None or r.doc_id >= 100 else r.n_removed) for r in out)
    assert linededup.remove_boilerplate(frame(spark, [])).collect() == []


def test_line_dedup_on_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    drop = drop_brute(rows)
    assert drop
    out = linededup.remove_boilerplate(docs).collect()
    assert Counter((r.doc_id, r.text) for r in out) == Counter((i, "\n".join(x for x in t.split("\n") if x.strip(" ") not in drop)) for i, t, _, _ in rows)


def test_line_dedup_short_and_copied_bodies(spark):
    """Site counts are over all documents: short bodies and copied ones bear witness too, copies of one body don't."""
    text = lambda name, n: " ".join(f"{name}w{k}" for k in range(n))
    passage, second, footer = text("passage", 60), text("second", 60), "All rights reserved by the network"
    shorts = [(i, f"{passage}\n{text(f'own{i}', 40)}", "en", f"s{i % 20}") for i in range(100)]
    two = [(i, f"{passage}\n{second}\n{text(f'own{i}', 40)}", "en", f"s{i % 20}") for i in range(100)]
    copied = [(2 * i + k, f"{text(f'a{i}', 30)}\n{text(f'b{i}', 30)}\n{footer}", "en", f"s{(i + k) % 20}") for i in range(50) for k in (0, 1)]
    near = [(i, "\n".join([text(f"edit{i}", 4), *(text(f"same{k}", 20) for k in range(6)), footer]), "en", f"s{i % 20}") for i in range(60)]
    for rows, drop in ((shorts, {passage}), (two, {passage, second}), (copied, {footer}), (near, set())):
        got = Counter((r.doc_id, r.text, r.n_removed) for r in linededup.remove_boilerplate(frame(spark, rows)).collect())
        assert got == Counter((i, "\n".join(x for x in t.split("\n") if x not in drop), len(drop)) for i, t, _, _ in rows)


def check_packing(out, capacity=2048):
    by = defaultdict(list)
    for r in out:
        by[r.sequence_id].append((r.offset, r.length))
    for rows in by.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_table(spark, sf):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(None, None), (1, ""), (5, "<|endoftext|> here"), (5, "<|endoftext|> here")]
    out = packing.pack(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want, total = Counter(), 0
    for i, t in rows:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        total += len(ids)
        for k, (s, n) in enumerate(packing.cut(len(ids))):
            want[i, k, s, n, zlib.crc32(ids[s : s + n].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    assert check_packing(out) <= -(-total // 2048) + 1


def test_packing_empty(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_plan(seed):
    rng = random.Random(seed)
    counts = Counter(rng.randrange(1, 60) for _ in range(rng.randrange(1, 40)))
    plan = packing.complete(dict(counts), 60)
    used = Counter()
    for p, n in plan:
        assert sum(p) <= 60
        for x in p:
            used[x] += n
    assert used == counts
    size = sum(n for _, n in plan)
    assert size <= sum(n for _, n in packing.best_fit(dict(counts), 60))
    assert size >= -(-sum(x * n for x, n in counts.items()) // 60)


def exact_bins(items, capacity):
    items = sorted(items, reverse=True)
    best = [len(items)]

    def walk(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for room in set(bins):
            if room >= items[i]:
                rest = list(bins)
                rest.remove(room)
                walk(i + 1, [*rest, room - items[i]])
        walk(i + 1, [*bins, capacity - items[i]])

    walk(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_optimal_on_small_sets(seed):
    rng = random.Random(seed)
    items = [rng.randrange(3, 28) for _ in range(9)]
    assert sum(n for _, n in packing.complete(dict(Counter(items)), 30)) == exact_bins(items, 30)


def test_running_total_hot_key(spark):
    from loomspark.llm._common import running_total

    df = spark.range(500).select(F.when(F.col("id") < 400, "hot").alias("k"), F.col("id"), (F.col("id") % 5).alias("w"))
    for weight in (None, "w"):
        out = running_total(df, ["k"], [F.col("id")], "at", 500_000, weight).collect()
        for key in ("hot", None):
            mine = sorted((r["at"], r.w if weight else 1) for r in out if r.k == key)
            at = 0
            for a, w in sorted(mine):
                assert a == at
                at += w
