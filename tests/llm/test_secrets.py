"""Secret spans and verdicts against brute force: many matches in a text, ownership, overlaps."""

import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import pytest

llm = pytest.importorskip("loomspark.llm")
from loomspark.llm import secrets  # noqa: E402
from tests.llm.test_native_and_packing import frame, secret_brute  # noqa: E402

KINDS = {"assign": r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{12,})(?![A-Za-z0-9+/_.=-])""", "access": r"AKIA[A-Z0-9]{14,}", "hex": r"[0-9a-f]{16,}", "token": r"[A-Za-z0-9+/_=-]{24,}"}


def verdicts(rows):
    """doc_id, spans, n_live, n_example of each row, by definition (no short assignments in the texts)."""
    found, owners, repos = [], defaultdict(set), defaultdict(set)
    for i, t, _, source in rows:
        mine = []
        for order, (kind, pattern) in enumerate(KINDS.items()):
            for m in re.finditer(pattern, t or "", re.I if order == 0 else 0):
                value = m[1] if order == 0 else m[0]
                if order < 3 or all(re.search(p, value) for p in ("[0-9]", "[a-z]", "[A-Z]")):
                    mine.append((m.start(), order, m.end(), kind, value))
                    owners[value].add(source)
                    repos[value].add(i)
        found.append(mine)
    for (i, *_), mine in zip(rows, found):
        example = lambda v: len(owners[v]) >= 3 or (len(owners[v]) > 1 and len(repos[v]) >= 16)
        live = lambda v: not example(v) and len(set(v)) >= 8
        shown = [x for x in mine if x[1] < 3 or (live(x[4]) and not any(y[1] < 3 and y[0] < x[2] and x[0] < y[2] for y in mine))]
        yield i, ",".join(f"{k}:{s}:{e}" for s, _, e, k, _ in sorted(shown)), sum(live(x[4]) for x in shown), sum(example(x[4]) for x in shown)


def test_ownership(spark):
    rng = random.Random(4)
    draw = lambda n: "".join(rng.choice("aB3dE5fG7hJ9kL1mN3pQ5rS7xYz") for _ in range(n))
    pool = [f"Zx9{draw(24)}" for _ in range(12)] + [f"token={draw(14)}" for _ in range(8)] + ["AKIA" + "B2" * 8, "0123456789abcdef" * 2, "password: " + "Q7zK" * 5, "a1B" * 10, "secret=" + "Zz9" * 10]
    rows = [(i, " é ".join(rng.choice(pool) for _ in range(rng.randrange(0, 7))), "en", f"s{i % 4 if i % 3 else 0}") for i in range(60)]
    rows += [(100 + i, "Two Wn4" + "kL1mN3pQ5rS7xYzaB3dE5fG" + " owners", "en", f"t{i % 2}") for i in range(20)] + [(None, pool[0], None, None), rows[3], rows[3]]
    got = Counter((r.doc_id, r.spans, r.n_live, r.n_example) for r in secrets.scan(frame(spark, rows)).collect())
    assert got == Counter(verdicts(rows))
    assert any(x[2] for x in got) and any(x[3] for x in got)


def test_text_of_many_matches(spark):
    """Rows in proportion to the matches: a checksum list doesn't blow up."""
    n = 30_000
    text = " ".join(f"{i:020x}" for i in range(n)) + " " + " ".join(f"token=abcdefghijk{i:08d} Zx9aB3dE5fG7hJ9kL1mN3pQ5r{i:06d}" for i in range(n // 2))
    rows = [(1, text, "en", "a"), (2, text, "en", "b"), (3, "x", "en", "a")]
    began = time.time()
    got = secrets.scan(frame(spark, rows)).collect()
    assert time.time() - began < 60
    want = {i: (hashlib.sha256(b.encode()).hexdigest(), c["assign"], c["hex"]) for i, b, c in secret_brute(rows)}
    assert {r.doc_id: (r.base_sha256, r.n_assign, r.n_hex) for r in got} == want
    assert all(r.n_live == 2 * (n // 2) for r in got if r.doc_id < 3)  # assignments and tokens
