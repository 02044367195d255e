"""Best-fit packing of documents into sequences by bin completion.

Documents are tokenised and cut to pieces; only the histogram of piece lengths (as many numbers as a
sequence has tokens) is packed, on the driver. Around the largest remaining piece the undominated fillings
are enumerated, and a fill pattern is repeated as often as the counts allow. Best-fit decreasing gives the first
incumbent; branches that waste more than the incumbent are pruned. Pieces then find their place by their
rank within their length, so the plan's size doesn't grow with the input.

Nulls: a null text is empty; an empty text is the end token alone. Rows that are alike are packed each. An
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import running_total, small_batches, stage

CAPACITY, END = 2048, 0
#: Bounds of the search on the driver; they bound its time, and never drop a piece. None: no bound, the search is exact.
FILLINGS, NODES = 24, 3000
PROBE = ["It's  1 probe,\n\n with été — and\ttabs 123\x00!", "", "<|endoftext|>", "日本語 кириллица \U0001f600\u200d", "  \r\n \xa0 x1y22zzz 'S'Ll", "a" * 300]

_encoders: dict[str, object] = {}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoder(vocabulary: str):
    """A function from texts to lists of ids for a byte-level BPE in the tokenizers format.

    tiktoken runs the same merges several times faster; texts with the special string, and all texts where tiktoken
    isn't installed or the file is no plain byte-level BPE, go to the tokenizers library itself. A probe of texts
    of all kinds must give the same ids, else this raises.
    """
    if vocabulary in _encoders:
        return _encoders[vocabulary]
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(vocabulary)
    slow = lambda texts: [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    try:
        import public_tokenizers
        import tiktoken
        from tokenizers.pre_tokenizers import ByteLevel

        visible = sorted(ByteLevel.alphabet())
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]  # bytes that stand for themselves
        table = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
        if sorted(table) != visible:
            raise KeyError("another alphabet of bytes")
        special = {t.content for t in plain.get_added_tokens_decoder().values()}
        ranks = {bytes(table[c] for c in token): i for token, i in plain.get_vocab().items() if token not in special}
        fast = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        def encode(texts: list[str]) -> list[list[int]]:
            return [slow([x])[0] if any(s in x for s in special) else fast.encode_ordinary(x) for x in texts]

    except (ImportError, KeyError):  # a token that isn't made of byte characters: no plain byte-level BPE
        encode = slow
    if encode(PROBE) != slow(PROBE):
        raise RuntimeError(f"tiktoken and tokenizers differ on {vocabulary}")
    _encoders[vocabulary] = encode
    return _encoders[vocabulary]


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: whole pieces after a first one that may be shorter."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 for each piece of each row of docs(doc_id, text)."""
    vocabulary = vocabulary or default_vocabulary()
    kind = docs.schema["doc_id"].dataType.simpleString()
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            for doc, ids in zip(batch.column(0).to_pylist(), encode([x or "" for x in batch.column(1).to_pylist()]), strict=True):
                array = np.asarray([*ids, END], dtype="<u4")
                for i, (start, length) in enumerate(cut(len(array), capacity)):
                    for column, value in zip(rows, (doc, i, start, length, zlib.crc32(array[start : start + length].tobytes())), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], batch.schema.field(0).type), pa.array(rows[1], pa.int32()), *(pa.array(c, pa.int64()) for c in rows[2:])], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


# ---- the plan: on a histogram of lengths only


def _fits(lengths: list[int], left: dict[int, int], room: int) -> Iterator[tuple[int, ...]]:
    """Maximal fillings of the room, larger pieces first."""

    def walk(room: int, top: int, chosen: tuple[int, ...]) -> Iterator[tuple[int, ...]]:
        i, any_fits = bisect.bisect_right(lengths, min(room, top)) - 1, False
        while i >= 0:
            x = lengths[i]
            if left[x] > chosen.count(x):
                any_fits = True
                yield from walk(room - x, x, (*chosen, x))
            i -= 1
        if not any_fits:
            yield chosen

    return walk(room, room, ())


def _dominated(filling: tuple[int, ...], lengths: list[int], left: dict[int, int], room: int) -> bool:
    """Whether one unused piece could take the place of some of the filling's pieces and fill more."""
    slack, sums = room - sum(filling), {0}
    for x in filling:
        sums |= {s + x for s in sums}
    for s in sums - {0}:
        i = bisect.bisect_right(lengths, s)
        if i < len(lengths) and lengths[i] <= s + slack and left[lengths[i]] > filling.count(lengths[i]):
            return True
    return False


def fillings(lengths: list[int], left: dict[int, int], room: int, most: int | None = FILLINGS) -> list[tuple[int, ...]]:
    """Undominated fillings, fullest first. One piece that fills the room dominates all others."""
    if left.get(room):
        return [(room,)]
    for x in lengths[: bisect.bisect_right(lengths, room // 2)]:  # two that fill it are dominated by one only
        if left.get(room - x, 0) > (room - x == x):
            return [(room - x, x)]
    found: list[tuple[int, ...]] = []
    for tried, filling in enumerate(_fits(lengths, left, room)):
        if not _dominated(filling, lengths, left, room):
            found.append(filling)
            if sum(filling) == room:
                break
        if most is not None and (len(found) >= most or tried >= 40 * most):
            break
    return sorted(found, key=lambda f: (-sum(f), len(f), f)) or [()]


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on the histogram: patterns and how often each is used."""
    rooms: list[int] = []
    bins: dict[int, list[list]] = {}

    def put(room: int, pattern: tuple[int, ...], n: int) -> None:
        if room not in bins:
            bins[room] = []
            bisect.insort(rooms, room)
        bins[room].append([pattern, n])

    for x in sorted(counts, reverse=True):
        n = counts[x]
        while n:
            i = bisect.bisect_left(rooms, x)
            if i == len(rooms):
                each = capacity // x
                if n >= each:
                    put(capacity - each * x, (x,) * each, n // each)
                    n %= each
                else:
                    put(capacity - n * x, (x,) * n, 1)
                    n = 0
                continue
            room = rooms[i]
            pattern, k = bins[room].pop()
            use = min(n, k)
            if k > use:
                bins[room].append([pattern, k - use])
            if not bins[room]:
                del bins[room]
                rooms.pop(i)
            put(room - x, (*pattern, x), use)
            n -= use
    return [(p, n) for groups in bins.values() for p, n in groups]


def complete(counts: dict[int, int], capacity: int = CAPACITY, nodes: int | None = NODES, most: int | None = FILLINGS) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (pieces that share a sequence) and their multiplicities, as few sequences as it finds.

    Depth first: the largest piece is completed by each undominated filling in turn. A branch ends when its
    waste reaches what the best solution so far may waste. The search stops at the lower bound or after
    `nodes` branchings beyond the first dive; the best solution found stands. With nodes and most None the search is
    exact for plans that use a pattern as often as its counts allow.
    """
    total = sum(x * n for x, n in counts.items())
    bound, best = -(-total // capacity), best_fit(counts, capacity)
    size = lambda plan: sum(n for _, n in plan)
    if not counts or size(best) == bound:
        return best
    left, lengths = dict(counts), sorted(counts)
    path: list[tuple[tuple[int, ...], int, Iterator]] = []
    waste, used, visited = 0, 0, 0

    def options() -> Iterator[tuple[int, ...]]:
        top = lengths[-1]
        left[top] -= 1
        found = fillings(lengths, left, capacity - top, most)
        left[top] += 1
        return iter([(top, *f) for f in found])

    def change(pattern: tuple[int, ...], n: int) -> None:
        for x in set(pattern):
            had = left[x]
            left[x] += n * pattern.count(x)
            if not left[x]:
                lengths.pop(bisect.bisect_left(lengths, x))
            elif not had:
                bisect.insort(lengths, x)

    choices, dive = options(), True
    while True:
        pattern = next(choices, None)
        spent_all = nodes is not None and visited > nodes
        if pattern is None or spent_all:
            if not path or spent_all:
                return best
            pattern, n, choices = path.pop()
            change(pattern, n)
            waste, used, dive = waste - n * (capacity - sum(pattern)), used - n, False
            continue
        visited += not dive
        n = min(left[x] // pattern.count(x) for x in set(pattern))
        spent = waste + n * (capacity - sum(pattern))
        if spent > (size(best) - 1) * capacity - total:
            continue
        change(pattern, -n)
        path.append((pattern, n, choices))
        waste, used = spent, used + n
        if not lengths:
            best = [(p, k) for p, k, _ in path]
            if used == bound:
                return best
            choices = iter(())
        else:
            choices = options()


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, nodes: int | None = NODES, most: int | None = FILLINGS) -> DataFrame:
    """The pieces with sequence_id and offset. No sequence is longer than capacity and none has gaps.

    nodes and most bound the search (see complete); where best-fit decreasing meets the lower bound there is none.
    """
    cuts = stage(pieces(docs, vocabulary, capacity), "pieces")
    counts = {r["length"]: r["n"] for r in cuts.groupBy("length").agg(F.count("*").alias("n")).collect()}  # one row for each length, capacity at most
    plan = [((capacity,), counts[capacity])] if capacity in counts else []
    plan += complete({x: n for x, n in counts.items() if x != capacity}, capacity, nodes, most)
    places: list[tuple[int, int, int, int, int]] = []  # length, first rank, first sequence, pieces in a sequence, offset
    taken, sequence = dict.fromkeys(counts, 0), 0
    for pattern, n in plan:
        at = 0
        for x in dict.fromkeys(pattern):
            k = pattern.count(x)
            places.append((x, taken[x], sequence, k, at))
            taken[x] += n * k
            at += k * x
        sequence += n
    table = np.array(sorted(places), dtype=np.int64).reshape(-1, 5)
    keys = table[:, 0] << 48 | table[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            row = table[np.searchsorted(keys, length << 48 | rank, side="right") - 1]
            within = rank - row[:, 1]
            ids, offsets = row[:, 2] + within // row[:, 3], row[:, 4] + within % row[:, 3] * length
            columns = [batch.column(i) for i, c in enumerate(batch.schema.names) if c != "rank"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(ids), pa.array(offsets)], [*(c for c in batch.schema.names if c != "rank"), "sequence_id", "offset"])

    ranked = running_total(cuts, ["length"], [F.col("doc_id").asc_nulls_first(), F.col("piece"), F.col("ids_crc32")], "rank", max(sum(counts.values()), 1), None, F.xxhash64("doc_id", "piece", "ids_crc32"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return ranked.select(*names, "rank").mapInArrow(place, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
