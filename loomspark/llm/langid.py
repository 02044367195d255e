"""Language identification by a bidirectional gated recurrent network over bytes, trained in numpy.

Each direction is a GRU over the text's UTF-8 bytes; both states at a byte give its label's probabilities.
The network is trained by backpropagation through time on windows of a bounded, hash-drawn sample of
labelled texts. To predict, a whole text is cut into windows of STEPS bytes that run side by side, each from an empty
state in both directions; every byte is labelled, and the document's probabilities are the mean over its bytes.

Nulls: a null text, or one without a letter, is `und` with score 0. Null languages are not learned from. If no
label is known, all texts are `und`. Rows that are alike get the same label. An empty table gives no rows; other
columns are not read. Very long texts are labelled whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ._common import small_batches

#: The sample: excerpts of EXCERPT characters, at most SLOTS * PER_SLOT of a language and about SAMPLE of all. The more
#: languages there are, the fewer of each, but every language has some of each slot that has any.
SLOTS, PER_SLOT, EXCERPT, SAMPLE = 32, 8, 512, 65_536
HIDDEN, STEPS, EPOCHS, BATCH, RATE = 8, 64, 10, 128, 0.02
#: Windows that run side by side for up to 16 languages; with more, fewer windows, as their table of probabilities is bounded.
SIDE = 4096
PAD = 256


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Parameters of both directions and the output layer. The embedding of a byte is its row of `inputs`."""

    def __init__(self, labels: list[str], hidden: int = HIDDEN, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.labels, self.hidden = labels, hidden
        scale = 1 / np.sqrt(hidden)
        self.p = {}
        for d in "fb":
            self.p[f"inputs_{d}"] = rng.normal(0, 0.3, (257, 3 * hidden))
            self.p[f"gates_{d}"] = rng.normal(0, scale, (hidden, 2 * hidden))
            self.p[f"state_{d}"] = rng.normal(0, scale, (hidden, hidden))
            self.p[f"bias_{d}"] = np.zeros(hidden)
        self.p["out"] = rng.normal(0, scale, (2 * hidden, len(labels)))
        self.p["out_bias"] = np.zeros(len(labels))

    def _run(self, x: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """States after each byte of x (steps, rows); keep gets what backpropagation needs."""
        k, p = self.hidden, self.p
        h = np.zeros((x.shape[1], k), p["out"].dtype)
        out = np.empty((*x.shape, k), h.dtype)
        for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
            g = p[f"inputs_{d}"][x[t]]
            gates = _sigmoid(g[:, : 2 * k] + h @ p[f"gates_{d}"])
            z, r = gates[:, :k], gates[:, k:]
            q = h @ p[f"state_{d}"] + p[f"bias_{d}"]
            n = np.tanh(g[:, 2 * k :] + r * q)
            if keep is not None:
                keep.append((t, h, z, r, q, n))
            h = n + z * (h - n)
            out[t] = h
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Of each label at each byte: (steps, rows, labels)."""
        k, p = self.hidden, self.p
        y = self._run(x, "f") @ p["out"][:k] + self._run(x, "b") @ p["out"][k:] + p["out_bias"]
        y -= y.max(axis=-1, keepdims=True)
        np.exp(y, out=y)
        y /= y.sum(axis=-1, keepdims=True)
        return y

    def gradients(self, x: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over the bytes that are not padding, and its gradients."""
        k, p = self.hidden, self.p
        kept = {"f": [], "b": []}
        states = {d: self._run(x, d, kept[d]) for d in "fb"}
        both = np.concatenate([states["f"], states["b"]], axis=-1)
        y = both @ p["out"] + p["out_bias"]
        y -= y.max(axis=-1, keepdims=True)
        np.exp(y, out=y)
        y /= y.sum(axis=-1, keepdims=True)
        real = x != PAD
        n = max(1, real.sum())
        rows = np.arange(x.shape[1])
        loss = -(np.log(y[:, rows, label] + 1e-12) * real).sum() / n
        y[:, rows, label] -= 1
        y *= real[..., None] / n
        grad = {"out": np.einsum("tbi,tbj->ij", both, y), "out_bias": y.sum((0, 1))}
        up = y @ p["out"].T
        for d in "fb":
            g = {name: np.zeros_like(p[f"{name}_{d}"]) for name in ("inputs", "gates", "state", "bias")}
            dh = np.zeros((x.shape[1], k))
            for t, h, z, r, q, c in reversed(kept[d]):
                dh = dh + up[t, :, :k] if d == "f" else dh + up[t, :, k:]
                dn = dh * (1 - z) * (1 - c * c)
                dz = dh * (h - c) * z * (1 - z)
                dr = dn * q * r * (1 - r)
                dq = dn * r
                dgates = np.concatenate([dz, dr], axis=1)
                np.add.at(g["inputs"], x[t], np.concatenate([dgates, dn], axis=1))
                g["gates"] += h.T @ dgates
                g["state"] += h.T @ dq
                g["bias"] += dq.sum(0)
                dh = dh * z + dgates @ p[f"gates_{d}"].T + dq @ p[f"state_{d}"].T
            grad |= {f"{name}_{d}": v for name, v in g.items()}
        return float(loss), grad

    def train(self, windows: np.ndarray, label: np.ndarray, epochs: int = EPOCHS, batch: int = BATCH, rate: float = RATE, seed: int = 5) -> list[float]:
        """Adam with a falling rate and clipped gradients; windows is (rows, steps)."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        losses, step, total = [], 0, epochs * -(-len(windows) // batch)
        for _ in range(epochs):
            order = rng.permutation(len(windows))
            for i in range(0, len(order), batch):
                pick = order[i : i + batch]
                loss, grad = self.gradients(windows[pick].T, label[pick])
                losses.append(loss)
                norm = np.sqrt(sum((g * g).sum() for g in grad.values()))
                step += 1
                for k, g in grad.items():
                    g = g * min(1.0, 1.0 / (norm + 1e-9))
                    m[k] = 0.9 * m[k] + 0.1 * g
                    s[k] = 0.99 * s[k] + 0.01 * g * g
                    self.p[k] -= rate * (1 - step / (total + 1)) * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.99**step)) + 1e-8)
        return losses

    def single(self) -> Network:
        """The same in single precision, for prediction."""
        self.p = {k: np.ascontiguousarray(v, dtype=np.float32) for k, v in self.p.items()}
        return self


def windows_of(raw: bytes, steps: int = STEPS) -> np.ndarray:
    """The bytes in rows of `steps`, the last one padded."""
    x = np.frombuffer(raw, np.uint8).astype(np.int16)
    out = np.full(-(-len(x) // steps) * steps, PAD, np.int16)
    out[: len(x)] = x
    return out.reshape(-1, steps)


def held_out(doc_id) -> F.Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def learn(docs: DataFrame) -> Network | None:
    """Train on a bounded sample: of each language the texts with the least hashes in each of SLOTS slots."""
    usable = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & (F.length("text") > 0))
    n_languages = max(1, usable.select("lang").distinct().count())
    slots = max(1, min(SLOTS, SAMPLE // n_languages))
    per_slot = max(1, min(PER_SLOT, SAMPLE // (slots * n_languages)))
    h = F.xxhash64("doc_id", "text")
    first = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.greatest(F.length("text") - EXCERPT, F.lit(1))).cast("int") + 1
    slim = usable.select("lang", F.pmod(h, F.lit(slots)).alias("slot"), h.alias("h"), F.substring(F.col("text"), first, F.lit(EXCERPT)).alias("excerpt"))
    ranked = slim.withColumn("k", F.row_number().over(Window.partitionBy("lang", "slot").orderBy("h", "excerpt"))).where(F.col("k") <= per_slot)
    rows = sorted((r.lang, r.h, r.excerpt) for r in ranked.select("lang", "h", "excerpt").collect())
    labels = sorted({r[0] for r in rows})
    if not labels:
        return None
    x, y = [], []
    for lang, _, excerpt in rows:
        w = windows_of(excerpt.encode())
        x.append(w)
        y += [labels.index(lang)] * len(w)
    net = Network(labels)
    if len(labels) > 1:
        net.train(np.concatenate(x), np.array(y))
    return net.single()


def pooled(net: Network, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Mean probabilities of each text's bytes, and how many bytes each label got: (texts, labels)."""
    parts = [windows_of(t) for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(w) for w in parts])
    total, votes = np.zeros((2, len(texts), len(net.labels)))
    x = np.concatenate(parts) if parts else np.empty((0, STEPS), np.int16)
    side = max(16, SIDE * 16 // max(16, len(net.labels)))
    for i in range(0, len(x), side):
        w = x[i : i + side].T
        p = net.probabilities(w)
        real = w != PAD
        p *= real[..., None]
        top = p == p.max(axis=-1, keepdims=True)
        top &= real[..., None]
        np.add.at(total, owner[i : i + side], p.sum(axis=0))
        np.add.at(votes, owner[i : i + side], top.sum(axis=0))
    return total / np.maximum(1, np.array([len(t) for t in texts]))[:, None], votes


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, n_bytes and n_agree (bytes labelled as the document) for each row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lettered = batch.column(3).to_pylist()
            texts = [(t or "").encode() if has else b"" for t, has in zip(batch.column(2).to_pylist(), lettered, strict=True)]
            lang, score, agree = ["und"] * len(texts), [0.0] * len(texts), [0] * len(texts)
            if net is not None:
                p, votes = pooled(net, texts)
                for i in range(len(texts)):
                    if texts[i]:
                        k = int(p[i].argmax())
                        lang[i], score[i], agree[i] = net.labels[k], min(1.0, max(0.0, float(p[i, k]))), int(votes[i, k])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(map(len, texts), pa.int64()), pa.array(agree, pa.int64())], ["doc_id", "held_out", "lang_pred", "score", "n_bytes", "n_agree"])

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered"))
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, n_bytes bigint, n_agree bigint")


def identify(docs: DataFrame) -> DataFrame:
    return predict(docs, learn(docs))
