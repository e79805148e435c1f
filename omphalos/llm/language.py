"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a text's UTF-8 bytes in windows, labels every position, and
the label probabilities of all positions are pooled into the document's. It is
trained here, in numpy, by backpropagation through time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from omphalos.llm.bpe import takes

#: Bytes of a window, state size of each direction, windows worked on at once.
WINDOW, HIDDEN, LANES = 64, 12, 1024
#: The bounded training sample: pieces for each language, for all, and code points of a piece.
PER_LANGUAGE, PIECES, PIECE = 400, 20_000, 256
STEPS, BATCH, RATE = 160, 256, 0.02
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")


def _states(table: np.ndarray, u: np.ndarray, codes: np.ndarray, mask: np.ndarray | None, keep: list | None = None) -> Iterator[np.ndarray]:
    """States (H, lanes) after each row of ``codes`` (steps, lanes).

    ``table`` (3H, 256) holds the input part of update, reset and candidate for
    each byte, ``u`` (3H, H) the recurrent part; the sigmoids are half tanh.
    """
    size = u.shape[1]
    h = np.zeros((size, codes.shape[1]), np.float32)
    for t in range(len(codes)):
        x = table.take(codes[t], axis=1)
        g = u @ h
        gate = x[: 2 * size]
        gate += g[: 2 * size]
        np.tanh(gate, out=gate)
        gate *= np.float32(0.5)
        gate += np.float32(0.5)
        z, r, hn = gate[:size], gate[size:], g[2 * size :]
        n = r * hn
        n += x[2 * size :]
        np.tanh(n, out=n)
        if keep is not None:
            keep.append((h, z, r, n, hn))
        new = h - n
        new *= z
        new += n
        if mask is not None:
            new *= mask[t]
        h = new
        yield h


class ByteGru:
    """Weights by name: table_f, u_f, table_b, u_b, v (labels, 2H), c (labels, 1); ``labels`` names the outputs."""

    def __init__(self, labels: list[str], weights: dict[str, np.ndarray]):
        self.labels, self.w = labels, weights

    @classmethod
    def new(cls, labels: list[str], seed: int = 1) -> ByteGru:
        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        w = {}
        for d in "fb":
            w["table_" + d] = draw(3 * HIDDEN, 256, scale=0.3)
            w["u_" + d] = draw(3 * HIDDEN, HIDDEN, scale=HIDDEN**-0.5)
        w["v"], w["c"] = draw(len(labels), 2 * HIDDEN, scale=0.1), np.zeros((len(labels), 1), np.float32)
        return cls(labels, w)

    def position_probabilities(self, codes: np.ndarray, mask: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """``(step, probabilities (labels, lanes))`` from the last position to the first; ``mask`` is 0 on padding."""
        w = self.w
        forward = list(_states(w["table_f"], w["u_f"], codes, None))
        vf, vb = w["v"][:, :HIDDEN], w["v"][:, HIDDEN:]
        for back, h in enumerate(_states(w["table_b"], w["u_b"], codes[::-1], mask[::-1])):
            t = len(codes) - 1 - back
            p = vf @ forward[t]
            p += vb @ h
            p += w["c"]
            p -= p.max(axis=0)
            np.exp(p, out=p)
            p /= p.sum(axis=0)
            yield t, p

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities (texts, labels) over all positions of each whole text; zeros for an empty one."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        windows = -(-sizes // WINDOW)
        flat = np.frombuffer(b"".join(t.ljust(int(n) * WINDOW, b"\0") for t, n in zip(texts, windows, strict=True)), np.uint8).reshape(-1, WINDOW)
        owner = np.repeat(np.arange(len(texts)), windows)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
        filled = np.minimum(sizes[owner] - nth * WINDOW, WINDOW)
        total = np.zeros((len(self.labels), len(texts)))
        for a in range(0, len(owner), LANES):
            part = np.ascontiguousarray(flat[a : a + LANES].T)
            mask = (np.arange(WINDOW)[:, None] < filled[a : a + LANES]).astype(np.float32)
            summed = np.zeros((len(self.labels), part.shape[1]), np.float32)
            for t, p in self.position_probabilities(part, mask):
                p *= mask[t]
                summed += p
            for k, row in enumerate(summed):
                total[k] += np.bincount(owner[a : a + LANES], row, len(texts))
        return (total / np.maximum(sizes, 1)).T

    def gradients(self, codes: np.ndarray, mask: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over all positions and its gradients, by backpropagation through time."""
        w, size = self.w, HIDDEN
        steps, lanes = codes.shape
        kept: dict[str, list] = {"f": [], "b": []}
        order = {"f": np.arange(steps), "b": np.arange(steps)[::-1]}
        states = {
            d: list(_states(w["table_" + d], w["u_" + d], codes[order[d]], mask[order[d]], kept[d])) for d in "fb"
        }
        grads = {k: np.zeros_like(x) for k, x in w.items()}
        into = {"f": [None] * steps, "b": [None] * steps}
        loss, weight = 0.0, np.float32(1 / mask.sum())
        for t in range(steps):
            both = np.concatenate([states["f"][t], states["b"][steps - 1 - t]])
            logits = w["v"] @ both + w["c"]
            logits -= logits.max(axis=0)
            p = np.exp(logits)
            p /= p.sum(axis=0)
            loss -= float((np.log(p[label, np.arange(lanes)] + 1e-9) * mask[t]).sum())
            p[label, np.arange(lanes)] -= 1
            p *= mask[t] * weight
            grads["v"] += p @ both.T
            grads["c"] += p.sum(axis=1, keepdims=True)
            back = w["v"].T @ p
            into["f"][t], into["b"][steps - 1 - t] = back[:size], back[size:]
        for d in "fb":
            u, dh, inputs = w["u_" + d], np.zeros((size, lanes), np.float32), []
            masks = mask[order[d]]
            for t in reversed(range(steps)):
                h, z, r, n, hn = kept[d][t]
                dh = (dh + into[d][t]) * masks[t]
                an = dh * (1 - z) * (1 - n * n)
                # the sigmoid is 0.5 + 0.5 tanh, so its slope by what stands in the tanh is 2 s (1 - s)
                az = dh * (h - n) * 2 * z * (1 - z)
                ar = an * hn * 2 * r * (1 - r)
                recurrent = np.concatenate([az, ar, an * r])
                grads["u_" + d] += recurrent @ h.T
                inputs.append(np.concatenate([az, ar, an]))
                dh = dh * z + u.T @ recurrent
            byte = codes[order[d]][::-1].reshape(-1)
            rows = np.stack(inputs).transpose(0, 2, 1).reshape(-1, 3 * size)
            sort = np.argsort(byte, kind="stable")
            at = np.flatnonzero(np.diff(byte[sort], prepend=-1))
            grads["table_" + d][:, byte[sort][at]] = np.add.reduceat(rows[sort], at, axis=0).T
        return loss * float(weight), grads


def train(pieces: list[tuple[str, str]], steps: int = STEPS, seed: int = 1) -> ByteGru | None:
    """A network fitted to ``(text, label)`` pieces by Adam on batches with as many windows of each label; None without any."""
    by_label: dict[str, list[bytes]] = {}
    for text, label in pieces:
        if text:
            by_label.setdefault(label, []).append(text.encode())
    labels = sorted(by_label)
    if not labels:
        return None
    net, rng = ByteGru.new(labels, seed), np.random.default_rng(seed)
    first, second = ({k: np.zeros_like(x) for k, x in net.w.items()} for _ in range(2))
    for step in range(1, steps + 1):
        label = rng.integers(0, len(labels), BATCH)
        codes, mask = np.zeros((BATCH, WINDOW), np.uint8), np.zeros((BATCH, WINDOW), np.float32)
        for lane, k in enumerate(label):
            own = by_label[labels[k]]
            piece = own[rng.integers(len(own))]
            at = rng.integers(max(1, len(piece) - WINDOW + 1))
            piece = piece[at : at + WINDOW]
            codes[lane, : len(piece)] = np.frombuffer(piece, np.uint8)
            mask[lane, : len(piece)] = 1
        _, grads = net.gradients(np.ascontiguousarray(codes.T), np.ascontiguousarray(mask.T), label)
        norm = float(np.sqrt(sum((g * g).sum() for g in grads.values())))
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, g in grads.items():
            g = g * np.float32(min(1.0, 1 / (norm + 1e-9)))
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            net.w[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def training_pieces(labelled: DataFrame, doc_id: str, text: str, lang: str) -> list[tuple[str, str]]:
    """At most PER_LANGUAGE pieces of each language and PIECES of all, of PIECE code points each.

    Rows are chosen by a hash of their id and text, pieces start at hashed places, and
    equal pieces of equal rows are fetched once, so what reaches the driver is bounded
    however often an id or a row repeats.
    Rows without text or language are never chosen.
    """
    usable = labelled.where(F.col(text).isNotNull() & (F.col(text) != "") & F.col(lang).isNotNull())
    counts = usable.groupBy(lang).count().orderBy(F.desc("count"), lang).limit(PIECES).collect()
    if not counts:
        return []
    each = max(1, min(PER_LANGUAGE, PIECES // len(counts)))
    share = {r[0]: min(1.0, 1.5 * each / r[1] + 16 / r[1]) for r in counts}
    mark = F.xxhash64(F.col(doc_id).cast("string"), F.col(text), F.lit("sample"))  # rows that share an id or a text are drawn apart
    rates = usable.sparkSession.createDataFrame([(k, v) for k, v in share.items()], f"`{lang}` {dict(usable.dtypes)[lang]}, __rate double")
    start = F.pmod(F.xxhash64(mark), F.greatest(F.length(text) - PIECE, F.lit(0)) + 1) + 1
    chosen = usable.join(F.broadcast(rates), lang).where(F.pmod(mark, F.lit(1 << 20)) < F.col("__rate") * (1 << 20))
    rows = chosen.select(F.col(lang).alias("l"), mark.alias("m"), F.substring(F.col(text), start.cast("int"), F.lit(PIECE)).alias("p")).distinct().collect()
    taken: dict[str, int] = {}
    out = []
    for r in sorted(rows, key=lambda r: (r.l, r.m, r.p)):
        taken[r.l] = taken.get(r.l, 0) + 1
        if taken[r.l] <= each:
            out.append((r.p, r.l))
    return out


def _judge(model: ByteGru | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    asked = [i for i, t in enumerate(texts) if model and t and _LETTER.search(t)]
    names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if asked:
        pooled = model.pooled([texts[i].encode() for i in asked])
        for i, k, p in zip(asked, pooled.argmax(axis=1).tolist(), pooled.max(axis=1).tolist(), strict=True):
            names[i], scores[i] = model.labels[k], min(1.0, p)
    return names, scores


def predict_language(docs: DataFrame, net: ByteGru | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the pooled probability of that language over the whole text.

    ``und`` and 0 where the text is null, empty or has no letter, and for all
    rows where there is no network. Columns of those names are replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast(net and (net.labels, net.w))
    plain = docs.drop("lang_pred", "score")
    schema = plain.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    at = plain.columns.index(text)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value and ByteGru(*held.value)
        for whole in batches:
            column = whole.column(at)
            for a, b in takes(pc.utf8_length(column).to_pylist()):
                names, scores = _judge(model, column.slice(a, b - a).to_pylist())
                yield pa.RecordBatch.from_arrays([*whole.slice(a, b - a).columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=schema.names)

    return plain.mapInArrow(predict, schema)


def language_verdict(docs: DataFrame, net: ByteGru, text: str = "text") -> Column:
    """A column of ``docs``: struct ``lang_pred, score`` as in ``predict_language``. Only the text goes
    to the workers and only the verdict comes back, so the rows stay where they are."""
    held = docs.sparkSession.sparkContext.broadcast((net.labels, net.w))

    @F.arrow_udf("lang_pred string, score double")
    def verdict(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = ByteGru(*held.value)
        for column in parts:
            names: list[str] = []
            scores: list[float] = []
            for a, b in takes(pc.utf8_length(column).to_pylist()):
                found = _judge(model, column.slice(a, b - a).to_pylist())
                names += found[0]
                scores += found[1]
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"])

    return verdict(F.col(text))


def held_out(doc_id: str) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, divisible by 5; null ids are held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(True))


def op4_language_id(docs: DataFrame) -> DataFrame:
    """Trains on documents that are not held out, then predicts every whole text."""
    net = train(training_pieces(docs.where(~held_out("doc_id")), "doc_id", "text", "lang"))
    return predict_language(docs.select("doc_id", held_out("doc_id").alias("held_out"), "text"), net).drop("text")
