"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads UTF-8 bytes in windows of ``WINDOW`` bytes, one gated recurrent layer per direction, and labels
every position; a document's probabilities are the mean over all positions of its whole text. It is trained in
numpy by backpropagation through time on a bounded, documented sample: at most ``DOCS_PER_LANG`` labelled
rows per language, chosen by a hash of id and text, and ``WINDOWS_PER_DOC`` hashed windows from each; more than
``MAX_LANGS`` labels are an error. Prediction
reads all rows and whole texts in an Arrow map without a shuffle; weights of a few dozen KB travel with the task.

Defined results: a null text, a text without letters and any text where nothing could be learned get ``und``
with score 0; ties go to the first language in order; equal rows get equal results; a null id is kept and its
row is not used for learning; an empty table gives an empty result. Language, source and id are never inputs of
a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catloom.runtime import cut

WINDOW = 64
HIDDEN = 16
DOCS_PER_LANG = 256
MAX_LANGS = 512
WINDOWS_PER_DOC = 12
STEPS = 360
BATCH = 192
LEARNING_RATE = 0.01
SEED = 7
MIN_SCORE = 0.4
UNKNOWN = "und"


@dataclass
class ByteGRU:
    """Weights: per direction an input table (256 x 3h), a recurrence (h x 3h); then the output layer."""

    labels: list[str]
    params: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, labels: list[str], hidden: int = HIDDEN, seed: int = SEED) -> ByteGRU:
        rng = np.random.default_rng(seed)
        params = {}
        for d in "fb":
            params["x" + d] = rng.normal(0, 0.3, (256, 3 * hidden))
            params["u" + d] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden))
        params["v"] = rng.normal(0, 1 / np.sqrt(2 * hidden), (2 * hidden, len(labels)))
        params["c"] = np.zeros(len(labels))
        return cls(labels, {k: v.astype(np.float32) for k, v in params.items()})

    def _run(self, codes: np.ndarray, d: str, keep: bool) -> tuple[np.ndarray, list]:
        """States (T, B, h) of one direction; ``keep`` also gives what the backward pass needs."""
        table, u = self.params["x" + d], self.params["u" + d]
        h = u.shape[0]
        steps, n = codes.shape
        state = np.zeros((n, h), dtype=np.float32)
        states, tape = np.empty((steps, n, h), dtype=np.float32), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            x, a = table[codes[t]], state @ u
            gates = x[:, : 2 * h] + a[:, : 2 * h]
            gates = np.tanh(gates * np.float32(0.5)) * np.float32(0.5) + np.float32(0.5)
            z, r = gates[:, :h], gates[:, h:]
            new = np.tanh(x[:, 2 * h :] + r * a[:, 2 * h :])
            if keep:
                tape.append((t, state, z, r, new, a[:, 2 * h :]))
            state = new + z * (state - new)
            states[t] = state
        return states, tape

    def _states(self, codes: np.ndarray, d: str, out: np.ndarray) -> None:
        """The states of :meth:`_run` written into ``out`` (T, B, h), without a tape and without temporaries."""
        table, u = self.params["x" + d], self.params["u" + d]
        h = u.shape[0]
        # a logistic gate is a shifted tanh of half its argument; the halves go into the weights
        gate_in, gate_u = table[:, : 2 * h] * np.float32(0.5), u[:, : 2 * h] * np.float32(0.5)
        new_in, new_u = np.ascontiguousarray(table[:, 2 * h :]), np.ascontiguousarray(u[:, 2 * h :])
        steps, n = codes.shape
        state, gates, tmp = np.zeros((n, h), np.float32), np.empty((n, 2 * h), np.float32), np.empty((n, 2 * h), np.float32)
        new, inner = np.empty((n, h), np.float32), np.empty((n, h), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            np.take(gate_in, codes[t], axis=0, out=gates, mode="clip")
            np.matmul(state, gate_u, out=tmp)
            gates += tmp
            np.tanh(gates, out=gates)
            gates *= np.float32(0.5)
            gates += np.float32(0.5)
            np.take(new_in, codes[t], axis=0, out=new, mode="clip")
            np.matmul(state, new_u, out=inner)
            inner *= gates[:, h:]
            new += inner
            np.tanh(new, out=new)
            state -= new
            state *= gates[:, :h]
            state += new
            out[t] = state

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        """Probabilities (T, B, L) of every position of windows given as byte codes (T, B)."""
        h = self.params["uf"].shape[0]
        both = np.empty((*codes.shape, 2 * h), np.float32)
        self._states(codes, "f", both[:, :, :h])
        self._states(codes, "b", both[:, :, h:])
        logits = both.reshape(-1, 2 * h) @ self.params["v"]
        logits += self.params["c"]
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits.reshape(*codes.shape, -1)

    def gradients(self, codes: np.ndarray, truth: np.ndarray, mask: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy over positions and its gradients, through time in both directions."""
        runs = {d: self._run(codes, d, True) for d in "fb"}
        both = np.concatenate([runs["f"][0], runs["b"][0]], axis=2)
        p = _softmax(both @ self.params["v"] + self.params["c"])
        weight = (mask / mask.sum()).astype(np.float32)
        picked = np.take_along_axis(p, np.broadcast_to(truth[None, :, None], (*codes.shape, 1)), axis=2)[:, :, 0]
        loss = float(-(np.log(picked + 1e-9) * weight).sum())
        delta = p.copy()
        delta[:, np.arange(len(truth)), truth] -= 1
        delta *= weight[:, :, None]
        width = both.shape[2]
        grads = {"v": both.reshape(-1, width).T @ delta.reshape(-1, delta.shape[2]), "c": delta.sum(axis=(0, 1))}
        back = delta @ self.params["v"].T
        h = width // 2
        for d, part in (("f", back[:, :, :h]), ("b", back[:, :, h:])):
            u = self.params["u" + d]
            du, dx = np.zeros_like(u), np.zeros_like(self.params["x" + d])
            carry = np.zeros((codes.shape[1], h), dtype=np.float32)
            for t, state, z, r, new, inner in reversed(runs[d][1]):
                out = part[t] + carry
                dn = out * (1 - z) * (1 - new * new)
                dz = out * (state - new) * z * (1 - z)
                dr = dn * inner * r * (1 - r)
                da = np.concatenate([dz, dr, dn * r], axis=1)
                np.add.at(dx, codes[t], np.concatenate([dz, dr, dn], axis=1))
                du += state.T @ da
                carry = out * z + da @ u.T
            grads["u" + d], grads["x" + d] = du, dx
        return loss, grads


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def windows_of(raw: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (size, B), position mask (size, B) and owner (B) of the consecutive windows of byte strings."""
    counts = np.array([-(-len(b) // size) for b in raw], dtype=np.int64)
    flat = np.zeros(int(counts.sum()) * size, dtype=np.uint8)
    mask = np.zeros(len(flat), dtype=bool)
    at = np.concatenate([[0], np.cumsum(counts)]) * size
    for start, b in zip(at.tolist(), raw):
        flat[start : start + len(b)] = np.frombuffer(b, dtype=np.uint8)
        mask[start : start + len(b)] = True
    return flat.reshape(-1, size).T, mask.reshape(-1, size).T, np.repeat(np.arange(len(raw)), counts)


def train(texts: list[str], langs: list[str], steps: int = STEPS, batch: int = BATCH, seed: int = SEED, hidden: int = HIDDEN) -> ByteGRU | None:
    """Fit on labelled windows with Adam; classes are drawn evenly. None without any labelled window."""
    pairs = sorted((lang, text.encode()[:WINDOW]) for lang, text in zip(langs, texts) if text)
    labels = sorted({lang for lang, _ in pairs})
    if not labels:
        return None
    codes, mask, _ = windows_of([raw for _, raw in pairs], WINDOW)
    truth = np.array([labels.index(lang) for lang, _ in pairs])
    members = [np.flatnonzero(truth == k) for k in range(len(labels))]
    model, rng = ByteGRU.fresh(labels, hidden, seed), np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in model.params.items()}
    second = {k: np.zeros_like(v) for k, v in model.params.items()}
    for step in range(1, steps + 1):
        classes = rng.integers(0, len(labels), batch)
        chosen = np.array([members[k][rng.integers(0, len(members[k]))] for k in classes])
        _, grads = model.gradients(codes[:, chosen], truth[chosen], mask[:, chosen])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        rate = LEARNING_RATE * (1 - 0.9 * step / steps)
        for k, g in grads.items():
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            change = (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
            model.params[k] -= (rate * change).astype(np.float32)
    return model


def pooled(model: ByteGRU, texts: list[str], rows: int = 1024) -> np.ndarray:
    """Mean probabilities (documents, labels) over all positions of non-empty texts."""
    total = np.zeros((len(texts), len(model.labels)))
    raw = [t.encode() for t in texts]
    begin = 0
    while begin < len(raw):  # memory is bounded by the windows of one megabyte, or one text
        end, size = begin, 0
        while end < len(raw) and (end == begin or size + len(raw[end]) <= 1_000_000):
            size += len(raw[end])
            end += 1
        codes, mask, owner = windows_of(raw[begin:end], WINDOW)
        for at in range(0, codes.shape[1], rows):
            p = model.probabilities(codes[:, at : at + rows])
            np.add.at(total, begin + owner[at : at + rows], (p * mask[:, at : at + rows, None]).sum(axis=0))
        begin = end
    return total / np.array([max(1, len(b)) for b in raw])[:, None]


def label_positions(model: ByteGRU, text: str) -> list[str]:
    """The label of every byte position of one text."""
    if not text:
        return []
    codes, mask, _ = windows_of([text.encode()], WINDOW)
    best = model.probabilities(codes).argmax(axis=2)
    return [model.labels[k] for k in best.T[mask.T]]


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learned from: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(True))


def training_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(lang, windows)``: the bounded sample, at most ``DOCS_PER_LANG`` rows a language.

    Rows, not ids, are chosen, by a hash of id and text, on narrow rows and in two levels; equal rows count once.
    """
    usable = F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(id_col)
    key = F.xxhash64(F.col(id_col), F.col(text_col))
    rows = docs.filter(usable).select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"), key.alias("h"))
    narrow = rows.select("lang", "h")
    for keys in (["lang", F.pmod("h", F.lit(64))], ["lang"]):
        rank = F.dense_rank().over(Window.partitionBy(*keys).orderBy("h"))
        narrow = narrow.withColumn("rank", rank).filter(F.col("rank") <= DOCS_PER_LANG).drop("rank")
    last = cut(narrow.groupBy("lang").agg(F.max("h").alias("last")))
    if last.count() > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages; give a column of fewer labels")
    span = F.greatest(F.length("text") - WINDOW + 1, F.lit(1))
    starts = [F.pmod(F.xxhash64(F.col("id"), F.lit(k)), span).cast("int") + 1 for k in range(WINDOWS_PER_DOC)]
    cuts = F.array_distinct(F.array(*[F.substring(F.col("text"), s, F.lit(WINDOW)) for s in starts]))
    chosen = rows.join(F.broadcast(last), "lang").filter(F.col("h") <= F.col("last"))  # one row a language
    return chosen.select("lang", "h", cuts.alias("windows")).groupBy("lang", "h").agg(F.min("windows").alias("windows")).drop("h")


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> ByteGRU | None:
    rows = sorted((r["lang"], w) for r in training_windows(docs, id_col, text_col, lang_col).collect() for w in r["windows"])
    return train([w for _, w in rows], [lang for lang, _ in rows])


def _judge(model: ByteGRU | None, texts: list[str | None], lettered: list[bool]) -> tuple[list[str], np.ndarray]:
    langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    live = [i for i, (t, has) in enumerate(zip(texts, lettered)) if t and has]
    if model is not None and live:
        p = pooled(model, [texts[i] for i in live])
        best = p.argmax(axis=1)
        for i, k, row in zip(live, best.tolist(), p):
            langs[i], scores[i] = model.labels[k], min(1.0, float(row[k]))
    return langs, scores


def _lettered(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, model: ByteGRU | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = _judge(model, batch.column(1).to_pylist(), batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores)], names=["doc_id", "lang_pred", "score"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), _lettered(text_col).alias("lettered"))
    return narrow.mapInArrow(run, "doc_id long, lang_pred string, score double")


def drop_unidentified(docs: DataFrame, model: ByteGRU | None, text_col: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs``, unchanged, that are in some learned language with at least ``min_score``. No shuffle."""
    at = docs.columns.index(text_col)
    # columns go by position, so that repeated names do no harm
    flagged = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    flagged = flagged.withColumn("lettered", _lettered(f"c{at}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = _judge(model, batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist())
            keep = pa.array([lang != UNKNOWN and score >= min_score for lang, score in zip(langs, scores)])
            yield batch.filter(keep).select(list(range(batch.num_columns - 1)))

    return flagged.mapInArrow(run, flagged.drop("lettered").schema).toDF(*docs.columns)
