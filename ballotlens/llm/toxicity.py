"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A token enters as the sum of a word embedding and of character embeddings
(n-grams at its start and end). Words and n-grams have embeddings if they occur
in ``MIN_DOCUMENTS`` or more documents of the sample. Every window of 64
tokens, one each 48 tokens, is scored over the whole text; the document takes
its highest window. The network is trained in numpy in one task, which hands
only weights to the driver, on a bounded sample of labelled documents: at most ``SAMPLE`` per class, those with the
smallest hashes of doc_id among labelled rows of the learning folds, if not
longer than ``SAMPLE_CHARS``. Labels hold for documents, so a document's
windows are pooled while learning. A logistic fit, weighted to the shares of the
classes among all labels, maps the highest window to a score that is 0.5 where
the fewest of the sample are mistaken, in the middle of the widest such gap; a fifth
that was not learnt from counts ``LEARNT_WEIGHT`` ** -1 times as much as the rest.

Defined cases: a null or empty text is one empty window; labels that are null
are left out and of several labels of one doc_id the largest counts; without
labels of both classes every score is the smoothed share of the one class
((positives + 1) / (n + 2)); a row with a null doc_id is not held out; an empty
table gives an empty result; other columns are ignored."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ballotlens.llm import common as C

SAMPLE = 3000
SAMPLE_CHARS = 6000
FOLDS = 5
WINDOW, STRIDE = 64, 48
WIDTH, HIDDEN = 12, 8
MIN_DOCUMENTS = 3
LEARNT_WEIGHT = 0.02            # of a document that was learnt from, in the final fit
GRAMS = ((0, 3), (0, 4), (0, 5), (1, 3), (1, 4))        # (0 start or 1 end of the word, bytes)
STEPS, BATCH = 600, 16                                  # documents of each class in a batch
SEED = 7
CHUNK_BYTES = 1 << 20       # of text whose tokens are numbered together: learning draws by these numbers
_U = np.uint64
_SEPARATOR = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the word and n-grams of each distinct token, each token's number
    among them, bounds of the documents. Row 0 stands for "no token"."""
    data, offsets = C.text_buffers(texts)
    keys, rows, begins = [np.zeros(0, _U)], [np.zeros((0, 1 + len(GRAMS)), _U)], [np.zeros(0, np.int64)]
    for a, b in C._pieces(data, offsets, _SEPARATOR, CHUNK_BYTES):
        part = data[a:b]
        starts, ends = C.word_spans(part, offsets[(offsets >= a) & (offsets <= b)] - a, _SEPARATOR)
        if not len(starts):
            continue
        hashes = C.span_hasher(part)
        word = hashes(starts, ends)
        key, first, number = np.unique(word, return_index=True, return_inverse=True)
        s, e = starts[first], ends[first]
        columns = [key] + [hashes(np.maximum(s, e - n) if end else s, e if end else np.minimum(s + n, e))
                           + _U(0x9E37 * (2 * n + end)) for end, n in GRAMS]
        row = np.stack(columns, axis=1)
        keys.append(number + sum(map(len, rows)) + 1)
        rows.append(row)
        begins.append(starts + a)
    table = np.concatenate([np.zeros((1, 1 + len(GRAMS)), _U), *rows])
    return table, np.concatenate(keys).astype(np.int64), np.searchsorted(np.concatenate(begins), offsets)


def _windows(numbers: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(windows, WINDOW) token numbers, 0 where a window has no token, and the
    document of each window; every document has one at least."""
    n = np.diff(bounds)
    count = np.maximum(1, -(-(n - WINDOW) // STRIDE) + 1)
    doc = np.repeat(np.arange(len(n)), count)
    first = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    at = bounds[doc] + first * STRIDE
    place = at[:, None] + np.arange(WINDOW)
    inside = place < bounds[doc + 1][:, None]
    if not len(numbers):
        return np.zeros((len(doc), WINDOW), np.int64), doc
    return np.where(inside, numbers[np.minimum(place, len(numbers) - 1)], 0), doc


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Weights, forward pass and gradients."""

    def __init__(self, vocabulary: np.ndarray, seed: int = SEED):
        """vocabulary: sorted hashes of the words and n-grams with embeddings."""
        rng, self.vocabulary = np.random.default_rng(seed), vocabulary
        f = lambda *shape, s: (rng.standard_normal(shape) * s).astype(np.float32)
        self.embedding = f(len(vocabulary) + 1, WIDTH, s=0.1)
        self.embedding[-1] = 0                                  # row -1: not in the vocabulary
        self.p = {"W": f(2, WIDTH, 3 * HIDDEN, s=0.4), "U": f(2, HIDDEN, 3 * HIDDEN, s=0.3),
                  "b": np.zeros((2, 3 * HIDDEN), np.float32), "v": f(2 * HIDDEN, s=0.3),
                  "o": f(2 * HIDDEN, s=0.3), "c": np.zeros(1, np.float32)}
        self.scale, self.shift = 1.0, 0.0

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        """Embedding rows of hashes, -1 for those not in the vocabulary."""
        if not len(self.vocabulary):
            return np.full(hashes.shape, -1)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, -1)

    def inputs(self, table: np.ndarray) -> np.ndarray:
        return self.embedding[table].sum(axis=1)

    def forward(self, gates: np.ndarray, numbers: np.ndarray, keep: bool = False):
        """gates: (2, distinct tokens, 3 * HIDDEN) input sums; numbers: windows
        of token numbers. Returns window logits (and the states if kept)."""
        n, steps = numbers.shape
        h_all = np.empty((n, steps, 2 * HIDDEN), np.float32)
        memo = []
        present = (numbers > 0).astype(np.float32)
        for d in (0, 1):
            u, h = self.p["U"][d], np.zeros((n, HIDDEN), np.float32)
            order = range(steps) if d == 0 else range(steps - 1, -1, -1)
            trace = []
            for t in order:
                x = gates[d][numbers[:, t]]
                zr = _sigmoid(x[:, :2 * HIDDEN] + h @ u[:, :2 * HIDDEN])
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                rh = r * h
                c = np.tanh(x[:, 2 * HIDDEN:] + rh @ u[:, 2 * HIDDEN:])
                m = present[:, t:t + 1]
                new = h + m * z * (c - h)
                if keep:
                    trace.append((t, h, z, r, rh, c, m))
                h = new
                h_all[:, t, d * HIDDEN:(d + 1) * HIDDEN] = h
            memo.append(trace)
        score = h_all @ self.p["v"] + np.where(present > 0, 0, -1e4)
        weight = np.exp(score - score.max(axis=1, keepdims=True))
        weight = weight / weight.sum(axis=1, keepdims=True)
        pooled = (weight[:, :, None] * h_all).sum(axis=1)
        logit = pooled @ self.p["o"] + self.p["c"][0]
        return (logit, (h_all, weight, pooled, memo)) if keep else logit

    def backward(self, d_logit: np.ndarray, numbers: np.ndarray, inputs: np.ndarray, state) -> tuple[dict, np.ndarray]:
        """Gradients of the weights and of the distinct tokens' inputs."""
        h_all, weight, pooled, memo = state
        g = {k: np.zeros_like(w) for k, w in self.p.items()}
        g["o"], g["c"] = pooled.T @ d_logit, d_logit.sum(keepdims=True)
        d_pooled = d_logit[:, None] * self.p["o"]
        along = (h_all * d_pooled[:, None, :]).sum(axis=2)
        d_score = weight * (along - (weight * along).sum(axis=1, keepdims=True))
        g["v"] = np.einsum("nt,ntk->k", d_score, h_all)
        d_h = weight[:, :, None] * d_pooled[:, None, :] + d_score[:, :, None] * self.p["v"]
        d_inputs = np.zeros_like(inputs)
        for d in (0, 1):
            u, carry = self.p["U"][d], np.zeros((len(numbers), HIDDEN), np.float32)
            d_gates = np.zeros((len(inputs), 3 * HIDDEN), np.float32)
            for t, h, z, r, rh, c, m in reversed(memo[d]):
                now = d_h[:, t, d * HIDDEN:(d + 1) * HIDDEN] + carry
                dz = now * m * (c - h) * z * (1 - z)
                dc = now * m * z * (1 - c * c)
                d_rh = dc @ u[:, 2 * HIDDEN:].T
                dr = d_rh * h * r * (1 - r)
                dzr = np.concatenate([dz, dr], axis=1)
                carry = now * (1 - m * z) + d_rh * r + dzr @ u[:, :2 * HIDDEN].T
                g["U"][d][:, :2 * HIDDEN] += h.T @ dzr
                g["U"][d][:, 2 * HIDDEN:] += rh.T @ dc
                np.add.at(d_gates, numbers[:, t], np.concatenate([dzr, dc], axis=1))
            g["W"][d] = inputs.T @ d_gates
            g["b"][d] = d_gates.sum(axis=0)
            d_inputs += d_gates @ self.p["W"][d].T
        return g, d_inputs

    def gates(self, inputs: np.ndarray) -> np.ndarray:
        return np.stack([inputs @ self.p["W"][d] + self.p["b"][d] for d in (0, 1)])

    def document_logits(self, texts: pa.Array) -> np.ndarray:
        """Highest window logit of each text."""
        table, numbers, bounds = _tokens(texts)
        windows, doc = _windows(numbers, bounds)
        gates = self.gates(self.inputs(self.rows(table)))
        logits = np.concatenate([np.zeros(0, np.float32)] + [self.forward(gates, windows[i:i + 2048])
                                                             for i in range(0, len(windows), 2048)])
        return np.maximum.reduceat(logits, np.searchsorted(doc, np.arange(len(texts)))) if len(texts) else logits

    def scores(self, texts: pa.Array) -> np.ndarray:
        return _sigmoid(self.document_logits(texts).astype(np.float64) * self.scale + self.shift)


def _vocabulary(table: np.ndarray, numbers: np.ndarray, bounds: np.ndarray, chunk: int = 256) -> np.ndarray:
    """Hashes that occur in MIN_DOCUMENTS documents or more, counted by chunks
    of documents."""
    hashes, count = np.zeros(0, _U), np.zeros(0, np.int64)
    for at in range(0, len(bounds) - 1, chunk):
        edge = bounds[at:at + chunk + 1]
        some, n = np.unique(np.concatenate([np.unique(table[np.unique(numbers[a:b])]) for a, b in zip(edge[:-1], edge[1:])]),
                            return_counts=True)
        hashes, place = np.unique(np.concatenate([hashes, some]), return_inverse=True)
        count = np.bincount(place, np.concatenate([count, n]), len(hashes)).astype(np.int64)
    return hashes[count >= MIN_DOCUMENTS]


def train(texts: list[str], labels: np.ndarray, share: float, seed: int = SEED, steps: int = STEPS) -> Network:
    """A network that tells label 1 from 0; ``share`` is that of label 1 among
    all labels. A fixed number of steps, so that the time does not depend on
    the size of the sample."""
    rng = np.random.default_rng(seed)
    table, numbers, bounds = _tokens(pa.array(texts, pa.string()))
    net = Network(_vocabulary(table, numbers, bounds), seed)
    table = net.rows(table)
    windows, doc = _windows(numbers, bounds)
    begin = np.searchsorted(doc, np.arange(len(texts) + 1))
    fit = rng.random(len(texts)) >= 0.2
    fit[np.flatnonzero(labels == 1)[:1]] = fit[np.flatnonzero(labels == 0)[:1]] = True
    classes = [np.flatnonzero(fit & (labels == y)) for y in (0, 1)]
    moment = {k: [np.zeros_like(w), np.zeros_like(w)] for k, w in net.p.items()}
    squares = np.full(len(net.embedding), 1e-3, np.float32)
    for step in range(steps):
        docs = np.concatenate([rng.choice(c, BATCH) for c in classes])
        target = np.repeat([0.0, 1.0], BATCH).astype(np.float32)
        own = [np.arange(begin[i], begin[i + 1]) for i in docs]
        owner, rows = np.repeat(np.arange(len(docs)), [len(o) for o in own]), np.concatenate(own)
        used, local = np.unique(windows[rows], return_inverse=True)
        if used[0]:
            used, local = np.concatenate([[0], used]), local + 1
        local = local.reshape(len(rows), WINDOW)
        features = table[used].copy()
        features[rng.random(len(used)) < 0.15, 0] = -1          # word left out: characters must do
        features[rng.random(len(used)) < 0.4] = -1              # token left out: others must do
        features[0] = -1
        inputs = net.inputs(features)
        logit, state = net.forward(net.gates(inputs), local, keep=True)
        starts = np.searchsorted(owner, np.arange(len(docs)))
        top = np.maximum.reduceat(logit, starts)
        pull = np.exp(logit - top[owner])
        total = np.add.reduceat(pull, starts)
        d_doc = (_sigmoid(top + np.log(total)) - target) / len(docs)
        grads, d_inputs = net.backward((d_doc[owner] * pull / total[owner]).astype(np.float32), local, inputs, state)
        rate = 0.01 * min(1.0, (steps - step) / (0.4 * steps))
        for k, grad in grads.items():
            grad = np.clip(grad, -1, 1)
            a, b = moment[k]
            a *= 0.9
            a += 0.1 * grad
            b *= 0.99
            b += 0.01 * grad * grad
            net.p[k] -= (rate * (a / (1 - 0.9 ** (step + 1))) / (np.sqrt(b / (1 - 0.99 ** (step + 1))) + 1e-6)).astype(np.float32)
        flat = features.ravel()
        rows_used, place = np.unique(flat, return_inverse=True)
        grad = np.zeros((len(rows_used), WIDTH), np.float32)
        np.add.at(grad, place, np.repeat(d_inputs, features.shape[1], axis=0))
        real = rows_used >= 0
        rows_used, grad = rows_used[real], grad[real]
        squares[rows_used] += (grad * grad).mean(axis=1)
        net.embedding[rows_used] -= 5 * rate * grad / np.sqrt(squares[rows_used])[:, None]
    del windows, table, moment, squares
    logits = np.concatenate([net.document_logits(pa.array(texts[i:i + 256], pa.string())) for i in range(0, len(texts), 256)])
    net.scale, net.shift = _logistic(logits, labels, share, np.where(fit, LEARNT_WEIGHT, 1.0))
    return net


def _logistic(x: np.ndarray, y: np.ndarray, share: float, weight: np.ndarray) -> tuple[float, float]:
    """Scale of a ridge-regularised weighted logistic fit in which label 1 weighs
    ``share`` of all, and the shift that puts one half where errors are fewest."""
    x, y = x.astype(np.float64), y.astype(np.float64)
    centre, spread = float(np.median(x)), float(x.std()) or 1.0
    u, beta = np.stack([(x - centre) / spread, np.ones(len(x))], axis=1), np.zeros(2)
    ones = float((weight * y).sum() / weight.sum())
    w = weight * np.where(y == 1, share / max(ones, 1e-9), (1 - share) / max(1 - ones, 1e-9))
    for _ in range(50):
        p = _sigmoid(u @ beta)
        grad = u.T @ (w * (p - y)) + 0.05 * beta
        hess = (u * (w * p * (1 - p))[:, None]).T @ u + 0.05 * np.eye(2)
        beta -= np.linalg.solve(hess, grad)
    scale = max(float(beta[0] / spread), 1e-6)
    # one half lies in the middle of the gap with the fewest weighted errors
    order = np.argsort(x, kind="stable")
    wrong = np.cumsum(np.where(y == 1, w, -w)[order])           # errors, less a constant, if all up to here count as 0
    cuts = np.flatnonzero(x[order][1:] > x[order][:-1])
    if not len(cuts):                                           # all alike: no cut to choose
        return scale, float(beta[1] - beta[0] * centre / spread)
    least = cuts[wrong[cuts] <= wrong[cuts].min() + 1e-9]
    k = least[np.argmax(x[order][least + 1] - x[order][least])]
    return scale, -scale * float(x[order][k] + x[order][k + 1]) / 2


def held_out(doc_id="doc_id"):
    """True for rows of the fold that labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label_col: str = "toxic") -> tuple[DataFrame, float]:
    """The bounded learning sample, stored: rows (id, y, text) and the share of
    label 1 among all labels of the learning folds."""
    known = (labels.select(F.col("doc_id").cast("long").alias("id"), F.col(label_col).cast("int").alias("y"))
             .filter("id is not null and y in (0, 1)").groupBy("id").agg(F.max("y").alias("y"))
             .filter(~held_out("id")))
    share = known.agg(F.avg("y")).first()[0] or 0.0
    parts = [known.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(SAMPLE) for y in (0, 1)]
    chosen = parts[0].union(parts[1])                                   # at most 2 * SAMPLE rows
    found = (C.id_text(docs).filter(F.length("text") <= SAMPLE_CHARS)
             .join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).select("id", "y", "text"))
    return C.stored(found, "toxicity-sample"), share


def learned(docs: DataFrame, labels: DataFrame, label_col: str = "toxic") -> Network | float:
    """A network trained in one task on the sample; without labels of both
    classes the smoothed share of the one class."""
    rows, share = sample(docs, labels, label_col)
    steps = STEPS

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = sorted({row for b in batches for row in zip(*(b.column(c).to_pylist() for c in ("id", "y", "text")))})
        y = np.array([r[1] for r in some], np.int64)
        both = 0 < y.sum() < len(y)
        made = train([r[2] for r in some], y, share, steps=steps).__dict__ if both else float((y.sum() + 1) / (len(y) + 2))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(made)], pa.binary())], names=["made"])

    # the stored sample is bounded, so one task may read it whole
    got = rows.coalesce(1).mapInArrow(fit, "made binary").collect()
    made = pickle.loads(bytes(got[0].made)) if got else 0.5
    if isinstance(made, float):
        return made
    net = Network(made["vocabulary"])
    net.__dict__.update(made)
    return net


def toxicity_scores(docs: DataFrame, labels: DataFrame, label_col: str = "toxic") -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    net = learned(docs, labels, label_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in C.text_slices(batches, "text"):
            score = np.full(len(part), net) if isinstance(net, float) else net.scores(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score, pa.float64())], names=["doc_id", "score"])

    return (C.id_text(docs).mapInArrow(run, "doc_id long, score double")
            .select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))


def without_toxic(docs: DataFrame, labels: DataFrame, text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """The rows of ``docs``, with all their columns, that are not predicted toxic."""
    net = learned(docs, labels, label_col)
    if isinstance(net, float):
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in C.text_slices(batches, text_col):
            yield part.filter(pa.array(net.scores(part.column(text_col)) < 0.5))

    return C.small_batches(docs).mapInArrow(run, docs.schema)
