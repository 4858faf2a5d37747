"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from stratalake.llm.common import hash_sample, map_batches, values

# Lower-cases ASCII letters; other ASCII characters but digits separate words.
CLEAN = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256)
)


@dataclass(frozen=True)
class ToxicityTraining:
    """Settings. ``documents``: labelled documents of each class that are learned from at most, and
    ``windows`` of each of them (spread evenly over its text). ``words``: size of the vocabulary.
    ``grams``: buckets of four-byte grams. Windows have ``width`` words and start every ``step``."""

    documents: int = 1500
    windows: int = 24
    words: int = 4096
    grams: int = 16384
    width: int = 32
    step: int = 24
    size: int = 8
    epochs: int = 10
    batch: int = 256
    rate: float = 0.02
    seed: int = 11


def sigmoid(x):
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-x))


def tanh(x):
    return 2 * sigmoid(2 * x) - 1


def window_starts(count: int, width: int, step: int) -> np.ndarray:
    """Overlapping windows that cover all of ``count`` words; one for a text without words too."""
    if count <= width:
        return np.zeros(1, np.int64)
    starts = np.arange(0, count - width + step, step)
    return np.minimum(starts, count - width)


class ToxicityNet:
    """Word and character input, a gated recurrent layer in each direction, attention, one logit."""

    def __init__(self, settings: ToxicityTraining, words: dict[bytes, int], parameters: dict[str, np.ndarray]):
        self.settings, self.words, self.p = settings, words, parameters

    @classmethod
    def new(cls, settings: ToxicityTraining, words: dict[bytes, int]) -> ToxicityNet:
        random, h = np.random.default_rng(settings.seed), settings.size
        shapes = {
            "word": (len(words) + 1, h), "gram": (settings.grams, h), "W": (2 * h, 6 * h), "b": (6 * h,),
            "U": (2, h, 3 * h), "A": (2 * h, h), "a": (h,), "v": (h,), "out": (2 * h,), "bias": (1,),
        }
        scale = {"word": 0.05, "gram": 0.05, "b": 0, "a": 0, "bias": 0}
        parameters = {
            name: (random.normal(size=shape) * scale.get(name, h**-0.5)).astype(np.float32) for name, shape in shapes.items()
        }
        return cls(settings, words, parameters)

    def tokens(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Word numbers; grams of all words, where each word's begin, and how many it has."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        text = np.frombuffer(b"  " + b"  ".join(words) + b"  ", np.uint8).astype(np.uint32)
        codes = ((text[:-3] * 31 + text[1:-2]) * 37 + text[2:-1]) * 41 + text[3:]
        grams = ((codes * np.uint32(2654435761)) >> np.uint32(16)) % self.settings.grams
        begin = np.cumsum(sizes + 2) - sizes - 1
        number = self.words.get
        numbers = np.array([number(word, 0) for word in words], np.int64)
        return numbers, grams, begin, sizes

    def _inputs(self, tokens) -> np.ndarray:
        numbers, grams, begin, sizes = tokens
        edges = np.column_stack([begin, begin + sizes]).ravel()
        chars = np.add.reduceat(self.p["gram"][grams], np.minimum(edges, len(grams) - 1), axis=0)[::2]
        return np.concatenate([self.p["word"][numbers], chars / sizes[:, None].astype(np.float32)], axis=1)

    def _forward(self, inputs: np.ndarray, index: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows; ``index`` (width, windows) points to ``inputs``."""
        p, h = self.p, self.settings.size
        steps, count = index.shape
        projected = (inputs @ p["W"] + p["b"])[index]
        forth, back = projected[..., : 3 * h], projected[::-1, :, 3 * h :]
        masks = np.stack([mask, mask[::-1]], axis=1)[..., None]
        state = np.zeros((2, count, h), np.float32)
        states = np.empty((steps, 2, count, h), np.float32)
        trace = []
        for t in range(steps):
            x = np.stack([forth[t], back[t]])
            g = state @ p["U"]
            gates = sigmoid(x[..., : 2 * h] + g[..., : 2 * h])
            z, r = gates[..., :h], gates[..., h:]
            c = tanh(x[..., 2 * h :] + r * g[..., 2 * h :])
            if keep:
                trace.append((state, z, r, c, g[..., 2 * h :]))
            state = state + masks[t] * (1 - z) * (c - state)
            states[t] = state
        H = np.concatenate([states[:, 0], states[::-1, 1]], axis=2)
        u = tanh(H @ p["A"] + p["a"])
        scores = np.where(mask > 0, u @ p["v"], -1e9)
        scores = np.exp(scores - scores.max(axis=0))
        weights = scores / scores.sum(axis=0)
        pooled = (weights[..., None] * H).sum(axis=0)
        logits = pooled @ p["out"] + p["bias"][0]
        return logits, (inputs, index, masks, trace, H, u, weights, pooled)

    def _gradients(self, tokens, cache, d_logits: np.ndarray) -> dict[str, np.ndarray]:
        p, h = self.p, self.settings.size
        inputs, index, masks, trace, H, u, weights, pooled = cache
        g = {"out": pooled.T @ d_logits, "bias": d_logits.sum(keepdims=True)}
        d_pooled = d_logits[:, None] * p["out"]
        dH = weights[..., None] * d_pooled
        d_weights = (H * d_pooled).sum(axis=2)
        d_scores = weights * (d_weights - (weights * d_weights).sum(axis=0))
        g["v"] = np.einsum("tb,tbk->k", d_scores, u)
        d_u = d_scores[..., None] * p["v"] * (1 - u * u)
        g["A"], g["a"] = np.einsum("tbi,tbk->ik", H, d_u), d_u.sum(axis=(0, 1))
        dH = dH + d_u @ p["A"].T
        steps = len(trace)
        d_states = np.stack([dH[..., :h], dH[::-1, :, h:]], axis=1)
        d_x = np.empty((steps, 2, dH.shape[1], 3 * h), np.float32)
        g["U"] = np.zeros_like(p["U"])
        d_state = np.zeros_like(d_states[0])
        for t in range(steps - 1, -1, -1):
            before, z, r, c, gc = trace[t]
            d_state = d_state + d_states[t]
            m = masks[t]
            d_c = d_state * m * (1 - z) * (1 - c * c)
            d_z = d_state * m * (before - c) * z * (1 - z)
            d_r = d_c * gc * r * (1 - r)
            d_x[t] = np.concatenate([d_z, d_r, d_c], axis=2)
            d_g = np.concatenate([d_z, d_r, d_c * r], axis=2)
            g["U"] += before.transpose(0, 2, 1) @ d_g
            d_state = d_state * (1 - m * (1 - z)) + d_g @ p["U"].transpose(0, 2, 1)
        d_projected = np.concatenate([d_x[:, 0], d_x[::-1, 1]], axis=2).reshape(-1, 6 * h)
        d_token = np.zeros((len(inputs), 6 * h), np.float32)
        np.add.at(d_token, index.ravel(), d_projected)
        g["W"], g["b"] = inputs.T @ d_token, d_token.sum(axis=0)
        d_inputs = d_token @ p["W"].T
        numbers, grams, begin, sizes = tokens
        g["word"], g["gram"] = np.zeros_like(p["word"]), np.zeros_like(p["gram"])
        np.add.at(g["word"], numbers, d_inputs[:, :h])
        of = np.repeat(np.arange(len(sizes)), sizes)
        at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(begin, sizes)
        np.add.at(g["gram"], grams[at], (d_inputs[:, h:] / sizes[:, None])[of])
        return g

    def window_logits(self, windows: list[list[bytes]]) -> np.ndarray:
        logits = [self._of_windows(windows[i : i + 2048])[0] for i in range(0, len(windows), 2048)]
        return np.concatenate(logits) if logits else np.zeros(0, np.float32)

    def _of_windows(self, windows: list[list[bytes]], keep: bool = False):
        number: dict[bytes, int] = {b".": 0}
        index = np.zeros((self.settings.width, len(windows)), np.int64)
        mask = np.zeros(index.shape, np.float32)
        for j, words in enumerate(windows):
            row = [number.setdefault(word, len(number)) for word in words] or [0]
            index[: len(row), j] = row
            mask[: len(row), j] = 1
        tokens = self.tokens(list(number))
        logits, cache = self._forward(self._inputs(tokens), index, mask, keep)
        return logits, tokens, cache

    def _surprise(self, holders: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """How many standard errors beyond two the log odds of toxic documents lie above the others'.
        ``holders``: number of clean and of toxic documents with each word or gram."""
        odds = np.log((holders + 0.5) / (np.bincount(labels, minlength=2) + 1))
        errors = np.sqrt((1 / (holders + 0.5)).sum(axis=1))
        return np.maximum((odds[:, 1] - odds[:, 0]) / errors - 2, 0).astype(np.float32)

    def start(self, documents: list[list[list[bytes]]], labels: np.ndarray) -> list[np.ndarray]:
        """Sets the first input of words and grams to what few documents can tell about them, and
        returns how much of it there is in each window."""
        words, grams = np.zeros((len(self.p["word"]), 2)), np.zeros((len(self.p["gram"]), 2))
        parts = []
        for document, label in zip(documents, labels, strict=True):
            tokens = self.tokens([word for window in document for word in window] or [b"."])
            words[np.unique(tokens[0]), label] += 1
            own = np.zeros(len(tokens[1]) + 1, np.int64)
            np.add.at(own, tokens[2], 1)
            np.add.at(own, tokens[2] + tokens[3], -1)
            grams[np.unique(tokens[1][np.cumsum(own)[:-1] > 0]), label] += 1
            parts.append(tokens)
        words[0] = 1
        self.p["word"][:, 0], self.p["gram"][:, 0] = self._surprise(words, labels), self._surprise(grams, labels)
        found = []
        for document, tokens in zip(documents, parts, strict=True):
            signs = self._inputs(tokens)[:, [0, self.settings.size]].sum(axis=1)
            edges = np.cumsum([0, *map(len, document[:-1])])
            found.append(np.maximum.reduceat(signs, np.minimum(edges, len(signs) - 1)))
        return found

    def fit(self, documents: list[list[list[bytes]]], labels: np.ndarray) -> None:
        """Learns from the window of each document that looks most toxic, and for clean documents
        another one too. Adam; both classes weigh the same."""
        looks = np.concatenate(self.start(documents, labels))
        s, random = self.settings, np.random.default_rng(self.settings.seed)
        first = {name: np.zeros_like(x) for name, x in self.p.items()}
        second = {name: np.zeros_like(x) for name, x in self.p.items()}
        owner = np.repeat(np.arange(len(documents)), [len(d) for d in documents])
        flat = [window for document in documents for window in document]
        begin = np.searchsorted(owner, np.arange(len(documents)))
        share = np.array([(labels == 0).sum(), (labels == 1).sum()]) / max(len(labels), 1)
        step = 0
        for epoch in range(s.epochs):
            logits = self.window_logits(flat) if epoch else looks
            top = np.array([begin[i] + np.argmax(logits[begin[i] : begin[i] + len(d)]) for i, d in enumerate(documents)])
            clean = np.flatnonzero(labels == 0)
            other = begin[clean] + (random.random(len(clean)) * [len(documents[i]) for i in clean]).astype(np.int64)
            chosen = np.concatenate([top, other])
            target = np.concatenate([labels, np.zeros(len(other))]).astype(np.float32)
            weight = np.concatenate([0.5 / share[labels], np.full(len(other), 0.25 / share[0])]).astype(np.float32)
            order = random.permutation(len(chosen))
            rate = s.rate * (1 - epoch / s.epochs) + 0.001
            for at in range(0, len(order), s.batch):
                part = order[at : at + s.batch]
                logits, tokens, cache = self._of_windows([flat[i] for i in chosen[part]], keep=True)
                d = (sigmoid(logits) - target[part]) * weight[part] / len(part)
                gradients = self._gradients(tokens, cache, d.astype(np.float32))
                step += 1
                for name, g in gradients.items():
                    first[name] += 0.1 * (g - first[name])
                    second[name] += 0.001 * (g * g - second[name])
                    m, v = first[name] / (1 - 0.9**step), second[name] / (1 - 0.999**step)
                    self.p[name] -= (rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)

    def document_scores(self, texts) -> np.ndarray:
        """The largest probability among the overlapping windows of each text."""
        s, out = self.settings, [np.zeros(0)]
        words: list[bytes] = []
        starts: list[np.ndarray] = []
        ends: list[np.ndarray] = []

        def score_gathered() -> None:
            inputs = self._inputs(self.tokens(words))
            first, last = np.concatenate(starts), np.concatenate(ends)
            logits = []
            for at in range(0, len(first), 4096):
                index = first[None, at : at + 4096] + np.arange(s.width)[:, None]
                mask = (index < last[None, at : at + 4096]).astype(np.float32)
                logits.append(self._forward(inputs, np.minimum(index, len(words) - 1), mask)[0])
            edges = np.cumsum([0, *map(len, starts[:-1])])
            out.append(sigmoid(np.maximum.reduceat(np.concatenate(logits), edges).astype(float)))
            words.clear(), starts.clear(), ends.clear()

        for text in texts:
            own = text.translate(CLEAN).split() or [b"."]
            begin = window_starts(len(own), s.width, s.step)
            starts.append(begin + len(words))
            ends.append(np.minimum(begin + s.width, len(own)) + len(words))
            words += own
            if len(words) >= 60_000:  # as many texts together as make a good batch
                score_gathered()
        if words:
            score_gathered()
        return np.concatenate(out)


def training_windows(documents: DataFrame, labels: DataFrame, settings: ToxicityTraining):
    """Windows and labels of at most ``settings.documents`` documents a class, those with the
    smallest hash of the doc_id. Documents with contradicting labels teach nothing; of several texts
    with the same doc_id the one with the smallest hash does."""
    known = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
        .where("toxic = most")
    )
    ids = None
    for value in (0, 1):
        some = hash_sample(known.where(F.col("toxic") == value).select("doc_id", "toxic"), ["doc_id"], settings.documents)
        ids = some if ids is None else ids.unionByName(some)

    def cut(batches):
        for batch in batches:
            windows = []
            for text in values(batch, "text"):
                words = text.translate(CLEAN).split()
                starts = window_starts(len(words), settings.width, settings.step)
                if len(starts) > settings.windows:
                    starts = starts[np.linspace(0, len(starts) - 1, settings.windows).astype(int)]
                windows.append([b" ".join(words[i : i + settings.width]) for i in starts])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic").cast("int32"), pa.array(windows, pa.list_(pa.binary()))],
                names=["doc_id", "toxic", "windows"],
            )

    # At most two times settings.documents ids, which Spark knows from the limits and sends along.
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, "doc_id")
    chosen = texts.groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = chosen.mapInArrow(cut, "doc_id long, toxic int, windows array<binary>").collect()
    rows.sort(key=lambda row: (row.doc_id, row.windows))
    return [[bytes(w).split() for w in row.windows] for row in rows], np.array([row.toxic for row in rows], np.int64)


def train_toxicity(
    documents: DataFrame, labels: DataFrame, settings: ToxicityTraining = ToxicityTraining()
) -> ToxicityNet:
    """A network learned from ``labels`` (doc_id, toxic 0 or 1) of ``documents`` (doc_id, text).

    Texts are all it sees. Learning is on a bounded sample in the driver; the same input gives the
    same network. With no labels of one class every text scores 0.
    """
    texts, known = training_windows(documents, labels, settings)
    counts: dict[bytes, int] = {}
    for document in texts:
        for word in {word for window in document for word in window}:
            counts[word] = counts.get(word, 0) + 1
    often = sorted((w for w, c in counts.items() if c >= 3), key=lambda w: (-counts[w], w))[: settings.words]
    net = ToxicityNet.new(settings, {word: i + 1 for i, word in enumerate(often)})
    if len(set(known.tolist())) == 2:
        net.fit(texts, known)
    else:
        net.p["out"][:], net.p["bias"][:] = 0, -30
    return net


def score_toxicity(documents: DataFrame, net: ToxicityNet) -> DataFrame:
    """``documents`` with ``score`` (0 to 1) for each ``text``: the largest probability of its windows
    of ``width`` words, which overlap and cover the whole text. Null and empty texts are scored as
    a text of one unknown word. Rows are independent, repeated ones included; the other columns are
    passed on, but a column named ``score`` is replaced.
    """
    rows = documents.drop("score")
    context = documents.sparkSession.sparkContext
    parts = context.broadcast((net.settings.__dict__, net.words, net.p))  # bounded by the settings

    def score(batches):
        settings, words, parameters = parts.value
        ready = ToxicityNet(ToxicityTraining(**settings), words, parameters)
        for batch in batches:
            scores = ready.document_scores(values(batch, "text"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, "score"])

    return map_batches(rows, score, StructType([*rows.schema.fields, StructField("score", DoubleType())]))


def drop_toxic(documents: DataFrame, net: ToxicityNet, least: float = 0.5) -> DataFrame:
    """``documents`` without those whose text scores ``least`` or more; all columns stay as they are."""
    context = documents.sparkSession.sparkContext
    parts = context.broadcast((net.settings.__dict__, net.words, net.p))  # bounded by the settings

    def keep(batches):
        settings, words, parameters = parts.value
        ready = ToxicityNet(ToxicityTraining(**settings), words, parameters)
        for batch in batches:
            stays = pa.array(np.asarray(ready.document_scores(values(batch, "text"))) < least)
            for at in range(0, batch.num_rows, 1000):  # neither side holds a second large batch
                yield batch.slice(at, 1000).filter(stays.slice(at, 1000))

    return map_batches(documents, keep, documents.schema)
