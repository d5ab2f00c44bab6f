"""Language identification by a bidirectional gated recurrent network over bytes, in numpy."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from fathom.llm.chunks import by_bytes
from fathom.llm.common import id_crc32, pick

UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Training:
    """Bounds of what is learned from: so many documents of a language, so many bytes of each at most.

    ``languages`` (the most frequent ones), ``docs`` and ``words`` bound the
    whole sample: with many languages each has fewer documents and words.
    """

    languages: int = 256
    docs: int = 3000
    docs_per_language: int = 150
    doc_bytes: int = 20_000
    words: int = 240_000
    words_per_language: int = 12_000
    epochs: int = 3
    batch: int = 256
    hidden: int = 16
    rate: float = 0.01
    seed: int = 11


#: Bytes that the network reads at once; longer words are read in several parts.
SPAN = 24


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class ByteGru:
    """Two gated recurrent layers, one from each end, and a softmax at every position.

    ``weights``: for each direction the byte table E (256 x 3h: update, reset,
    candidate), recurrent U (h x 3h) and the output W (2h x languages), b.
    """

    languages: list[str]
    hidden: int
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, languages: list[str], hidden: int, rng: np.random.Generator) -> ByteGru:
        w = {}
        for d in "fb":
            w["E" + d] = rng.normal(0, 0.3, (256, 3 * hidden))
            w["U" + d] = rng.normal(0, hidden**-0.5, (hidden, 3 * hidden))
        w["W"] = rng.normal(0, (2 * hidden) ** -0.5, (2 * hidden, len(languages)))
        w["b"] = np.zeros(len(languages))
        return cls(languages, hidden, {k: v.astype(np.float32) for k, v in w.items()})

    def _run(self, d: str, x: np.ndarray, tape: list | None = None) -> np.ndarray:
        """States (time, batch, h) over the bytes x (batch, time)."""
        h, table, u = self.hidden, self.weights["E" + d], self.weights["U" + d]
        state = np.zeros((len(x), h), np.float32)
        out = np.empty((x.shape[1], len(x), h), np.float32)
        for t in range(x.shape[1]):
            given, past = table[x[:, t]], state @ u
            gates = _sigmoid(given[:, : 2 * h] + past[:, : 2 * h])
            z, r = gates[:, :h], gates[:, h:]
            new = np.tanh(given[:, 2 * h :] + r * past[:, 2 * h :])
            if tape is not None:
                tape.append((state, z, r, new, past[:, 2 * h :]))
            state = new + z * (state - new)
            out[t] = state
        return out

    def log_probs(self, x: np.ndarray) -> np.ndarray:
        """Log-probabilities (time, batch, languages) of each position of equally long words."""
        both = np.concatenate([self._run("f", x), self._run("b", x[:, ::-1])[::-1]], axis=2)
        return self._softmax(both)

    def _softmax(self, both: np.ndarray) -> np.ndarray:
        logits = both @ self.weights["W"] + self.weights["b"]
        logits -= logits.max(axis=2, keepdims=True)
        return logits - np.log(np.exp(logits).sum(axis=2, keepdims=True))

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over all positions and its gradients, by backpropagation through time."""
        tapes: dict[str, list] = {"f": [], "b": []}
        forward, backward = self._run("f", x, tapes["f"]), self._run("b", x[:, ::-1], tapes["b"])
        both = np.concatenate([forward, backward[::-1]], axis=2)
        logp = self._softmax(both)
        steps, n = logp.shape[:2]
        loss = -logp[:, np.arange(n), y].mean()
        delta = np.exp(logp)
        delta[:, np.arange(n), y] -= 1
        delta /= steps * n
        grads = {"W": np.einsum("tbi,tbo->io", both, delta), "b": delta.sum(axis=(0, 1))}
        into = delta @ self.weights["W"].T
        h = self.hidden
        for d, seen, dh in (("f", x, into[:, :, :h]), ("b", x[:, ::-1], into[::-1, :, h:])):
            u = self.weights["U" + d]
            d_table, d_u = np.zeros_like(self.weights["E" + d]), np.zeros_like(u)
            carry = np.zeros((n, h), np.float32)
            for t in range(steps - 1, -1, -1):
                state, z, r, new, past = tapes[d][t]
                g = dh[t] + carry
                d_new = g * (1 - z) * (1 - new * new)
                d_z = g * (state - new) * z * (1 - z)
                d_r = d_new * past * r * (1 - r)
                d_past = np.concatenate([d_z, d_r, d_new * r], axis=1)
                np.add.at(d_table, seen[:, t], np.concatenate([d_z, d_r, d_new], axis=1))
                d_u += state.T @ d_past
                carry = g * z + d_past @ u.T
            grads["E" + d], grads["U" + d] = d_table, d_u
        return float(loss), grads

    def evidence(self, words: list[str]) -> np.ndarray:
        """For each word the sum of its positions' log-probabilities, and the number of positions."""
        spans, owner = spans_of(words)
        sums = np.zeros((len(words), len(self.languages) + 1))
        sizes = np.array([len(s) for s in spans])
        order = np.argsort(sizes, kind="stable")
        start, most = 0, min(8192, max(1, (1 << 17) // len(self.languages)))
        while start < len(order):
            size = sizes[order[start]]
            stop = min(start + most, int(np.searchsorted(sizes[order], size, "right")))
            part = order[start:stop]
            x = np.frombuffer(b"".join([spans[i] for i in part]), np.uint8).reshape(-1, size)
            found = self.log_probs(x).sum(axis=0, dtype=np.float64)
            np.add.at(sums, owner[part], np.concatenate([found, np.full((len(part), 1), float(size))], axis=1))
            start = stop
        return sums


def spans_of(words: list[str]) -> tuple[list[bytes], np.ndarray]:
    """The words' bytes, in parts of ``SPAN`` at most, and the word of each part."""
    spans, owner = [], []
    for i, w in enumerate(words):
        data = w.encode()
        for at in range(0, len(data), SPAN):
            spans.append(data[at : at + SPAN])
            owner.append(i)
    return spans, np.array(owner, np.int64)


def words_of(text: str | None) -> list[str]:
    """Runs of letters in lower case."""
    return _WORD.findall(text.lower()) if text else []


def has_letter(word: str) -> bool:
    return word.isalpha() or any(c.isalpha() for c in word)


def train(rows: list[tuple[str, str]], how: Training = Training()) -> ByteGru:
    """Fit the network to (language, text) rows: Adam over minibatches of equally long words."""
    rng = np.random.default_rng(how.seed)
    languages = sorted({lang for lang, _ in rows})
    most = min(how.words_per_language, max(1, how.words // max(1, len(languages))))
    spans, labels = [], []
    for i, lang in enumerate(languages):
        found = sorted(w for name, text in rows if name == lang for w in words_of(text) if has_letter(w))
        if len(found) > most:
            found = [found[j] for j in rng.choice(len(found), most, replace=False)]
        own, _ = spans_of(found)
        spans += own
        labels += [i] * len(own)
    net = ByteGru.fresh(languages, how.hidden, rng)
    sizes, y = np.array([len(s) for s in spans], np.int64), np.array(labels, np.int64)
    by_size = [np.flatnonzero(sizes == s) for s in np.unique(sizes)]
    mean = {k: np.zeros_like(v) for k, v in net.weights.items()}
    square = {k: np.zeros_like(v) for k, v in net.weights.items()}
    step = 0
    for epoch in range(how.epochs):
        batches = []
        for rows_of_size in by_size:
            mixed = rng.permutation(rows_of_size)
            batches += [mixed[i : i + how.batch] for i in range(0, len(mixed), how.batch)]
        for j in rng.permutation(len(batches)):
            part = batches[j]
            x = np.frombuffer(b"".join(spans[i] for i in part), np.uint8).reshape(len(part), -1)
            _, grads = net.gradients(x, y[part])
            step += 1
            rate = how.rate * 0.3**epoch
            for k, g in grads.items():
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                scaled = np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8
                net.weights[k] -= (rate * mean[k] / (1 - 0.9**step) / scaled).astype(np.float32)
    return net


def training_rows(docs: DataFrame, how: Training) -> list[tuple[str, str]]:
    """The bounded sample: of each language the documents whose ids hash lowest.

    Only rows that may be learned from (crc32 of the id mod 5 is not 0, a
    language other than ``und``, a letter in the text).  A text of more than ``doc_bytes`` gives
    an excerpt.  The languages are counted first: the most frequent ones share
    ``docs`` documents.  The limit is applied before the rows are shuffled.
    """
    rows = pick(docs, doc_id="long", text="string", lang="string").filter(
        (id_crc32(F.col("doc_id")) % 5 != 0) & (F.col("lang") != UNKNOWN) & F.col("text").rlike(r"\p{L}")
    )
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(how.languages).collect()
    if not counts:
        return []
    most = min(how.docs_per_language, max(1, how.docs // len(counts)))
    rows = rows.filter(F.col("lang").isin([r.lang for r in counts]))
    rows = rows.select("lang", F.xxhash64("doc_id", "text").alias("place"), _excerpt(how.doc_bytes).alias("text"))
    order = Window.partitionBy("lang").orderBy("place")
    few = rows.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= most)
    found = sorted((r.lang, r.text) for r in few.select("lang", "text").collect())
    return [(lang, text) for lang, text in found if any(map(has_letter, words_of(text)))]


def _excerpt(most: int) -> Column:
    """The text; of one of more than ``most`` bytes its letters, blanks between words, from a place that the hash names."""
    letters, size = F.regexp_replace("text", r"[^\p{L}]+", " "), most // 4  # a character has at most 4 bytes
    start = F.pmod(F.xxhash64("doc_id", "text"), F.greatest(F.char_length(letters) - size + 1, F.lit(1))) + 1
    return F.when(F.octet_length("text") <= most, F.col("text")).otherwise(
        F.substring(letters, start.cast("int"), F.lit(size))
    )


def predict(docs: DataFrame, net: ByteGru | None, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score, from the whole text alone.

    A text is its runs of letters in lower case, each read byte by byte from
    both ends; each byte is labelled, and the text's probabilities are the
    geometric means of those of its bytes, scaled to one.  Distinct words of
    a slice of a batch are read once.  ``und`` with score 0 where the text is
    null or has no letter, and everywhere if nothing was learned.
    """
    sent = docs.sparkSession.sparkContext.broadcast(net and (net.languages, net.hidden, net.weights))
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value and ByteGru(*sent.value)
        for whole in batches:
            for batch in by_bytes(whole, at, 8 << 20):
                names, scores = label(batch.column(at), known)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    [*batch.schema.names, "lang_pred", "score"],
                )

    schema = StructType([*docs.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return docs.mapInArrow(run, schema)


def label(texts: pa.Array, net: ByteGru | None) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    if net is None:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    parts, sizes = [], []
    for t in texts:
        # Text by text, as a list of all words takes several times the texts' bytes.
        parts.append(pa.array(words_of(t.as_py()), pa.string()))
        sizes.append(len(parts[-1]))
    coded = pa.chunked_array(parts, pa.string()).combine_chunks().dictionary_encode()
    del parts
    words = coded.dictionary.to_pylist()
    known = np.array([has_letter(w) for w in words], bool)
    evidence = np.zeros((len(words) + 1, len(net.languages) + 1))
    evidence[:-1][known] = net.evidence([w for w in words if has_letter(w)])
    # An empty word ends every text, so that no text is without one.
    index = coded.indices.to_numpy()
    ends = np.cumsum(sizes, dtype=np.int64)
    index = np.insert(index, ends, len(words))
    starts = np.concatenate([[0], ends[:-1] + np.arange(1, len(ends))]).astype(np.int64)
    pooled = np.add.reduceat(evidence[index], starts, axis=0)
    count = pooled[:, -1]
    mean = pooled[:, :-1] / np.maximum(count, 1)[:, None]
    p = np.exp(mean - mean.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    best = p.argmax(axis=1)
    names = [net.languages[b] if c else UNKNOWN for b, c in zip(best.tolist(), count.tolist())]
    return names, np.where(count > 0, p.max(axis=1), 0.0)


def identify(docs: DataFrame, how: Training = Training()) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    The network learns on the driver from the bounded sample of ``Training``;
    rows whose crc32(doc_id) mod 5 is 0 are held out of it.  A null doc_id
    counts as the empty text there (held out).  Null and letterless texts are
    ``und``; null languages and ``und`` are not learned from; repeated rows give repeated
    rows; an empty table gives no rows; further columns are ignored.
    """
    rows = training_rows(docs, how)
    found = predict(pick(docs, doc_id="long", text="string"), train(rows, how) if rows else None)
    return found.select("doc_id", (id_crc32(F.col("doc_id")) % 5 == 0).alias("held_out"), "lang_pred", "score")


def without_unknown(docs: DataFrame, how: Training = Training()) -> DataFrame:
    """The documents in whose text a language was found; columns as given (doc_id, text, lang and others).

    Those are the documents that have a letter, also with nothing to learn
    from.  Which language is found, and how probable it is, rejects none; a
    null lang becomes the language found (it stays null where nothing could
    be learned), other values stay as they are.
    """
    rows = training_rows(docs, how)
    if not rows:
        return with_letters(docs)
    found = predict(docs, train(rows, how)).filter(F.col("lang_pred") != UNKNOWN)
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def with_letters(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows whose text has a letter."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([any(map(str.isalpha, t.as_py() or "")) for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
