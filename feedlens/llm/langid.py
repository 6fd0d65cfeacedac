"""Language ID with a byte convolutional network trained in numpy.

Bytes are embedded, filters of several widths slide over them, each filter's
largest response goes through a rectifier into a softmax. Texts are cut
into windows of fixed length that overlap by the widest filter less one, so
every position of every text is seen; a text's class probabilities are the
mean over its windows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.llm.common import crc_bucket, without

WIDTHS, FILTERS, EMBED, LENGTH = (2, 3, 4), 16, 8, 256
UNDETERMINED = "und"
#: The classifier is fitted on at most so many windows, one per document, spread evenly over the languages.
SAMPLE_WINDOWS = 6000


@dataclass
class ByteNet:
    langs: list[str]
    embed: np.ndarray  # 256 x EMBED
    conv: np.ndarray  # widest x EMBED x filters, zero beyond a filter's width
    bias: np.ndarray
    out: np.ndarray  # filters x langs
    out_bias: np.ndarray

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Responses to byte pairs: the convolution is linear in the bytes, so two look-ups give a position's responses."""
        p = np.einsum("be,kef->kbf", self.embed, self.conv).astype(np.float32)
        return tuple((p[k][:, None, :] + p[k + 1][None, :, :]).reshape(65_536, -1) for k in (0, 2))

    def pooled(self, windows: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """windows: n x (LENGTH + 3) bytes -> the largest response of each filter."""
        pairs = windows[:, :-1].astype(np.int32) * 256 + windows[:, 1:]
        n, m = len(windows), windows.shape[1] - 3
        got = np.take(tables[0], pairs[:, :m].ravel(), axis=0, mode="clip")
        got += np.take(tables[1], pairs[:, 2:m + 2].ravel(), axis=0, mode="clip")
        return got.reshape(n, m, -1).max(axis=1)

    def probabilities(self, pooled: np.ndarray) -> np.ndarray:
        z = np.maximum(pooled + self.bias, 0) @ self.out + self.out_bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def cut_windows(texts: list[bytes], length: int = LENGTH, overlap: int = max(WIDTHS) - 1) -> tuple[np.ndarray, np.ndarray]:
    """(n x (length + overlap) zero-padded windows, index of each window's text); no text is skipped or shortened."""
    sizes = np.array([len(t) for t in texts], np.int64)
    count = np.maximum(1, -(-sizes // length))
    owner = np.repeat(np.arange(len(texts)), count)
    buffer = np.frombuffer(b"".join(texts) + bytes(length + overlap), np.uint8)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(texts) else np.zeros(0, np.int64)
    inner = (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)) * length
    ends = starts[owner] + sizes[owner]
    at = (starts[owner] + inner)[:, None] + np.arange(length + overlap)[None, :]
    return np.where(at < ends[:, None], buffer[np.minimum(at, len(buffer) - 1)], 0).astype(np.uint8), owner


def train(samples: list[tuple[bytes, str]], epochs: int = 6, batch: int = 64, rate: float = 4e-3, seed: int = 7) -> ByteNet | None:
    """Adam on cross-entropy. A third of the windows is cut short at random, so short texts are learned too."""
    langs = sorted({lang for _, lang in samples})
    if not langs:
        return None
    rng, widest, filters = np.random.default_rng(seed), max(WIDTHS), FILTERS * len(WIDTHS)
    held = np.repeat(np.array(WIDTHS), FILTERS)
    inside = (np.arange(widest)[:, None, None] < held[None, None, :]).astype(np.float32)
    net = ByteNet(langs, rng.normal(0, 0.5, (256, EMBED)).astype(np.float32),
                  (rng.normal(0, 0.25, (widest, EMBED, filters)) * inside).astype(np.float32), np.zeros(filters, np.float32),
                  rng.normal(0, 0.2, (filters, len(langs))).astype(np.float32), np.zeros(len(langs), np.float32))
    net.embed[0] = 0
    params = [net.embed, net.conv, net.bias, net.out, net.out_bias]
    m, v, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    label = {lang: i for i, lang in enumerate(langs)}
    y = np.array([label[lang] for _, lang in samples])
    texts = [t[: int(rng.integers(8, LENGTH))] if rng.random() < 1 / 3 else t[:LENGTH] for t, _ in samples]
    x = np.zeros((len(texts), LENGTH + widest - 1), np.uint8)
    for i, t in enumerate(texts):
        x[i, : len(t)] = np.frombuffer(t, np.uint8)
    for _ in range(max(epochs, -(-600 * batch // len(x)) if len(x) < 100 * batch else epochs)):
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // batch)):
            w, n = x[rows], len(rows)
            e = net.embed[w]
            cols = np.lib.stride_tricks.sliding_window_view(e, widest, axis=1).transpose(0, 1, 3, 2)  # n, LENGTH, widest, EMBED
            cols = np.ascontiguousarray(cols).reshape(n * LENGTH, widest * EMBED)
            z = (cols @ net.conv.reshape(-1, filters)).reshape(n, LENGTH, filters)
            best = z.argmax(axis=1)
            pooled = np.take_along_axis(z, best[:, None, :], axis=1)[:, 0]
            hidden = np.maximum(pooled + net.bias, 0)
            p = net.probabilities(pooled)
            p[np.arange(n), y[rows]] -= 1
            d_out, d_bias2 = hidden.T @ p / n, p.mean(axis=0)
            g = (p @ net.out.T) * (hidden > 0) / n  # n, filters
            patch = cols[(np.arange(n)[:, None] * LENGTH + best).ravel()].reshape(n, filters, widest, EMBED)
            d_conv = np.einsum("nf,nfke->kef", g, patch, optimize=True) * inside
            d_patch = np.einsum("nf,kef->nfke", g, net.conv, optimize=True)
            seen = w[np.arange(n)[:, None, None], best[:, :, None] + np.arange(widest)]
            d_embed = np.zeros_like(net.embed)
            np.add.at(d_embed, seen.ravel(), d_patch.reshape(-1, EMBED))
            d_embed[0] = 0
            step += 1
            for k, (param, d) in enumerate(zip(params, (d_embed, d_conv, g.sum(axis=0), d_out, d_bias2))):
                m[k] = 0.9 * m[k] + 0.1 * d
                v[k] = 0.999 * v[k] + 0.001 * d * d
                param -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def fit(labelled: DataFrame, windows: int = SAMPLE_WINDOWS, seed: int = 7) -> ByteNet | None:
    """A network fitted on (text, lang): one window of each of at most ``windows`` distinct texts, up to the same number per language.

    Rows with a null text or lang teach nothing. Every language has a window at least, so
    ``windows`` must be as many as the languages; of more, the most frequent are learned. The sample is chosen by a hash
    of the text, so reruns agree; a few megabytes reach the driver."""
    rows = labelled.where("lang is not null and text is not null").where(F.col("text").rlike(r"\p{L}"))
    h = F.xxhash64("text", F.lit(seed))
    counts = (rows.groupBy("lang", h.alias("h")).agg(F.count("*").alias("n")).groupBy("lang")  # copies of a text have one hash
              .agg(F.sum("n").alias("n"), F.count("*").alias("texts")).orderBy(F.desc("n"), "lang").limit(windows).collect())
    if not counts:
        return None
    each = windows // len(counts)
    piece = F.substring("text", (F.pmod(h, F.greatest(F.length("text") - LENGTH + 1, F.lit(1))) + 1).cast("int"), F.lit(LENGTH))
    parts = 1 << 30  # about three times what is needed passes by hash, so that what is sorted does not grow with the rows
    passing = labelled.sparkSession.createDataFrame([(r["lang"], min(parts, (3 * each + 20) * parts // r["texts"] + 1)) for r in counts],
                                                    "lang string, _passing long")  # a row per language, ``windows`` at most
    cut = (rows.select("lang", "text").join(F.broadcast(passing), "lang").where(F.pmod(h, F.lit(parts)) < F.col("_passing"))
           .select("lang", h.alias("h"), piece.alias("piece")).distinct())  # copies of a text count once
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("h", "piece"))
    sample = cut.withColumn("nth", nth).where(F.col("nth") <= each).orderBy("lang", "nth")
    return train([(r["piece"].encode("utf-8", "surrogatepass"), r["lang"]) for r in sample.select("piece", "lang").collect()])


def _classify(batches: Iterator[pa.RecordBatch], net: ByteNet | None, step: int = 48) -> Iterator[pa.RecordBatch]:
    tables = net.tables() if net else None
    for b in batches:
        texts = b.column(b.num_columns - 1)
        lang, score = [UNDETERMINED] * b.num_rows, np.zeros(b.num_rows)
        todo = [i for i in range(b.num_rows) if net and texts[i].is_valid]
        at = 0
        while at < len(todo):  # a bounded number of bytes at a time
            group, size = [], 0
            while at < len(todo) and (not group or size < 1 << 20):
                group.append(todo[at])
                size += len(texts[todo[at]].as_py())
                at += 1
            windows, owner = cut_windows([texts[i].as_py().encode("utf-8", "surrogatepass") for i in group])
            p = np.concatenate([net.probabilities(net.pooled(windows[k:k + step], tables)) for k in range(0, len(windows), step)])
            mean = np.stack([np.bincount(owner, p[:, c], len(group)) for c in range(p.shape[1])], axis=1)
            mean /= np.bincount(owner, minlength=len(group))[:, None]
            for i, row in zip(group, mean):
                c = int(row.argmax())
                lang[i], score[i] = net.langs[c], min(1.0, float(row[c]))
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(lang, pa.string()), pa.array(score)],
                                         [*b.schema.names[:-1], "lang_pred", "score"])


def keep_known(docs: DataFrame, net: ByteNet | None) -> DataFrame:
    """The rows of ``docs`` that get a language, with all their columns; without anything learned, all with a letter."""
    if net is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    named = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # names of its own, whatever the input's
    at = docs.columns.index("text")
    rows = identify(named.withColumn("text", F.col(f"c{at}")), net, named.columns).where(F.col("lang_pred") != UNDETERMINED)
    return rows.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def identify(docs: DataFrame, net: ByteNet | None, keep: list[str]) -> DataFrame:
    """The kept columns, lang_pred and score of every row of ``docs``.

    lang_pred is a learned language (ties: the first in code point order) and
    score its mean probability; a text that is null or has no letter gets
    'und' and 0, and so does every text if nothing was learned. Only the text
    enters a prediction, the whole of it. Repeated rows repeat; an empty table gives an empty
    result; kept columns named like an added one are replaced."""
    kept = without(docs.select(*[F.col(f"`{c}`") for c in keep]), "lang_pred", "score").columns
    schema = docs.select(*[F.col(f"`{c}`") for c in kept]).schema
    spec = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in schema), "lang_pred string", "score double"])
    lettered = F.when(F.col("text").rlike(r"\p{L}"), F.col("text")).alias("_lettered_text")
    return docs.select(*[F.col(f"`{c}`") for c in kept], lettered).mapInArrow(lambda bs: _classify(bs, net), spec)


def held_out(doc_id: Column) -> Column:
    return crc_bucket(doc_id, 4) == 2
