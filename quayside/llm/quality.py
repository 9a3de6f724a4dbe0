"""A byte-level convolutional network for text quality, in numpy.

A document's UTF-8 bytes are read in frames of ``WIDTH`` bytes, ``STRIDE`` apart, the last one at the very end.
Each frame's byte embeddings go through learned filters. Frames are gathered into overlapping chunks that cover
the whole document; each filter is max-pooled within a chunk, and the chunks of a document are combined by their
mean and their maximum into one logistic unit. All of it, embeddings included, is trained by gradient descent.

Fitting takes a bounded sample of the labelled rows (``per_class`` of each label, by the hash of their id) with
weights that restore the labels' shares. Scoring is one pass over all rows, without a shuffle.

Defined results: a null or empty text is one frame of zero bytes and gets a score like any other; a label that is
null is not used, an id labelled twice has its larger label; without labels of both kinds every score is the
share of label 1 (0.5 without any); other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import hashing as H

WIDTH, STRIDE, EMBED, FILTERS = 8, 4, 6, 24
CHUNK, STEP = 64, 56  # frames of a chunk, and from one chunk to the next


class Net(NamedTuple):
    embed: np.ndarray  # 256, EMBED
    conv: np.ndarray  # WIDTH * EMBED, FILTERS
    bias: np.ndarray  # FILTERS
    head: np.ndarray  # 2 * FILTERS
    shift: np.ndarray  # 1


class Layout(NamedTuple):
    """Frames of some documents (their bytes), the frame bounds of chunks, the chunk bounds of documents."""

    frames: np.ndarray
    first: np.ndarray
    last: np.ndarray
    bounds: np.ndarray


def layout(data: np.ndarray, bounds: np.ndarray) -> Layout:
    size = np.diff(bounds)
    padded = np.concatenate([data, np.zeros(WIDTH, np.uint8)])
    extra = np.maximum(size - WIDTH, 0)
    count = 1 + -(-extra // STRIDE)
    begin = np.cumsum(count) - count
    doc = np.repeat(np.arange(len(size)), count)
    inner = np.minimum((np.arange(len(doc)) - begin[doc]) * STRIDE, extra[doc])
    frames = padded[(bounds[:-1][doc] + inner)[:, None] + np.arange(WIDTH)]
    short = np.flatnonzero(size < WIDTH)
    for d in short:
        frames[begin[d], size[d] :] = 0
    chunks = 1 + -(-np.maximum(count - CHUNK, 0) // STEP)
    c_begin = np.cumsum(chunks) - chunks
    c_doc = np.repeat(np.arange(len(size)), chunks)
    first = begin[c_doc] + (np.arange(len(c_doc)) - c_begin[c_doc]) * STEP
    last = np.minimum(first + CHUNK, (begin + count)[c_doc])
    return Layout(frames, first, last, np.append(c_begin, len(c_doc)))


def pooled(net: Net, lay: Layout) -> np.ndarray:
    """Largest response of each filter in each chunk, before the rectifier."""
    x = net.embed[lay.frames].reshape(len(lay.frames), -1)
    response = np.concatenate([x @ net.conv, np.full((1, FILTERS), -np.inf, np.float32)])
    pairs = np.stack([lay.first, lay.last], axis=1).ravel()
    return np.maximum.reduceat(response, pairs, axis=0)[::2] + net.bias


def combined(chunks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    n = np.diff(bounds)[:, None]
    return np.concatenate([np.add.reduceat(chunks, bounds[:-1], axis=0) / n, np.maximum.reduceat(chunks, bounds[:-1], axis=0)], axis=1)


def scores(net: Net, texts: H.Texts) -> np.ndarray:
    lay = layout(texts.data, texts.bounds)
    features = combined(np.maximum(pooled(net, lay), 0), lay.bounds)
    return 1 / (1 + np.exp(-np.clip((features @ net.head + net.shift).astype(np.float64), -30, 30)))


def _gradients(net: Net, lay: Layout, label: np.ndarray, weight: np.ndarray) -> tuple[Net, float]:
    x = net.embed[lay.frames].reshape(len(lay.frames), -1)
    response = x @ net.conv
    best = np.stack([a + np.argmax(response[a:b], axis=0) for a, b in zip(lay.first, lay.last)])
    raw = np.take_along_axis(response, best, axis=0) + net.bias
    chunks = np.maximum(raw, 0)
    features = combined(chunks, lay.bounds)
    p = 1 / (1 + np.exp(-np.clip(features @ net.head + net.shift, -30, 30)))
    out = (p - label) * weight / weight.sum()
    n = np.diff(lay.bounds)
    doc = np.repeat(np.arange(len(n)), n)
    d_mean, d_max = out[:, None] * net.head[:FILTERS], out[:, None] * net.head[FILTERS:]
    top = chunks == features[doc, FILTERS:]
    ties = np.add.reduceat(top, lay.bounds[:-1], axis=0, dtype=np.float32)
    d_raw = (d_mean / n[:, None])[doc] + np.where(top, (d_max / ties)[doc], 0)
    d_raw = np.where(raw > 0, d_raw, 0).astype(np.float32)
    taken = lay.frames[best]  # chunk, filter, WIDTH
    d_conv = np.einsum("cf,cfk->kf", d_raw, net.embed[taken].reshape(*best.shape, -1), optimize=True)
    d_x = (d_raw[:, :, None] * net.conv.T[None]).reshape(-1, EMBED)
    flat = taken.reshape(-1)
    d_embed = np.stack([np.bincount(flat, d_x[:, e], 256) for e in range(EMBED)], axis=1)
    loss = float(-(weight * (label * np.log(p + 1e-9) + (1 - label) * np.log(1 - p + 1e-9))).sum() / weight.sum())
    return Net(d_embed, d_conv, d_raw.sum(axis=0), out @ features, np.array([out.sum()])), loss


def fit(texts: list[bytes], label: np.ndarray, weight: np.ndarray, steps: int, batch: int, rate: float, seed: int) -> Net:
    rng = np.random.default_rng(seed)
    net = Net(
        rng.normal(0, 0.5, (256, EMBED)).astype(np.float32),
        rng.normal(0, 1 / np.sqrt(WIDTH * EMBED), (WIDTH * EMBED, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
        np.zeros(1, np.float32),
    )
    moment, spread, step = [np.zeros_like(x) for x in net], [np.zeros_like(x) for x in net], 0
    while step < steps:
        order = rng.permutation(len(texts))
        for at in range(0, len(order), batch)[: steps - step]:
            own = order[at : at + batch]
            data = np.frombuffer(b"".join(texts[i] for i in own), np.uint8)
            lay = layout(data, np.append(0, np.cumsum([len(texts[i]) for i in own])))
            grads, _ = _gradients(net, lay, label[own], weight[own])
            step += 1
            for i, (x, g) in enumerate(zip(net, grads)):
                moment[i] = 0.9 * moment[i] + 0.1 * g
                spread[i] = 0.99 * spread[i] + 0.01 * g * g
                x -= (rate * (moment[i] / (1 - 0.9**step)) / (np.sqrt(spread[i] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return net


def train(
    spark: SparkSession,
    documents: DataFrame,
    labels: DataFrame,
    usable: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    per_class: int = 800,
    steps: int = 300,
    batch: int = 32,
    rate: float = 0.01,
    seed: int = 7,
) -> Net | float:
    """The network, or the share of label 1 where there are not both kinds. ``usable`` is a rule on the label table's id."""
    known = labels.where(usable & F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
    known = known.groupBy(F.col(id_col).alias("label_id")).agg(F.max(label_col).cast("int").alias("label"))
    count = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    if len(count) < 2:
        return float(next(iter(count), 0.5))
    parts = [known.where(F.col("label") == x).orderBy(F.xxhash64("label_id"), "label_id").limit(per_class) for x in (0, 1)]
    sample = F.broadcast(parts[0].unionAll(parts[1]))  # 2 * per_class ids at most
    rows = documents.select(F.col(id_col).alias("label_id"), F.col(text_col).cast("string").alias("text")).join(sample, "label_id")
    rows = rows.groupBy("label_id", "label").agg(F.min("text").alias("text")).orderBy("label_id").collect()
    label = np.array([r.label for r in rows], dtype=np.float32)
    if len(set(label.tolist())) < 2:
        return count[1] / (count[0] + count[1])
    share = {x: count[x] / max(1.0, float((label == x).sum())) for x in (0, 1)}
    weight = np.array([share[r.label] for r in rows], dtype=np.float32)
    return fit([(r.text or "").encode() for r in rows], label, weight / weight.mean(), steps, batch, rate, seed)


def _scorer(held):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = held.value
        for batch in batches:
            if isinstance(net, float):
                out = np.full(batch.num_rows, net)
            else:
                out = np.concatenate([scores(net, t) for t in H.slices(batch.column("text"))]) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(batch.num_columns - 1)), pa.array(out)], names=[*batch.schema.names[:-1], "score"])

    return rows


def score(spark: SparkSession, documents: DataFrame, net: Net | float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, score`` for every row."""
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_scorer(spark.sparkContext.broadcast(net)), f"id {dict(rows.dtypes)['id']}, score double")


def keep_good(spark: SparkSession, documents: DataFrame, net: Net | float, text_col: str = "text", least: float = 0.3) -> DataFrame:
    """The rows whose score is ``least`` or more, as they were."""
    # columns by place, so that any names will do; a text goes to a worker once and comes back where it is kept
    flat = documents.select(*[documents[c].alias(f"c{i}") for i, c in enumerate(documents.columns)])
    text, held = f"c{documents.columns.index(text_col)}", spark.sparkContext.broadcast(net)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not isinstance(held.value, float) and batch.num_rows:
                found = np.concatenate([scores(held.value, t) for t in H.slices(batch.column(text))])
                batch = batch.filter(pa.array(found >= least))
            elif isinstance(held.value, float) and held.value < least:
                batch = batch.slice(0, 0)
            yield batch

    kept = flat.mapInArrow(rows, flat.schema)
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(documents.columns)])
