"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

Each word enters as two inputs: an embedding of the word itself and the maximum, channel by channel, over embeddings
of its character 3- to 5-grams (word ends marked). A text is all overlapping windows of its words; a text's score is
that of its worst window, and training follows the same rule: the windows that decide a labelled text are what it
learns from. Texts stream through tasks; nothing is shuffled but the bounded training sample.
"""

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import check_free, small_batches
from .textbytes import ALNUM, batches, join_texts, mix, word_hashes, words

WINDOW = 32
STRIDE = 16
WORD_BUCKETS = 1 << 14
GRAM_BUCKETS = 1 << 16
WORD_DIM = 4
GRAM_DIM = 8
HIDDEN = 8
ATTENTION = 8
GRAMS = (3, 4, 5)

#: Labelled texts to train on, at most, of either label; and the longest of them in characters.
TRAIN_TOXIC = 800
TRAIN_CLEAN = 2_400
TRAIN_CHARS = 20_000
THRESHOLD = 0.3


@dataclass
class Words:
    """The words of some texts: word of every position, first position of each text, and features of distinct words."""

    index: np.ndarray  # position -> distinct word
    first: np.ndarray  # text -> first position, and the count
    bucket: np.ndarray  # distinct word -> word bucket
    grams: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # per n: buckets, first bucket of each word that has some, those words


def read_words(texts: list[str | None]) -> Words:
    data, offsets = join_texts([(t or "").lower() for t in texts])
    starts, ends, first = words(data, offsets, ALNUM)
    hashes = word_hashes(data, starts, ends)
    _, one, index = np.unique(hashes, return_index=True, return_inverse=True)
    s, e = starts[one], ends[one]
    bucket = (hashes[one] >> np.uint64(50)).astype(np.int64) % WORD_BUCKETS
    # All distinct words in a row, each between a mark of its begin and one of its end.
    length = e - s + 2
    begin = np.zeros(len(s) + 1, np.int64)
    np.cumsum(length, out=begin[1:])
    chars = np.zeros(begin[-1], np.uint8)
    if len(s):
        inner = np.ones(begin[-1], bool)
        inner[begin[:-1]] = inner[begin[1:] - 1] = False
        chars[inner] = data[np.repeat(s - (begin[:-1] - 2 * np.arange(len(s))), length - 2) + np.arange(begin[-1] - 2 * len(s))]
        chars[begin[:-1]], chars[begin[1:] - 1] = 1, 2
    grams = []
    codes = chars.astype(np.uint64)
    for n in GRAMS:
        count = np.maximum(length - n + 1, 0)
        have = np.flatnonzero(count)
        count = count[have]
        at = np.zeros(len(have) + 1, np.int64)
        np.cumsum(count, out=at[1:])
        place = np.repeat(begin[have] - at[:-1], count) + np.arange(at[-1])
        h = np.full(len(place), n, np.uint64)
        for k in range(n):
            h = h * np.uint64(257) + codes[place + k]
        grams.append(((mix(h) >> np.uint64(48)).astype(np.int64) % GRAM_BUCKETS, at[:-1], have))
    return Words(index.reshape(-1), first, bucket, grams)


def of_words(ws: Words, chosen: np.ndarray) -> Words:
    """The features of the chosen distinct words, which get the numbers from 0 on; without positions."""
    grams = []
    place = np.full(len(ws.bucket), -1)
    place[chosen] = np.arange(len(chosen))
    for bucket, first, have in ws.grams:
        count = np.diff(np.append(first, len(bucket)))
        keep = place[have] >= 0
        n, begin = count[keep], first[keep]
        at = np.cumsum(n) - n
        grams.append((bucket[np.repeat(begin - at, n) + np.arange(n.sum())], at, place[have[keep]]))
    return Words(np.zeros(0, np.int64), np.zeros(1, np.int64), ws.bucket[chosen], grams)


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first position, number of words, text) of every window; texts of a window's length or less have one."""
    n = np.diff(first)
    count = np.where(n == 0, 0, 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE)))
    text = np.repeat(np.arange(len(n)), count)
    k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    # The last window ends with the text.
    start = np.minimum(k * STRIDE, np.maximum(n[text] - WINDOW, 0))
    return first[text] + start, np.minimum(n[text], WINDOW), text


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Weights, forward pass, gradients."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        d = WORD_DIM + GRAM_DIM
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.w = {"word": draw(WORD_BUCKETS, WORD_DIM, scale=0.05), "gram": draw(GRAM_BUCKETS, GRAM_DIM, scale=0.05)}
        for side in "fb":
            self.w[f"x{side}"] = draw(d, 3 * HIDDEN, scale=0.4)
            self.w[f"h{side}"] = draw(HIDDEN, 3 * HIDDEN, scale=0.3)
            self.w[f"c{side}"] = np.zeros(3 * HIDDEN, np.float32)
        self.w["aw"], self.w["av"] = draw(2 * HIDDEN, ATTENTION, scale=0.4), draw(ATTENTION, scale=0.4)
        self.w["ow"], self.w["oc"] = draw(2 * HIDDEN, scale=0.4), np.zeros(1, np.float32)

    def features(self, ws: Words) -> tuple[np.ndarray, np.ndarray]:
        """(inputs of distinct words, their gram part)."""
        best = np.full((len(ws.bucket), GRAM_DIM), -np.inf, np.float32)
        for bucket, at, have in ws.grams:
            if len(have):
                best[have] = np.maximum(best[have], np.maximum.reduceat(self.w["gram"][bucket], at, axis=0))
        return np.concatenate((self.w["word"][ws.bucket], best), axis=1), best

    def _run(self, xp: np.ndarray, side: str, keep: bool):
        """Hidden states (T, B, H) of inputs xp (T, B, 3H), which are already multiplied."""
        steps, size, _ = xp.shape
        u, h = self.w[f"h{side}"], np.zeros((size, HIDDEN), np.float32)
        out, held = np.empty((steps, size, HIDDEN), np.float32), []
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            hu = h @ u
            gates = sigmoid(xp[t, :, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])
            z, r, un = gates[:, :HIDDEN], gates[:, HIDDEN:], hu[:, 2 * HIDDEN :]
            n = np.tanh(xp[t, :, 2 * HIDDEN :] + r * un)
            if keep:
                held.append((t, h, z, r, un, n))
            h = n + z * (h - n)
            out[t] = h
        return out, held

    def forward(self, projected: dict[str, np.ndarray], at: np.ndarray, length: np.ndarray, keep: bool = False):
        """Logits of windows; projected: per side the distinct words' inputs times weights, at (T, B) their numbers."""
        state = {}
        hs = []
        for side in "fb":
            h, state[side] = self._run(projected[side][at], side, keep)
            hs.append(h)
        h = np.concatenate(hs, axis=2)
        a = np.tanh(h @ self.w["aw"])
        e = a @ self.w["av"]
        if (length < len(at)).any():
            e = np.where(np.arange(len(at))[:, None] < length, e, -1e9)
        p = np.exp(e - e.max(axis=0))
        p /= p.sum(axis=0)
        pooled = np.einsum("tb,tbh->bh", p, h)
        return pooled @ self.w["ow"] + self.w["oc"][0], (state, h, a, p, pooled)

    def project(self, x: np.ndarray) -> dict[str, np.ndarray]:
        """With a row of zeros at the end, for places beyond a short text."""
        x = np.concatenate((x, np.zeros((1, x.shape[1]), np.float32)))
        return {side: x @ self.w[f"x{side}"] + self.w[f"c{side}"] for side in "fb"}

    def gradients(self, ws: Words, at: np.ndarray, length: np.ndarray, target: np.ndarray, weight: np.ndarray) -> dict:
        """Of the weighted cross entropy of windows, and its mean; at: their places(); embeddings' as (rows, values)."""
        used, local = np.unique(at, return_inverse=True)
        local = local.reshape(at.shape)
        real = used[used < len(ws.bucket)]
        ws = of_words(ws, real)
        x, best = self.features(ws)
        pad = x if len(real) == len(used) else np.concatenate((x, np.zeros((1, x.shape[1]), np.float32)))
        projected = {side: pad @ self.w[f"x{side}"] + self.w[f"c{side}"] for side in "fb"}
        logit, (state, h, a, p, pooled) = self.forward(projected, local, length, True)
        d_logit = ((sigmoid(logit) - target) * weight / weight.sum()).astype(np.float32)
        g = {"ow": pooled.T @ d_logit, "oc": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * self.w["ow"]
        d_p = np.einsum("bh,tbh->tb", d_pooled, h)
        d_e = p * (d_p - (p * d_p).sum(axis=0))
        g["av"] = np.einsum("tb,tba->a", d_e, a)
        d_a = d_e[:, :, None] * self.w["av"] * (1 - a * a)
        g["aw"] = np.einsum("tbh,tba->ha", h, d_a)
        d_h = p[:, :, None] * d_pooled + d_a @ self.w["aw"].T
        d_x = np.zeros_like(pad)
        for s, side in enumerate("fb"):
            u, own = self.w[f"h{side}"], d_h[:, :, s * HIDDEN : (s + 1) * HIDDEN]
            d_xp, gu, carry = np.empty((*at.shape, 3 * HIDDEN), np.float32), np.zeros_like(u), 0
            for t, before, z, r, un, n in reversed(state[side]):
                dh = own[t] + carry
                dn = dh * (1 - z) * (1 - n * n)
                dz = dh * (before - n) * z * (1 - z)
                dr = dn * un * r * (1 - r)
                d_hu = np.concatenate((dz, dr, dn * r), axis=1)
                d_xp[t] = np.concatenate((dz, dr, dn), axis=1)
                gu += before.T @ d_hu
                carry = dh * z + d_hu @ u.T
            flat = np.zeros((len(used), 3 * HIDDEN), np.float32)
            np.add.at(flat, local.reshape(-1), d_xp.reshape(-1, 3 * HIDDEN))
            g[f"h{side}"], g[f"x{side}"], g[f"c{side}"] = gu, pad.T @ flat, flat.sum(axis=0)
            d_x += flat @ self.w[f"x{side}"].T
        d_x = d_x[: len(real)]
        g["word"] = _rows(ws.bucket, d_x[:, :WORD_DIM])
        rows, values = [], []
        for bucket, first, have in ws.grams:
            owner = np.repeat(have, np.diff(np.append(first, len(bucket))))
            rows.append(bucket)
            values.append(np.where(self.w["gram"][bucket] == best[owner], d_x[owner, WORD_DIM:], 0))
        g["gram"] = _rows(np.concatenate(rows), np.concatenate(values))
        loss = np.logaddexp(0, np.where(target > 0, -logit, logit)) * weight
        return g | {"loss": float(loss.sum() / weight.sum())}


def _rows(index: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    rows, back = np.unique(index, return_inverse=True)
    out = np.zeros((len(rows), values.shape[1]), np.float32)
    np.add.at(out, back.reshape(-1), values)
    return rows, out


def places(ws: Words, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """(WINDOW, windows) numbers of distinct words; the number after the last stands beyond a short text."""
    t = np.arange(WINDOW)[:, None]
    inside = t < length
    return np.where(inside, ws.index[np.where(inside, start + t, start)], len(ws.bucket))


def window_logits(net: Network, ws: Words, start: np.ndarray, length: np.ndarray, size: int = 4096) -> np.ndarray:
    projected = net.project(net.features(ws)[0])
    out = np.empty(len(start), np.float32)
    for lo in range(0, len(start), size):
        s, n = start[lo : lo + size], length[lo : lo + size]
        out[lo : lo + size] = net.forward(projected, places(ws, s, n), n)[0]
    return out


def text_scores(net: Network | None, base: float, texts: list[str | None]) -> np.ndarray:
    """The probability of each text's worst window; texts without a word get 0. Without a network all get base."""
    if net is None:
        return np.full(len(texts), base)
    out = np.zeros(len(texts))
    for lo, hi in batches(texts):
        ws = read_words(texts[lo:hi])
        start, length, text = windows(ws.first)
        if len(start):
            logits = window_logits(net, ws, start, length)
            begin = np.flatnonzero(np.diff(text, prepend=-1))
            out[lo + text[begin]] = sigmoid(np.maximum.reduceat(logits, begin).astype(np.float64))
    return out


def evidence(ws: Words, target: np.ndarray) -> np.ndarray:
    """For each gram bucket, by how many deviations it is commoner in positive texts than chance has it."""
    text = np.repeat(np.arange(len(target)), np.diff(ws.first))
    pos, total = np.zeros(GRAM_BUCKETS), np.zeros(GRAM_BUCKETS)
    rows = np.unique(text * len(ws.bucket) + ws.index)
    doc, word = rows // len(ws.bucket), rows % len(ws.bucket)
    cut = np.searchsorted(doc, np.arange(0, len(target) + 1, 100)).tolist()
    for bucket, first, have in ws.grams:
        count = np.zeros(len(ws.bucket), np.int64)
        begin = np.zeros(len(ws.bucket), np.int64)
        count[have], begin[have] = np.diff(np.append(first, len(bucket))), first
        for lo, hi in zip(cut, [*cut[1:], len(doc)]):
            d, w = doc[lo:hi], word[lo:hi]
            n = count[w]
            at = np.repeat(begin[w] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            pairs = np.unique(np.repeat(d, n) * GRAM_BUCKETS + bucket[at])
            hits, of = pairs % GRAM_BUCKETS, target[pairs // GRAM_BUCKETS]
            total += np.bincount(hits, minlength=GRAM_BUCKETS)
            pos += np.bincount(hits, weights=of, minlength=GRAM_BUCKETS)
    share = target.mean()
    return (pos - total * share) / np.sqrt(total * share * (1 - share) + 1)


def train(texts: list[str], target: np.ndarray, rounds: int = 5, passes: int = 2, batch: int = 128, seed: int = 5) -> Network:
    """Rounds of: find the windows that decide each text, then learn from them for some passes (Adam)."""
    rng = np.random.default_rng(seed)
    net, ws = Network(), read_words(texts)
    target = target.astype(np.float32)
    start, length, text = windows(ws.first)
    # A warm start: one channel of the grams begins as their evidence.
    net.w["gram"][:, 0] = np.clip(evidence(ws, target) / 4, -1, 3).astype(np.float32)
    x, _ = net.features(ws)
    strong = np.concatenate((x[:, WORD_DIM], [-1.0])).astype(np.float32)
    score = np.concatenate([np.partition(strong[places(ws, start[i : i + 8192], length[i : i + 8192])], WINDOW - 2, axis=0)[-2:].sum(axis=0) for i in range(0, len(start), 8192)])
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.w.items()}
    step, rate, total = 0, 0.02, rounds * passes
    done, hard = 0, np.zeros(0, np.int64)
    balance = np.where(target > 0, 1.0, max(1.0, target.sum()) / max(1.0, (1 - target).sum()) * 2).astype(np.float32)
    for turn in range(rounds):
        if turn:
            score = window_logits(net, ws, start, length)
        order = np.lexsort((-score, text))
        rank = np.arange(len(order)) - np.searchsorted(text[order], text[order])
        toxic = target[text[order]] > 0
        # Toxic texts: the window that decides now. Clean ones: every window that ever came close to deciding.
        hard = np.union1d(hard, order[~toxic & (rank < 2)])
        chosen = np.concatenate((order[toxic & (rank < 1)], hard))
        where = places(ws, start[chosen], length[chosen])
        used, local = np.unique(where, return_inverse=True)
        few, local = of_words(ws, used[used < len(ws.bucket)]), local.reshape(where.shape)
        for _ in range(passes):
            turns = rng.permutation(len(chosen))
            for lo in range(0, len(chosen), batch):
                some = turns[lo : lo + batch]
                pick = chosen[some]
                g = net.gradients(few, local[:, some], length[pick], target[text[pick]], balance[text[pick]])
                step += 1
                eta = rate * (1 - 0.9 * done / total) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                for k, v in g.items():
                    if k == "loss":
                        continue
                    rows, v = v if isinstance(v, tuple) else (slice(None), v)
                    m, s = moment[k]
                    m[rows] = 0.9 * m[rows] + 0.1 * v
                    s[rows] = 0.999 * s[rows] + 0.001 * v * v
                    net.w[k][rows] -= eta * m[rows] / (np.sqrt(s[rows]) + 1e-8)
            done += 1
    return net


def held_out(id_col: str = "doc_id"):
    """Rows kept out of training: crc32 of the id as text leaves 2 on division by 4."""
    return F.coalesce(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, toxic: int = TRAIN_TOXIC, clean: int = TRAIN_CLEAN, chars: int = TRAIN_CHARS) -> DataFrame:
    """doc_id, toxic, text of at most 4/3 so many toxic and clean rows, the first by a hash of the id, none held out.

    A text labelled in several rows is toxic if one says so. Texts above chars characters aren't trained on.
    """
    one = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic") > 0).alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    # A third more than wanted, for labelled rows without a document or with a text that is too long.
    some = one.where("toxic").orderBy(*order).limit(toxic * 4 // 3).unionByName(one.where("not toxic").orderBy(*order).limit(clean * 4 // 3))
    # At most 4/3 of the two bounds in rows of two short columns: small enough to broadcast at any size of input.
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.length("text").between(1, chars)).join(F.broadcast(some), "doc_id")
    return found.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def _chosen(rows: pd.DataFrame, toxic: int, clean: int) -> tuple[list[str], np.ndarray]:
    rows = rows.sort_values("doc_id")
    is_toxic = rows["toxic"].astype(bool)
    rows = pd.concat([rows[is_toxic].head(toxic), rows[~is_toxic].head(clean)])
    return rows["text"].tolist(), rows["toxic"].to_numpy(dtype=float)


def training_sample(docs: DataFrame, labels: DataFrame, toxic: int = TRAIN_TOXIC, clean: int = TRAIN_CLEAN) -> tuple[list[str], np.ndarray]:
    """(texts, labels) that learned() trains on, for a look at them: here they come to the driver."""
    return _chosen(training_rows(docs, labels, toxic, clean).toPandas(), toxic, clean)


def learned(docs: DataFrame, labels: DataFrame, toxic: int = TRAIN_TOXIC, clean: int = TRAIN_CLEAN) -> bytes:
    """The pickled (network or None, share of toxic labels), learned in one task from the bounded sample.

    Neither the texts nor what training holds come to the driver, only the weights.
    """

    def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = list(frames)
        if not held:
            return
        texts, target = _chosen(pd.concat(held), toxic, clean)
        net = train(texts, target) if len(target) and 0 < target.mean() < 1 else None
        yield pd.DataFrame({"model": [pickle.dumps((net, float(target.mean()) if len(target) else 0.0))]})

    model = training_rows(docs, labels, toxic, clean).coalesce(1).mapInPandas(learn, "model binary").first()
    return bytes(model["model"]) if model else pickle.dumps((None, 0.0))


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, toxic: int = TRAIN_TOXIC, clean: int = TRAIN_CLEAN, names: tuple[str, str, str] = ("held_out", "score", "predicted")) -> DataFrame:
    """All columns of docs plus those of names: held_out, score (0 to 1) and predicted (1 from threshold on).

    docs: doc_id, text; labels: doc_id, toxic. Only the text enters a score; null and empty texts and those without a
    letter or digit get 0. Without labels of both kinds every text with or without words gets the share of toxic
    labels (0 if there are none). Repeated rows get equal scores; an empty table gives no rows. Where
    docs has a column of one of the names, other names must be given; none is overwritten.
    """
    check_free(names, docs.columns)
    held, value, decided = names
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(learned(docs, labels, toxic, clean))  # a few MB of weights, whatever the input

    def score(frames: Iterator[pd.Series]) -> Iterator[pd.Series]:
        net, base = pickle.loads(shared.value)
        for texts in frames:
            yield pd.Series(text_scores(net, base, texts.tolist()))

    score = F.pandas_udf(score, "double")
    scored = docs.withColumn(value, score("text"))
    return scored.withColumn(held, held_out()).withColumn(decided, (F.col(value) >= threshold).cast("int"))
