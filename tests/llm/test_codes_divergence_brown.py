"""Vector codes, source divergence and class-based scores against plain loops, on rows with nulls, ties and repeats."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesgraph.llm import brown, codes, divergence, textbytes
from seriesgraph.llm.textbytes import FOLD_TERMS, FOLD_WORDS, split_words


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("fold, pattern", [(FOLD_WORDS, r"[^\x20\x09-\x0D]+"), (FOLD_TERMS, r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")])
def test_split_words(fold, pattern):
    for text in ["", None, "Éa b-C_d\x1fe f g 漢字😀x9y", "\n\t A", "@[`{ aZ zA", "word " * 50 + "x" * 500]:
        for size in (1, 7, 1 << 20):
            got = [w.decode() for part in split_words(text, fold, size) for w in part]
            assert got == re.findall(pattern, lower(text))


# Vector codes


def brute_codes(rows, parts, entries, rounds):
    kept = [(i, [math.floor(256 * float(x)) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    out, errors = [], defaultdict(int)
    for dim in sorted({len(r[1]) for r in kept}):
        own = [r for r in kept if len(r[1]) == dim]
        width = max(1, -(-dim // parts))
        cut = lambda v: [v[p * width : (p + 1) * width] for p in range(parts)]
        books = [[cut(r[1])[p] for r in own[:entries]] for p in range(parts)]
        near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))
        for _ in range(rounds):
            for p in range(parts):
                groups = defaultdict(list)
                for r in own:
                    x = cut(r[1])[p]
                    groups[near(x, books[p])[1]].append(x)
                books[p] = [[sum(c) // len(groups[k]) for c in zip(*groups[k])] if k in groups else e for k, e in enumerate(books[p])]
        digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
        for i, v, lab in own:
            found = [near(x, books[p]) for p, x in enumerate(cut(v))]
            error = sum(f[0] for f in found)
            errors[lab] += error
            out.append((i, "".join(f"{f[1]:02x}" for f in found), error, lab, digest))
    return sorted(((i, c, e, errors[lab], d) for i, c, e, lab, d in out), key=str)


def vector_rows(seed=0, n=90, dim=8):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([-1.5, -0.3, 0.1, 0.25, rng.uniform(-1, 1)]) for _ in range(dim)], rng.choice([None, 1, 2])) for i in rng.sample(range(1000), n)]
    return rows + rows[:3] + [(None, rows[0][1], 1), (5000, None, 1), (5001, [None] * dim, 1), (5002, [float("nan")] * dim, None), (5003, [float("inf")] * dim, 2), (5004, [], 2), (5005, [0.5, -0.5, 0.25], None), (5006, [0.4, -0.5, 0.2], 1), (rows[4][0], [9.0] * dim, 2)]


@pytest.mark.parametrize("entries, block", [(64, 4096), (5, 7), (200, 3)])
def test_vector_codes(spark, monkeypatch, entries, block):
    monkeypatch.setattr(codes, "BLOCK", block)
    rows = vector_rows()
    frame = spark.createDataFrame([(*r, "clash", 0) for r in rows], "vec_id long, embedding array<double>, label int, code string, error int").repartition(3)
    got = sorted(map(tuple, codes.compress_vectors(frame, parts=4, entries=entries).collect()), key=str)
    assert got == brute_codes(rows, 4, entries, 2)


def test_vector_codes_empty_and_too_large(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert codes.compress_vectors(spark.createDataFrame([], schema)).collect() == []
    assert codes.compress_vectors(spark.createDataFrame([(1, None, None)], schema)).collect() == []
    with pytest.raises(Exception, match="do not fit"):
        codes.compress_vectors(spark.createDataFrame([(1, [1e30], 1)], schema)).collect()


# Source divergence


def brute_audit(rows, least, k):
    rows = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text))) for lang, source, text in rows]
    out = []
    for lang in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == lang]
        docs = Counter(t for r in own for t in set(r[2]))
        kept = sorted(t for t in docs if docs[t] >= least)
        share = lambda n, total: 1 + 10**9 * (n + 2) // (total + 2 * len(kept))
        f = lambda p, q: (p - q) ** 2 // (p + q)
        counts = {s: Counter(t for r in own if r[1] == s for t in r[2] if t in set(kept)) for s in {r[1] for r in own}}
        every = sum(counts.values(), Counter())
        p = {s: {t: share(c[t], sum(c.values())) for t in kept} for s, c in counts.items()}
        q = {t: share(every[t], sum(every.values())) for t in kept}
        for s in counts:
            pair = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in counts if o != s]
            term = [(t, f(p[s][t], q[t])) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, items in (("pair", pair), ("term", term)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, n + 1) for n, (i, v) in enumerate(ranked) if part == "pair" or n < k]
    return sorted(out)


def audit_rows(seed=1):
    rng = random.Random(seed)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)] + ["É", "é", "漢字", "😀", "Ab"]
    rows = []
    for i in range(160):
        lean = rng.randrange(7)
        text = rng.choice([" ", "-", "9\n"]).join(rng.choice(words[lean * 15 :] + words[:20] * 3) for _ in range(rng.choice([0, 3, 40])))
        rows.append((rng.choice(["en", "en", "de", None]), f"src{lean}" if lean else None, text))
    return rows + rows[:8] + [("xx", "only", "a b"), ("yy", "a", None), ("yy", "b", ""), ("en", "giant", "wac " * 3000), ("en", "none", "123 !")]


@pytest.mark.parametrize("tile, tile_terms, fanin, held", [(32, 8192, 32, 400_000), (2, 9, 2, 5)])
def test_source_divergence(spark, monkeypatch, tile, tile_terms, fanin, held):
    for name, value in {"FANIN": fanin, "HELD": held}.items():
        monkeypatch.setattr(divergence, name, value)
    monkeypatch.setattr(divergence.pair_divergence, "__defaults__", (tile, tile_terms))
    rows = audit_rows()
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], "lang string, source string, text string, term string, value int").repartition(5)
    got = sorted((r.lang, r.source, r.part, r["item"], r.value, r["rank"]) for r in divergence.audit_sources(frame, least_docs=6, terms=4).collect())
    assert got == brute_audit(rows, 6, 4)


def test_source_divergence_empty(spark):
    assert divergence.audit_sources(spark.createDataFrame([], "lang string, source string, text string")).collect() == []


def test_skyband():
    rng = np.random.default_rng(2)
    for n, most, k in [(0, 5, 1), (1, 5, 1), (300, 4, 3), (700, 50, 10), (500, 1, 7)]:
        a, b = rng.integers(0, most + 1, n), rng.integers(0, most + 1, n)
        want = [sum(a[j] >= a[i] and b[j] <= b[i] for j in range(i)) < k for i in range(n)]
        assert divergence.skyband(a, b, k, block=64).tolist() == want


def test_skybands_pass_on_what_they_cannot_hold(spark):
    rows = [("en", f"s{i % 3}", f"t{i:04}", i % 17 + 1, i % 23 + 20) for i in range(4000)]
    frame = spark.createDataFrame(rows, "lang string, source string, term string, n long, lang_n long").repartition(3)
    few = divergence._skybands(frame, 2).collect()
    all_of = divergence._skybands(frame, 2, most=10)
    assert len(few) < 1000 and {r.term for r in few} <= {r.term for r in all_of.collect()}


def test_share_is_exact(spark):
    cases = [(0, 0, 1), (7, 10, 3), (4 * 10**14, 9 * 10**14, 10**6), (0, 9 * 10**14, 10**6)]
    frame = spark.createDataFrame(cases, "n long, total long, kinds long")
    got = [r[0] for r in frame.select(divergence.share(F.col("n"), F.col("total"), F.col("kinds"))).collect()]
    assert got == [1 + 10**9 * (n + 2) // (t + 2 * k) for n, t, k in cases]


# Scores by word classes


def lm_rows(seed=3, n=150):
    rng = random.Random(seed)
    a, b = [f"a{i}" for i in range(30)], [f"b{i}" for i in range(30)]
    rows = []
    for i in range(n):
        text = []
        for _ in range(rng.randrange(1, 40)):
            text += [rng.choice(a), rng.choice(b)]
            if rng.random() < 0.1:
                text.append(f"rare{rng.randrange(60)}")
        rows.append((i, rng.choice([" ", "\n", "  "]).join(text).title()))
    return rows + [(n, None), (n + 1, ""), (n + 2, "  \t"), (n + 3, "é 漢字  x"), (None, "no id a1 b2"), (3, rows[3][1]), (n + 4, "zzz " * 4000)]


def tokens_of(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower(text)), ""]


def is_held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1


def plain_scores(rows, class_of, bar):
    """class_of: word -> class of the words with one; all others are in class 1."""
    train = Counter(t for i, text in rows if not is_held(i) for t in tokens_of(text))
    n, kinds = sum(train.values()), len(train)
    known = lambda t: t == "" or train[t] >= bar
    cls = lambda t: 0 if t == "" else class_of[t] if known(t) else 1
    three = Counter()
    for i, text in rows:
        if not is_held(i):
            c = [0, 0, *map(cls, tokens_of(text))]
            three.update(zip(c, c[1:], c[2:]))
    two, one, ctx2, ctx1 = Counter(), Counter(), Counter(), Counter()
    for (x, y, z), m in three.items():
        two[y, z] += m
        one[z] += m
        ctx2[x, y] += m
        ctx1[y] += m
    size, members = Counter(), Counter({1: 1})
    for t, m in train.items():
        size[cls(t)] += m
        members[cls(t)] += 1
    alpha, used = brown.PRIOR, len({0, 1, *class_of.values()})

    def chain(x, y, z):
        p1 = (one[z] + 0.5) / (n + 0.5 * used)
        p2 = (two[y, z] + alpha * p1) / (ctx1[y] + alpha)
        return (three[x, y, z] + alpha * p2) / (ctx2[x, y] + alpha)

    def prob(x, y, t):
        z = cls(t)
        alone = (train[t] + 0.5) / (n + 0.5 * (kinds + 1))
        return brown.TRUST * chain(x, y, z) * (train[t] + 0.5) / (size[z] + 0.5 * members[z]) + (1 - brown.TRUST) * alone

    out = []
    for i, text in rows:
        words = tokens_of(text)
        c = [0, 0, *map(cls, words)]
        score = sum(math.log10(prob(c[k], c[k + 1], t)) for k, t in enumerate(words))
        base = sum(math.log10((train[t] + 0.5) / (n + 0.5 * (kinds + 1))) for t in words)
        out.append((i, is_held(i), len(words), sum(train[t] > 0 for t in words), n, round(base, 6), round(score, 6)))
    total = sum(prob(0, 1, t) for t in [*train, "never seen"])
    return sorted(out, key=str), total


@pytest.mark.parametrize("frequent, least", [(1 << 17, 5), (40, 5)])
def test_brown_scores_equal_a_plain_loop(spark, monkeypatch, frequent, least):
    monkeypatch.setattr(brown, "HELD", 50)
    monkeypatch.setattr(brown, "HELD_TOKENS", 500)
    rows = lm_rows()
    frame = spark.createDataFrame([(*r, 0, "clash") for r in rows], "doc_id long, text string, score int, word string").repartition(4)
    train = Counter(t for i, text in rows if not is_held(i) for t in tokens_of(text))
    bar = max(least, -(-sum(train.values()) // frequent))
    order = sorted((t for t in train if t and train[t] >= bar), key=lambda t: (-train[t], t))
    kept = {}

    def fixed(contexts, words, *rest):
        kept["words"], kept["contexts"] = words, contexts.collect()
        return np.array([0, 1, *(2 + k % 6 for k in range(len(order)))])

    monkeypatch.setattr(brown, "cluster", fixed)
    got = brown.score_texts(frame, classes=8, frequent=frequent, least=least).collect()
    want, total = plain_scores(rows, {t: 2 + k % 6 for k, t in enumerate(order)}, bar)
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got), key=str) == want
    assert abs(total - 1) < 1e-9
    # The rows of neighbours are the counts of neighbours.
    number = {"": 0, **{t: k + 2 for k, t in enumerate(order)}}
    pairs = Counter()
    for i, text in rows:
        if not is_held(i):
            ids = [0, *(number.get(t, 1) for t in tokens_of(text))]
            pairs.update(zip(ids, ids[1:]))
    assert kept["words"] == len(order) + 2
    read = lambda x, kind: np.frombuffer(x, kind).tolist()
    assert Counter({(r["word"], o): n for r in kept["contexts"] for o, n in zip(read(r.right, np.int32), read(r.right_n, np.int64))}) == pairs
    assert Counter({(o, r["word"]): n for r in kept["contexts"] for o, n in zip(read(r.left, np.int32), read(r.left_n, np.int64))}) == pairs


def test_brown_contexts_are_merged_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(brown, "FANIN", 2)
    rows = [(i, False, f"x{i % 3} y x1") for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, held_out boolean, text string").repartition(7)
    encoded = brown.encode_words(frame, [b"x0", b"x1", b"x2", b"y"])
    got = {(r["word"], int(o)): int(n) for r in brown.word_contexts(encoded, 6).collect() for o, n in zip(np.frombuffer(r.right, np.int32), np.frombuffer(r.right_n, np.int64))}
    assert got[(5, 3)] == 40 and got[(0, 2)] == 14 and got[(3, 0)] == 40 and got[(3, 5)] == 13


def test_exchange_gain_is_the_change_of_likelihood():
    rng = np.random.default_rng(5)
    words, classes = 12, 5
    pairs = rng.integers(0, 6, (words, words)).astype(float)
    at = rng.integers(0, classes, words)

    def table(at):
        member = np.zeros((words, classes))
        member[np.arange(words), at] = 1
        return member.T @ pairs @ member, member

    c, member = table(at)
    for w in range(words):
        own = pairs[w, w]
        left, right = pairs[:, w] @ member, pairs[w] @ member
        left[at[w]] -= own
        right[at[w]] -= own
        gain = brown.gains(brown.without(c, at[w], left, right, own), left, right, own)
        moved = [brown.likelihood(table(np.where(np.arange(words) == w, k, at))[0]) for k in range(classes)]
        assert np.allclose(gain - gain[0], np.array(moved) - moved[0])


@pytest.mark.parametrize("seeds", [1024, 10])
def test_brown_classes_part_words_and_lower_perplexity(spark, seeds):
    rows = lm_rows(n=400)
    got = brown.score_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), classes=6, seeds=seeds).collect()
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.2 * sum(r.n_tokens for r in held)
    assert all(abs(r.perplexity - 10 ** (-r.score / r.n_tokens)) < 1e-6 * r.perplexity for r in got)


def test_brown_numbers_follow_the_broadcast():
    class Shared:
        def __init__(self, value):
            self.value = value

    for _ in range(50):  # a freed object's place may be taken by the next one
        for words in ([b"a"], [b"b", b"a"]):
            assert brown._numbers(Shared(words)) == {w: i + 2 for i, w in enumerate(words)}


def test_brown_without_rows_or_training_texts(spark):
    schema = "doc_id long, text string"
    assert brown.score_texts(spark.createDataFrame([], schema)).collect() == []
    held = next(i for i in range(100) if is_held(i))
    (r,) = brown.score_texts(spark.createDataFrame([(held, "a b a")], schema)).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (4, 0, 0) and abs(r.base_score) < 1e-9 and abs(r.score) < 1e-9


def test_fold_tables_cover_all_bytes():
    assert len(FOLD_WORDS) == len(FOLD_TERMS) == 256 and textbytes.FOLD_TERMS[0x5B] == 32 and FOLD_WORDS[0x5B] == 0x5B
