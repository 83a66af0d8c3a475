"""SentencePiece: the scan and the word store against the library."""

import random

import numpy as np
import pytest

from seriesgraph.llm import pieces
from seriesgraph.llm.queries import vocabulary

TEXTS = ["", None, "a  b", " lead", "trail ", "two  blanks   and    four", "é\n\tq ① 漢字😀", "supercalifragilisticexpialidocious" * 4, "aaaa bbbb  " * 9, "▁raw mark", "x" * 90, "    ", "Hello, world! " * 8, "\x00 nul"]


@pytest.fixture(scope="module")
def path():
    return vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(4)
    noise = ["".join(rng.choice("abcdeinrst  ,.é①\n") for _ in range(rng.randint(1, 300))) for _ in range(40)]
    rows = [*enumerate(TEXTS + noise), (None, "null id"), (3, TEXTS[3])]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(2)


@pytest.mark.parametrize(("giant", "chunk"), [(10**6, 4096), (0, 17), (20, 40)])
def test_ids_equal_the_library(frame, path, giant, chunk):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    got = sorted((str(r.doc_id), bytes(r.ids)) for r in pieces.encode_pieces(frame, path, giant=giant, chunk=chunk).collect())
    assert got == sorted((str(r.doc_id), np.array(sp.encode(r.text or ""), "<u4").tobytes()) for r in frame.collect())


@pytest.mark.parametrize("block", [2, 3])
def test_states_come_down_a_tree(frame, path, monkeypatch, block):
    """Chains of many chunks, multiplied in runs of runs."""
    import sentencepiece

    monkeypatch.setattr(pieces, "BLOCK", block)
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    long = frame.where("length(text) > 100")
    got = sorted((r.doc_id, bytes(r.ids)) for r in pieces.encode_pieces(long, path, giant=0, chunk=17).collect())
    assert got == sorted((r.doc_id, np.array(sp.encode(r.text), "<u4").tobytes()) for r in long.collect())


def test_a_text_beyond_the_default_threshold(spark, path):
    import sentencepiece

    rng = random.Random(6)
    text = " ".join("".join(rng.choice("abcdeinorst") for _ in range(rng.randint(2, 9))) for _ in range(11_500))
    assert len(text) > pieces.GIANT_CHARS
    got = pieces.encode_pieces(spark.createDataFrame([(1, text, "clash")], "doc_id long, text string, ids string"), path).first()
    assert bytes(got.ids) == np.array(sentencepiece.SentencePieceProcessor(model_file=path).encode(text), "<u4").tobytes()


def test_decoding_gives_the_text_back(frame, path):
    decoded = pieces.decode_pieces(pieces.encode_pieces(frame, path, giant=20, chunk=40), path)
    assert sorted((str(r.doc_id), r.text) for r in decoded.collect()) == sorted((str(r.doc_id), (r.text or "").replace("▁", " ") if r.text != "▁raw mark" else " raw mark") for r in frame.collect())


def test_empty(spark, path):
    assert pieces.piece_digest(spark.createDataFrame([], "doc_id long, text string"), path).collect() == []


def test_combination_is_associative(path):
    model = pieces.pieces(path)
    text = pieces.SPACE + "the internationalisation of everything".replace(" ", pieces.SPACE) * 3
    cuts = [0, 30, 55, 80, len(text)]
    m = [pieces.transfer(model, text[max(0, a - 16) : b + 16], min(a, 16), min(a, 16) + b - a, a == 0, b == len(text)) for a, b in zip(cuts, cuts[1:])]
    left = pieces.combine(pieces.combine(m[0], m[1]), pieces.combine(m[2], m[3]))
    right = pieces.combine(m[0], pieces.combine(m[1], pieces.combine(m[2], m[3])))
    assert (left == right).all() and len(left) == 1 and left[0, 2] == len(model.merge(text))
