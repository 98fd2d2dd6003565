import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from orebed.llm import sentencepieces as sp

from .helpers import docs, prose

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return sp.PieceModel(PATH)


def texts():
    rng = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "a", "the", "é", "中文", "😀", "①", "<s>", "▁", "theaoning", "x" * 40, "\x00"]
    return [None, "", " "] + ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(150)] + [prose(rng, 2000)]


def best(model, text):
    """(score, ids) over all segmentations, with whole-text tables."""
    n = len(text)
    score, back = [0.0] + [None] * n, [0] * (n + 1)
    for at in range(n):
        for end in range(at + 1, min(n, at + model.longest) + 1):
            found = model.pieces.get(text[at:end])
            gain = found[1] if found else model.unknown_score if end == at + 1 else None
            if gain is not None and (score[end] is None or score[at] + gain > score[end]):
                score[end], back[end] = score[at] + gain, at
    out = []
    while n:
        out, n = model._ids(text[back[n] : n]) + out, back[n]
    return out


def test_stream_finds_the_best_segmentation(model):
    for text in texts():
        marked = sp.MARK + text.replace(" ", sp.MARK) if text else ""
        want = best(model, marked)
        parts = list(model.stream(marked))
        assert sum(parts, []) == want
        assert np.frombuffer(model.encode([text])[0], "<u4").tolist() == want
    assert len(list(model.stream(sp.MARK + prose(random.Random(1), 500).replace(" ", sp.MARK)))) > 50


def test_no_better_segmentation_from_the_library(model):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(open(PATH, "rb").read())
    proto.trainer_spec.model_type = 1  # the same pieces, searched as a unigram lattice
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    total = lambda ids: sum(model.pieces[library.id_to_piece(i)][1] for i in ids)
    rng, same = random.Random(2), 0
    for _ in range(500):
        word = "".join(rng.choice(["the", "ing", "on", "a", "re", "t", "h", "est", "q"]) for _ in range(rng.randrange(1, 6)))
        mine, theirs = np.frombuffer(model.encode([word])[0], "<u4").tolist(), library.encode(word)
        assert total(mine) >= total(theirs)
        same += mine == theirs
    assert same > 350


def test_round_trip(spark):
    given = texts()
    table = docs(spark, given + [None], [*range(len(given)), None]).selectExpr("*", "1 AS ids")
    rows = sp.encode(table, PATH).withColumn("back", sp.decoded(F.col("ids"), PATH)).collect()
    assert len(rows) == len(given) + 1
    for r in rows:
        text = None if r["doc_id"] is None else given[r["doc_id"]]
        assert r["back"] == (text or "").replace(sp.MARK, " ")
    assert sp.encode(docs(spark, []), PATH).count() == 0
    nothing = spark.range(1).select(F.lit(None).cast("array<int>").alias("ids"))
    assert nothing.select(sp.decoded(F.col("ids"), PATH).alias("t")).first()["t"] == ""


def test_stretches_of_plain_texts_need_no_pattern(model, monkeypatch):
    """A split at spaces gives the stretches that the pattern finds; other texts still go through the pattern."""
    for text in texts() + ["a b ", " a", "a  b", "a▁b", "▁", "  ", "a"]:
        if text:
            marked = sp.MARK + text.replace(" ", sp.MARK)
            assert [sp.MARK + x for x in sp._stretches(text)] == sp._STRETCH.findall(marked)
    monkeypatch.setattr(sp, "_STRETCH", None)
    found = np.frombuffer(model.encode(["the plain text "])[0], "<u4").tolist()
    assert found == best(model, "▁the▁plain▁text▁")


def test_runs_are_searched_together(model, monkeypatch):
    """A round's new runs go through one search over arrays, which agrees with the whole-text tables; odd ones are searched alone."""
    rng = random.Random(5)
    syllables = ["the", "ing", "on", "a", "re", "t", "ü", "ß", "est", "Q", "x" * 20]
    words = ["".join(rng.choice(syllables) for _ in range(rng.randrange(1, 9))) for _ in range(300)] + ["1", "中文", "é", "a\0b", "don't"]
    given = [w + rng.choice(["", ".", ",", ".\nThe", "!?\n" + rng.choice(words) + "."]) for w in words]
    text = " ".join(given)
    alone = []
    search = model._search
    monkeypatch.setattr(model, "memo", {})
    monkeypatch.setattr(model, "runs", {})
    monkeypatch.setattr(model, "_search", lambda t: alone.append(t) or search(t))
    assert np.frombuffer(model.encode([text])[0], "<u4").tolist() == best(model, sp.MARK + text.replace(" ", sp.MARK))
    assert not {sp.MARK + w for w in words[:300] if len(w) < sp.LONGEST_RUN} & set(alone)
    assert model._search_all(words) == [search(w) for w in words]
    assert model._search_all([]) == [] and model._search_all([""]) == [b""]


def test_decoding_takes_all_pieces(model):
    """One look-up over arrays gives the bytes of every kind of piece."""
    ids = np.arange(len(model.surface))
    assert model.decode(ids) == b"".join(model.surface).decode("utf-8", "replace").removeprefix(" ")
    assert model.decode(np.zeros(0, "int64")) == ""
