"""Operators 5, 6 and 7."""

from __future__ import annotations

import math
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import odd_rows

from tillroll.llm import language_id, piece_tokens, toxicity


@pytest.fixture(scope="module")
def vocabulary():
    return piece_tokens.Vocabulary.load()


def test_encode_against_plain_python(documents, vocabulary):
    rows = odd_rows() + [(60, "▁▁ a ▁b", "en", "a"), (61, "<s> </s> <0x41>", "en", "a"), (62, "\n\n  x\n y", "en", "a")]
    docs = documents(rows, clashing=True)
    want = sorted((str(d), brute.segment(vocabulary, t or "")) for d, t, *_ in rows)
    for chunk_chars in (32_768, 64, 33):
        got = piece_tokens.encode(docs, chunk_chars=chunk_chars)
        assert sorted((str(r.doc_id), list(r.ids)) for r in got.collect()) == want


def test_decode_is_the_inverse(documents):
    rows = odd_rows()
    docs = documents(rows)
    back = piece_tokens.decode(piece_tokens.encode(docs))
    want = sorted((str(d), (t or "").replace("▁", " ")) for d, t, *_ in rows)
    assert sorted((str(r.doc_id), r.text) for r in back.collect()) == want
    out = piece_tokens.encode(docs)
    sha = {str(r.doc_id) + str(r.text_sha256) for r in out.collect()}
    texts = docs.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("s")).collect()
    assert sha == {str(r.doc_id) + r.s for r in texts}


def test_units_agree_with_the_library(vocabulary):
    """The library finds no better segmentation over the same pieces, and in most
    texts the same one.  (Its search keeps 32-bit floats and, with scores this far
    apart, sometimes returns less than the best path; ours is never below it.)"""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(piece_tokens.MODEL_FILE, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    for piece, score in zip(model.pieces, piece_tokens.log_probabilities([p.score for p in model.pieces])):
        piece.score = score
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    segmenter = piece_tokens.Segmenter(vocabulary)
    rng = random.Random(3)
    pieces = [p.strip() for p in vocabulary.pieces if p.strip().isalpha()]
    texts = [" ".join("".join(rng.choice(pieces) for _ in range(rng.randrange(1, 9))) for _ in range(3)) for _ in range(500)]
    score, same = dict(vocabulary.pieces.values()), 0
    for text, packed in zip(texts, segmenter.encode(texts)):
        own, other = np.frombuffer(packed, vocabulary.code).tolist(), library.encode(text)
        assert sum(score[i] for i in own) >= sum(score[i] for i in other)
        assert library.decode(own) == text
        same += own == other
    assert same > 0.95 * len(texts)


def test_as_few_pieces_as_the_unmodified_model(vocabulary, sf_dir):
    """Tokens per character within 5 % of the library's own encoding, in every language."""
    import pyarrow.parquet as pq
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=piece_tokens.MODEL_FILE)
    segmenter = piece_tokens.Segmenter(vocabulary)
    fox = "The quick brown fox jumps over the lazy dog."
    assert np.frombuffer(segmenter.encode([fox])[0], vocabulary.code).tolist() == library.encode(fox)
    texts = {}
    for row in pq.read_table(f"{sf_dir}/documents.parquet").to_pylist():
        if row["text"] and row["lang"]:
            texts.setdefault(row["lang"], []).append(row["text"])
    wide = np.dtype(vocabulary.code).itemsize
    for own in texts.values():
        ours, theirs = sum(len(p) // wide for p in segmenter.encode(own)), sum(map(len, library.encode(own)))
        assert 0.95 * theirs < ours < 1.05 * theirs


def test_the_memo_forgets_long_units(vocabulary):
    segmenter = piece_tokens.Segmenter(vocabulary)
    segmenter.encode(["short words and " + "x" * 5000])
    assert segmenter.memo and max(map(len, segmenter.memo)) <= piece_tokens.LOCKSTEP_CHARS


def test_chunks_of_one_long_word(documents):
    """No place to cut: full matrices, entries and exits within pieces."""
    rng = random.Random(8)
    text = "".join(rng.choice("aeinrstlo") for _ in range(900))
    vocabulary = piece_tokens.Vocabulary.load()
    got = piece_tokens.encode(documents([(1, text), (2, text), (2, text)]), chunk_chars=64).collect()
    assert [list(r.ids) for r in got] == [brute.segment(vocabulary, text)] * 3


def test_prefixes_of_matrices():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 8, 13):
        m = rng.integers(-50, 0, (n, 4, 4))
        want = [m[0]]
        for k in range(1, n):
            want.append(piece_tokens.times(want[-1], m[k]))
        assert (piece_tokens.prefixes(m) == np.array(want)).all()


def test_a_model_whose_pieces_cross_blanks():
    v = piece_tokens.Vocabulary(["<unk>", "a", "▁b", "a▁b", "▁", "b"], [0, -3.0, -2.0, -1.0, -2.0, -1.5], ["unknown"] + ["normal"] * 5)
    s = piece_tokens.Segmenter(v)
    for text in ("a b", "aa bab b", "x a b", ""):
        assert np.frombuffer(s.encode([text])[0], v.code).tolist() == brute.segment(v, text)


def plain_bits(texts, text, order):
    """PPM code length of a text, symbol by symbol."""
    counts = {}
    for t in texts:
        data = b"\n" * order + t
        for i in range(order, len(data)):
            for k in range(order + 1):
                own = counts.setdefault(data[i - k : i], {})
                own[data[i]] = own.get(data[i], 0) + 1
    data, bits = b"\n" * order + text, 0.0
    for i in range(order, len(data)):
        for k in range(order, -1, -1):
            own = counts.get(data[i - k : i])
            if own is None:
                continue
            room = sum(own.values()) + len(own)
            if data[i] in own:
                bits -= math.log2(own[data[i]] / room)
                break
            bits -= math.log2(len(own) / room)
        else:
            bits += 8
    return bits


def test_code_lengths_against_plain_python():
    train = {"x": [b"abracadabra banana", b"band"], "y": [b"xyz xyz zyx"]}
    counts = []
    for texts in train.values():
        grams, n = np.unique(language_id._led([language_id._PAD + t for t in texts])[0], return_counts=True)
        counts.append((grams, n.astype(float)))
    trees = language_id.ContextTrees(list(train), counts)
    texts = [b"banana xyz", b"q", b"abracadabra", "é".encode()]
    got = trees.totals(texts, trees.table())
    want = [[plain_bits(own, t, language_id.ORDER) for own in train.values()] for t in texts]
    assert np.allclose(got, want, rtol=1e-5)


def test_language_of_odd_rows(documents):
    rows = odd_rows()
    docs = documents(rows, clashing=True)
    trees = language_id.train(docs)
    got = language_id.predict(docs, trees).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    und = sorted(str(r.doc_id) for r in got if r.lang_pred == "und")
    assert und == sorted(["12", "7", "8", "9"])
    stay = language_id.keep_known(docs)
    assert stay.columns == docs.columns and stay.count() == len(rows) - 4
    assert language_id.predict(documents([]), trees).count() == 0
    nothing = language_id.train(documents([]))
    assert {r.lang_pred for r in language_id.predict(docs, nothing).collect()} == {"und"}
    assert language_id.keep_known(documents([])).count() == 0


def test_language_accuracy_and_no_leak(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = language_id.predict(docs, language_id.train(docs)).join(docs.select("doc_id", "lang"), "doc_id")
    held = got.where(language_id.held_out(F.col("doc_id"))).collect()
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    # Held-out rows change nothing in what is learned.
    other = docs.withColumn("lang", F.when(language_id.held_out(F.col("doc_id")), "en").otherwise(F.col("lang")))
    assert (language_id.train(other).known == language_id.train(docs).known).all()


def test_toxicity_of_odd_rows(spark, documents):
    rows = odd_rows()
    docs = documents(rows, clashing=True)
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 1), (5, 0), (10, 0), (None, 1), (13, None), (3, 0)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    empty = {round(r.score, 9) for r in got if r.doc_id in (7, 8)}
    assert len(empty) == 1
    assert toxicity.score(documents([]), model).count() == 0
    none = toxicity.train(docs, labels.where("false"))
    assert {r.predicted for r in toxicity.score(docs, none).collect()} == {0}
    one = toxicity.train(docs, labels.where("toxic = 1"))
    assert {r.predicted for r in toxicity.score(docs, one).collect()} == {1}


def test_toxicity_held_out(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.score(docs, toxicity.train(docs, labels)).join(labels, "doc_id")
    held = got.where(toxicity.held_out(F.col("doc_id"))).collect()
    toxic, clean = [r.score for r in held if r.toxic], [r.score for r in held if not r.toxic]
    above = sum((t > c) + 0.5 * (t == c) for t in toxic for c in clean) / (len(toxic) * len(clean))
    assert above > 0.8
    assert sum(r.predicted == r.toxic for r in held) > 0.9 * len(held)
