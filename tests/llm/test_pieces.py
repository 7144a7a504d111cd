import contextlib
import io
import random

import numpy as np
import pytest

from clickflow.llm import pieces

ORDINARY, BYTE_IDS, SPELLED, UNKNOWN = pieces._model(pieces.MODEL)
SCORES = {piece: (i, score) for piece, i, score in ORDINARY}
WORST = min(score for _, _, score in ORDINARY) - pieces.UNKNOWN_PENALTY


def plain(text):
    """The best path over the whole text, of equal scores that with the longer last piece."""
    if not text:
        return []
    text = "▁" + text.replace(" ", "▁")
    best = [(0.0, -1, None)]
    for end in range(1, len(text) + 1):
        here = None
        for start in range(max(0, end - 16), end):
            known = SCORES.get(text[start:end]) or ((None, WORST) if end - start == 1 else None)
            if known and (here is None or best[start][0] + known[1] > here[0]):
                here = (best[start][0] + known[1], start, known[0])
        best.append(here)
    out, end = [], len(text)
    while end:
        _, start, i = best[end]
        out = ([i] if i is not None else [BYTE_IDS[b] for b in text[start:end].encode()]) + out
        end = start
    return out


TEXTS = [
    "Hello  world\nfoo", "", None, " ", "   ", " lead", "trail ", "a  b   c", "the the with hest", "x².y", "日本語 🎉🎉",
    "foo_1,2);\r\n\ttab", "Zażółć gęślą jaźń", "word" * 3000, "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "\x00\x01",
]


def encoded(documents, rows):
    return sorted(((r.doc_id, list(r.ids), r.n_tokens, r.round_trip) for r in pieces.encode(documents(*rows)).collect()), key=str)


def test_ids_are_those_of_the_best_path_and_decode_to_the_text(documents):
    rng = random.Random(2)
    noise = ["".join(rng.choice("abcdeABC éß,.!  \n0189") for _ in range(60)) for _ in range(30)]
    rows = [*enumerate([*TEXTS, *noise]), (1, TEXTS[0]), (None, "no id")]
    expected = sorted(((doc, plain(t or ""), len(plain(t or "")), True) for doc, t in rows), key=str)
    assert encoded(documents, rows) == expected


def test_many_chunks_give_the_same(documents, monkeypatch):
    monkeypatch.setattr(pieces, "CHUNK_BYTES", 40)
    rows = [(i, f"some shared words and own{i} ones, {i}", "s", (None, "en", "de", f"x{i}")[i % 4]) for i in range(30)]
    expected = sorted(((i, plain(t), len(plain(t)), True) for i, t, *_ in rows), key=str)
    assert encoded(documents, rows) == expected
    found = pieces.encode(documents(*rows), alike="lang").collect()
    assert sorted(((r.doc_id, list(r.ids), r.n_tokens, r.round_trip) for r in found), key=str) == expected


def test_words_agree_with_the_library():
    spm = pytest.importorskip("sentencepiece")
    model_pb2 = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    import public_tokenizers

    proto = model_pb2.ModelProto()
    with open(public_tokenizers.path(pieces.MODEL), "rb") as data:
        proto.ParseFromString(data.read())
    proto.trainer_spec.model_type = 1  # best path by score, on the same pieces
    model = spm.SentencePieceProcessor(model_proto=proto.SerializeToString())
    for word in "the with hest Hello strangely international Zusammenhang".split():
        assert model.nbest_encode(word, nbest_size=3)[0] == plain(word)


def test_the_space_sign_reads_back_as_a_space(documents):
    ((_, ids, _, same),) = encoded(documents, [(1, "a▁b")])
    assert ids == plain("a b") and not same


def test_decoding(spark):
    df = spark.createDataFrame([(1, plain("Hello  world é🎉")), (2, []), (3, None)], "doc_id long, ids array<int>")
    assert [r.text for r in pieces.decode(df).orderBy("doc_id").collect()] == ["Hello  world é🎉", "", None]


def test_empty_table(documents):
    assert encoded(documents, []) == []


def test_best_edges_of_many_segments_together():
    rng = random.Random(3)
    edges, expected = [], []
    for which, size in enumerate([1, 7, 2, 40, 1, 12, 7]):
        best = [(0.0, [])]
        for end in range(1, size + 1):
            starts = [s for s in range(max(0, end - 5), end) if s == end - 1 or rng.random() < 0.5]
            own = [(which, s, end, float(-rng.randint(1, 3))) for s in starts]
            edges += own
            # Few different scores: many ways are equal, and the longest last edge wins.
            best.append(max(((best[e[1]][0] + e[3], [*best[e[1]][1], e]) for e in own), key=lambda way: (way[0], -way[1][-1][1])))
        expected += best[-1][1]
    rng.shuffle(edges)
    which, start, end, score = (np.array(column) for column in zip(*edges))
    assert [edges[i] for i in pieces._best_edges(which, start, end, score)] == expected
    assert len(pieces._best_edges(*(np.zeros(0, np.int64),) * 4)) == 0


def test_more_segments_than_a_batch_holds_and_no_fold_row_by_row(documents):
    rng = random.Random(4)
    rows = [(i, " ".join("".join(rng.choice("abcdeiounrst\u00e9\U0001f389") for _ in range(rng.randint(1, 14))) for _ in range(60))) for i in range(50)]
    found = pieces.encode(documents(*rows))
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        found.explain()
    assert "aggregate(" not in plan.getvalue()
    assert {r.doc_id: list(r.ids) for r in found.collect()} == {doc: plain(text) for doc, text in rows}
