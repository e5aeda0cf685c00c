"""Token ids against the library and the coder's exact round trips."""

import json
import random

import numpy as np
import pyarrow as pa
import pytest
from folioflow.llm import coder, token_files


@pytest.mark.parametrize("ids", [np.arange(100_000), np.random.default_rng(3).integers(0, 2**32, 5000, np.uint32), np.random.default_rng(4).integers(0, 70_000, 200_000), np.repeat(9, 10_000), np.array([2**32 - 1])])
def test_any_alphabet(ids):
    assert (coder.decode(coder.encode(ids)) == ids.astype(np.uint32)).all()


def test_blocks_stand_alone():
    ids = np.minimum(np.random.default_rng(1).zipf(1.2, 9000), 40_000)
    data = coder.encode(ids)
    for k in range(5):
        assert (coder.decode(data, [k]) == ids[2048 * k : 2048 * (k + 1)]).all()
    other = ids.copy()
    other[:2048] = other[:2048][::-1]  # the same ids in another order: only the first block's code changes
    assert (coder.decode(coder.encode(other), [3]) == ids[6144:8192]).all()


def test_order_0_adapts():
    rng = np.random.default_rng(5)
    flat = rng.integers(0, 256, 64 * 2048)
    own = (flat % 8 + 8 * np.repeat(rng.integers(0, 32, 64), 2048)).astype(np.uint32)  # every block has 8 ids of its own
    assert len(coder.encode(own)) < 0.75 * len(coder.encode(flat))


PARTS = [*"aAbÀéßİıſK'.,!? \n\t\r\x0b  ̸̣́<|>1२٣½ΣςάǅŉﬁЖ漢が゙한ᄀ가\x00\x1f_-", "'s", "'LL", "<|endoftext|>", "<|ENDOFTEXT|>", "é", " ́", "word", "Word."]


@pytest.mark.parametrize("marked", [True, False])
@pytest.mark.parametrize("most", [token_files.PIECE, 40])
def test_ids_are_the_library_s(most, marked):
    rng = random.Random(1)
    parts = PARTS if marked else [p for p in PARTS if "<" not in p]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(3000)] + ["", None]
    tokens = token_files._Tokens(token_files.default_tokenizer())
    assert tokens.apart
    got: list = [None] * len(texts)
    for first, rows, piece in token_files.pieces(pa.array(texts, pa.string()), most):
        ids, sizes = tokens.ids(piece, 1)
        for row, end, size in zip(rows, np.cumsum(sizes), sizes, strict=True):
            own = ids[end - size : end].tolist()
            got[first + row] = own if got[first + row] is None else got[first + row][:-1] + own
    for text, own in zip(texts, got, strict=True):
        assert own == [*tokens.library.encode(text or "", add_special_tokens=False).ids, 1], repr(text)


def test_other_tokenizer_gets_whole_texts(tmp_path):
    with open(token_files.default_tokenizer(), encoding="utf-8") as f:
        own = json.load(f)
    own["normalizer"]["normalizers"].pop()  # no lower-casing
    path = tmp_path / "other.json"
    path.write_text(json.dumps(own), encoding="utf-8")
    tokens = token_files._Tokens(str(path))
    assert not tokens.apart
    texts = ["Some Words.", "", "MORE"]
    ids, sizes = tokens.ids(pa.array(texts), 1)
    assert ids.tolist() == [i for t in texts for i in [*tokens.library.encode(t, add_special_tokens=False).ids, 1]] and sizes.sum() == len(ids)


def test_long_text_over_several_segments(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT", 4096)
    monkeypatch.setattr(token_files, "PIECE", 9000)
    docs = spark.createDataFrame([(1, "a bc " * 20_000), (2, None), (3, "x" * 30_000)], "doc_id long, text string")
    batches = docs.toArrow().to_batches()
    monkeypatch.setattr(token_files.TaskContext, "get", staticmethod(lambda: type("T", (), {"partitionId": staticmethod(lambda: 0)})))
    rows = list(token_files._encoder(token_files.default_tokenizer(), 1)(batches))
    tokens = token_files._tokenizer(token_files.default_tokenizer())
    want = [[*tokens.library.encode(t or "", add_special_tokens=False).ids, 1] for t in ("a bc " * 20_000, None, "x" * 30_000)]
    lengths = np.concatenate([np.frombuffer(v.as_py(), "<i8") for r in rows for v in r.column("lengths")])
    ids = np.concatenate([coder.decode(s) for r in rows for v in r.column("segments") for s in v.as_py()])
    assert lengths.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    assert max(len(v.as_py()) for r in rows for v in r.column("segments")) > 5
