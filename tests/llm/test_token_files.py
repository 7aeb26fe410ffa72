"""What an encoder of token files holds does not grow with the texts it has seen."""

import numpy as np
import pyarrow as pa

from quire.llm import queries, token_files
from quire.llm._common import utf8


def encoder(monkeypatch, pieces=None):
    out = token_files.BatchEncoder(queries.tokenizer("byte_bpe_50k.json"))
    asked, real = [], pieces or out.pieces.encode
    monkeypatch.setattr(out.pieces, "encode", lambda texts, end: asked.extend(texts) or real(texts, end))
    return out, asked


def test_chunks_take_a_bounded_memory(monkeypatch):
    given, _ = encoder(monkeypatch, lambda texts, end: [b"\1\0\2\0\3\0\4\0"] * len(texts))
    for k in range(0, 2_600_000, 130_000):
        given.encode(*utf8(pa.array([" ".join(map(str, range(k, k + 130_000)))])), b"")
    held = sum(x.nbytes for g in vars(given).values() if isinstance(g, token_files.ChunkTable) for x in vars(g).values() if isinstance(x, np.ndarray))
    assert held < 80e6


def test_full_tables_keep_what_is_used(monkeypatch):
    monkeypatch.setattr(token_files, "TABLE_BITS", 10)
    given, asked = encoder(monkeypatch)
    library = given.pieces.tokenizer
    for k in range(20):
        texts = ["often used words, it's so", " ".join(f"word{k * 100 + j}é" for j in range(100)), "often  <|endoftext|> x"]
        got = given.encode(*utf8(pa.array(texts)), b"")
        assert [np.frombuffer(x, given.kind).tolist() for x in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert asked.count(" words,") == 1
