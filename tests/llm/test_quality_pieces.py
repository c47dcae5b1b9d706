"""Texts are measured together by bytes, not by rows."""

import numpy as np
import pyarrow as pa

from tablewatch.llm import quality


def test_pieces_hold_few_bytes():
    sizes = [0, 10, 99, 100, 101, 5000, 3, 0, 0, 50, 50, 1] * 40
    column = pa.array([b"x" * n for n in sizes], pa.binary())
    for part in (column, column.slice(7, 300), column.slice(0, 0)):
        met = list(quality.pieces(part, most=100, rows=4))
        assert [at for at, _ in met] == np.cumsum([0] + [n for _, n in met])[:-1].tolist() and sum(n for _, n in met) == len(part)
        for at, n in met:
            texts = part.slice(at, n).to_pylist()
            assert 1 <= n <= 4 and (n == 1 or sum(map(len, texts)) <= 100)


def test_measurements_do_not_depend_on_the_pieces():
    texts = [("word %d " % (i % 7) * (i % 50)).encode() for i in range(300)] + [b"", b"a b c d e f g h " * 5000]
    column = pa.array(texts, pa.binary())
    whole = quality.measure(list(texts))
    cut = np.concatenate([quality.measure(column.slice(at, n).to_pylist()) for at, n in quality.pieces(column, most=700)])
    assert (whole == cut).all()
