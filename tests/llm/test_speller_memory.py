"""A worker's memory for the speller: two of them share an executor with its JVM."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from linkloom.llm import speller as S


def _peak(run) -> float:
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_counting_and_learning_take_little_room():
    """1 MB of words at once: slots of all their bits took 249 MB and 215 MB, as traced here."""
    draw = random.Random(1)
    words = pa.array(["".join(draw.choices("etaoinshrdlu0123456789", k=draw.randint(4, 14))).encode() for _ in range(110_000)], type=pa.binary())
    batch = pa.RecordBatch.from_arrays([words], ["word"])
    counted = []
    assert _peak(lambda: counted.extend(S._bit_counts(iter([batch])))) < 90
    mixer = S.fresh()
    assert _peak(lambda: [S.learn(mixer, *part) for part in S._gathered(iter([batch]))]) < 150
    assert sum(len(b) for b in counted) == S.ORDERS * S.PIECES and np.isfinite(mixer.weights).all()
