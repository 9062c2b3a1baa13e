import tracemalloc

import numpy as np
import pyarrow as pa

from accordium.llm import lm
from accordium.llm.common import texts_of
from accordium.llm.labelled import filtered


class _Taken:
    """Stands for a table and hands out the function that its tasks would run."""

    schema = None

    def mapInArrow(self, run, schema):
        return run


def test_filters_copy_a_batch_by_slices():
    texts = [("word %d " % i) * 600 for i in range(6000)] + [None, ""]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    whole = batch.column(1).nbytes
    seen: list[bytes | None] = []

    def keep(texts):
        seen.extend(t and t[:12] for t in texts)
        return np.arange(len(texts)) % 2 == 0

    run = filtered(_Taken(), lambda: keep)
    tracemalloc.start()
    try:
        rows = sum(part.num_rows for part in run(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert whole > 30_000_000 and peak < whole / 3
    assert 3000 <= rows <= 3100 and seen == [t and t[:12] for t in texts_of(batch)]


def test_groups_are_scored_in_bounded_memory():
    rng = np.random.default_rng(5)
    names = [b"w%d" % k for k in range(250_000)] + [b""]
    seq = np.concatenate([np.concatenate([part, [250_000]]) for part in np.split(rng.permutation(np.arange(500_000) % 250_000), 500)]).astype(np.int32)
    tokens, held = np.full(500, 1001), np.zeros(500, bool)
    train = np.bincount(seq, minlength=len(names))
    tracemalloc.start()
    try:
        bits = lm.group_bits(seq, tokens, held, names, train, train, int(train.sum()))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(bits) == len(seq) and (bits > 0).all()
    assert peak < 190_000_000
