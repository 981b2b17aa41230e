import numpy as np
import pyarrow as pa

from assay.llm.packing import ENCODED_BYTES, KEYED_BYTES, _keyed


def test_a_large_batch_is_worked_on_in_small_slices():
    """6 MB of text in one batch were one slice."""
    text = "some words of a text " * 50
    n = 6 * (1 << 20) // len(text)
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array([text] * n)], ["id", "text"])
    out = list(_keyed(None)(iter([batch])))
    assert sum(b.num_rows for b in out) == n
    assert max(b.num_rows for b in out) * len(text) <= KEYED_BYTES
    assert ENCODED_BYTES <= KEYED_BYTES
    assert np.concatenate([b.column("id").to_numpy() for b in out]).tolist() == list(range(n))
