"""What a worker of the language model holds on to."""

import numpy as np
import pyarrow as pa

from noria.llm import common, lm


def test_counting_leaves_no_larger_tables_of_powers(monkeypatch):
    """They stay in a worker for its life, twice 8 bytes for each byte that was hashed at once."""
    for name in ("_POWERS", "_INVERSE"):
        monkeypatch.setattr(common, name, np.ones(1, np.uint64))
    texts = pa.array([f"w{i % 7} v{i} " * 4000 for i in range(200)])
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    counted = list(lm._counts(iter([batch])))
    assert sum(np.asarray(b.column(1)).sum() for b in counted) == 200 * 8001
    assert len(common._POWERS) <= common.SLICE_BYTES + 4097
