"""Pieces of sorted rows that never part a group."""

import random

import pyarrow as pa
import pytest

from skiagram.llm import repeats


@pytest.mark.parametrize("least", [1, 5, 64])
def test_pieces_hold_whole_groups_in_order(least):
    rng = random.Random(least)
    for _ in range(40):
        keys = sorted(rng.choice((1, 1, 1, 2, 3, 4, 5, 6, 7, 8)) for _ in range(rng.randint(1, 200)))
        batch = pa.RecordBatch.from_arrays([pa.array(keys), pa.array(range(len(keys)))], ["k", "n"])
        cuts = sorted({0, len(keys), *(rng.randrange(len(keys)) for _ in range(9))})
        groups = repeats.WholeGroups("k", least)
        pieces = [p for a, b in zip(cuts, cuts[1:], strict=False) for p in groups.add(batch.slice(a, b - a))]
        assert all(p.num_rows >= least for p in pieces)
        pieces += groups.rest()
        assert [n for p in pieces for n in p.column("n").to_pylist()] == list(range(len(keys)))
        seen = [set(p.column("k").to_pylist()) for p in pieces]
        assert all(not (a & b) for a, b in zip(seen, seen[1:], strict=False))
        assert not list(groups.rest())


def test_a_large_group_is_put_together_once(monkeypatch):
    """Rows copied grow with the rows, not with rows times batches."""
    copied = []
    joined = pa.concat_batches
    monkeypatch.setattr(repeats.pa, "concat_batches", lambda held: copied.append(sum(b.num_rows for b in held)) or joined(held))
    groups = repeats.WholeGroups("k", 16)
    n = 0
    for _ in range(300):
        n += sum(p.num_rows for p in groups.add(pa.RecordBatch.from_arrays([pa.array([7] * 100)], ["k"])))
    n += sum(p.num_rows for p in groups.add(pa.RecordBatch.from_arrays([pa.array([7, 8])], ["k"])))
    n += sum(p.num_rows for p in groups.rest())
    assert n == 30_002 and sum(copied) < 61_000
