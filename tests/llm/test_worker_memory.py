"""What a Python worker holds after its work."""

import re
from pathlib import Path

import pyarrow as pa
import pytest

from tabcycle.llm.common import arrow_map, worker_tables

PIECES, SIZE = 50_000, 4096
ROLLUP = Path("/proc/self/smaps_rollup")
pytestmark = pytest.mark.skipif(not ROLLUP.exists(), reason="memory can't be read here")


def held_mb() -> float:
    return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", ROLLUP.read_text()))) / 1024


def pieces_and_pins() -> tuple[list[bytes], list[bytes]]:
    """200 MB of small strings; some stand elsewhere too, so that the heap has no free end when the others go."""
    pieces = [bytes(SIZE) for _ in range(PIECES)]
    return pieces, pieces[::50]


def test_tables_of_another_operator_go_back_to_the_system():
    worker_tables("one")["pieces"], pins = pieces_and_pins()
    most = held_mb()
    worker_tables("two")
    assert most - held_mb() > 150 and len(pins) == PIECES / 50


def test_a_task_gives_back_what_its_batches_took(spark):
    pins, most = [], []

    def each(batch):
        pieces, some = pieces_and_pins()
        pins.extend(some)
        most.append(held_mb())
        return {"n": [len(pieces)]}

    class Frame:
        def mapInArrow(self, run, schema):
            return run

    run = arrow_map(Frame(), "n bigint", each)
    rows = list(run(iter([pa.RecordBatch.from_pydict({"id": [1]})])))
    assert rows[0].to_pydict() == {"n": [PIECES]}
    assert most[0] - held_mb() > 150
