"""Vectors that no tree can keep apart: every block meets every other, and is written once all the same."""

import numpy as np

from tabcycle.llm.vector_pairs import join, near_vectors


def shuffled(spark):
    executors = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(executors.apply(n).totalShuffleWrite() for n in range(executors.size()))


def test_blocks_are_not_sent_to_their_partners(spark, tmp_path):
    rng = np.random.default_rng(7)
    rows = rng.normal(size=(1200, 32)).astype(np.float32)
    rows[600:700] = rows[:100] + rng.normal(scale=0.05, size=(100, 32)).astype(np.float32)
    rows[700:720] = rows[:20]
    frame = spark.createDataFrame([(n, row.tolist()) for n, row in enumerate(rows)], "vec_id long, embedding array<float>").cache()
    frame.count()
    before = shuffled(spark)
    got = {r.id: r for r in near_vectors(frame, block=16, folder=str(tmp_path / "work")).collect()}
    # Some 75 blocks: it was 21.9 MB when each pair of blocks was sent to its task.
    assert shuffled(spark) - before < 10 * rows.nbytes
    unit = rows.astype(np.float64) / np.linalg.norm(rows.astype(np.float64), axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    assert [got[n].n_links for n in range(len(rows))] == (near.sum(1) - 1).tolist() and near.sum() > len(rows) + 200
    names = np.arange(len(rows))
    for _ in range(10):
        names = np.array([names[near[n]].min() for n in range(len(rows))])
    assert [got[n].component for n in range(len(rows))] == names.tolist()
    # Names (16 bytes), copies (8) and components of four bytes, once for each distinct vector.
    [folder] = (tmp_path / "work").glob("size-*/vectors")
    assert sum(f.stat().st_size for f in folder.glob("*.bin")) == 1180 * (24 + 4 * 32)


def test_join_names_a_group_after_its_least_member():
    root = np.arange(9)
    join(root, np.array([8, 3, 5]), np.array([3, 5, 4]))
    join(root, np.array([1, 7]), np.array([7, 1]))
    assert root.tolist() == [0, 1, 2, 3, 3, 3, 6, 1, 3]
