"""The vector join's files, bounds and disk against brute force."""

import os
import re
import threading
from contextlib import suppress
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import functions as F

from tempora.llm import subspace_join as J
from tempora.session import ensure_checkpoint_dir


def brute(x, cosine):
    u = J.unit(x)
    linked = u @ u.T >= cosine
    np.fill_diagonal(linked, False)
    label = np.arange(len(x))
    while True:
        new = np.where(linked.any(axis=1), np.minimum(label, np.where(linked, label[None, :], len(x)).min(axis=1)), label)
        if (new == label).all():
            return linked.sum(axis=1), label
        label = new


def crowds(seed, n=900, dims=32, groups=12):
    """Groups around far vectors in decaying dimensions, of pairs on both sides of the bound, then vectors of no group."""
    rng = np.random.default_rng(seed)
    fall = np.exp(-np.arange(dims) / 8)
    group = rng.integers(0, groups, n)
    x = rng.normal(size=(groups, dims))[group] * fall
    x += rng.normal(size=(n, dims)) * fall * rng.choice([0.05, 0.2], size=(n, 1))
    x[-n // 9:] = rng.normal(size=x[-n // 9:].shape)
    group[-n // 9:] = groups
    return (x @ np.linalg.qr(rng.normal(size=(dims, dims)))[0]).astype(np.float32), group


def moments(x):
    u = J.unit(x)
    return np.concatenate([(u.T @ u).ravel(), u.sum(axis=0), [len(u)]])


def laid(x, cells, size, folder):
    """Files of x by ``_written``, in the order of their cells."""
    batch = pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), *(pa.array(np.arange(len(x)) * k) for k in (1, 0, 1, 1)),
                                        pa.array(list(x), pa.list_(pa.float32()))], names=["cell", "rep", "copies", "e1", "e2", "embedding"])
    batch = batch.set_column(2, "copies", pa.array(np.ones(len(x), dtype=np.int64)))
    order = np.argsort(cells, kind="stable")
    files = {}
    for k in range(0, len(x), size):
        for names in J._written([batch.take(pa.array(order[k:k + size]))], folder, size):
            for f, c in zip(names["file"].to_pylist(), names["cell"].to_pylist()):
                files[f] = min(c, files.get(f, c))
    return sorted(files, key=lambda f: (files[f], f))


def test_far_tiles_are_passed_over_and_no_link_is_lost(tmp_dir, monkeypatch):
    """Tiles that the blocks keep apart are not compared; leading blocks and pairs of few rows leave every link."""
    monkeypatch.setattr(J, "TILE", 40)
    monkeypatch.setattr(J, "APART", 0.0)
    for seed, n_files in ((1, 4), (2, 5), (3, 1)):
        x, cells = crowds(seed)
        split = J.Split(moments(x), x.shape[1], 0.95, 4)
        assert 0 < split.lead < x.shape[1] and split.lead % 4 == 0
        files = laid(x, cells, -(-len(x) // n_files), tmp_dir)
        assert len(files) == n_files
        links, edges = np.zeros(len(x), dtype=np.int64), []
        parts = -(-(n_files // 2 + 1) // 2)
        batch = pa.RecordBatch.from_arrays([pa.array(range(n_files * parts))], names=["id"])
        for out in J._links([batch], [[f] for f in files], tmp_dir, split, 2):
            np.add.at(links, out["rep"].to_numpy(), out["links"].to_numpy())
            edges += zip(out["rep"].to_pylist(), out["root"].to_pylist())
        want, label = brute(x, 0.95)
        assert (links == want).all() and want.max() > 20
        own = J.Labels(len(x))
        own.join(*(np.array(e, dtype=np.int64) for e in zip(*edges)))
        assert (own.all() == label).all()

        fs, root = pafs.FileSystem.from_uri(tmp_dir)
        rows = [J.Rows(fs, [f"{root}/{f}"], split) for f in files]
        tested = sum(J.compare(a, b, split, J.Labels(len(a.rep))) for i, a in enumerate(rows) for b in rows[i:])
        assert tested < 0.4 * len(x) ** 2


def test_vectors_are_not_copied_for_the_pairs_they_take_part_in(spark):
    """Disk follows the number of vectors: each is shuffled and written a few times, whatever the groups it meets."""
    rng = np.random.default_rng(4)
    n, dims = 4000, 64
    x = rng.normal(size=(n, dims)).astype(np.float32)
    x[1::10] = x[::10] + rng.normal(size=x[::10].shape).astype(np.float32) * 0.05
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    table = f"{ensure_checkpoint_dir(spark)}/given-{rng.integers(1 << 60)}"
    rows.repartition(4).write.parquet(table)
    shared = urlparse(ensure_checkpoint_dir(spark)).path
    tops = [shared, *(d.getPath() for d in spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs())]

    def held():
        found = {}
        for top in tops:
            for d, _, names in os.walk(top):
                for f in names:
                    if d.startswith(shared) or re.match(r"shuffle_.*\.data$", f):
                        with suppress(OSError):  # a file may go meanwhile
                            found[f"{d}/{f}"] = os.path.getsize(f"{d}/{f}")
        return found

    before, seen, over = held(), {}, threading.Event()

    def watch():
        while not over.wait(0.02):
            seen.update(held())

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        got = J.near_vectors(spark.read.parquet(table), 0.9, chunk=500).agg(F.sum("n_links"), F.sum(F.col("kept").cast("int"))).first()
    finally:
        over.set()
        watcher.join()
    made = sum(size for f, size in seen.items() if f not in before)
    links, label = brute(x, 0.9)
    assert tuple(got) == (links.sum(), len(set(label))) and links.sum() == n // 5
    assert made < 8 * x.nbytes


def test_negative_zero_types_and_ids_of_two_vectors(spark):
    """Negative zero equals zero; rows of one vec_id do not link with each other, and share what they link with."""
    rows = [(1, [0.0, 1.0]), (2, [-0.0, 1.0]), (3, [0.1, 1.0]), (4, [1.0, 0.0]), (4, [1.0, 0.1]), (5, [1.0, 0.05]), (None, [1.0, 0.0]), (6, None)]
    for kind in ("float", "double"):
        got = sorted((r.vec_id or 0, r.n_links, r.component_id) for r in J.near_vectors(
            spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>"), 0.9).collect())
        assert got == [(0, 0, None), (1, 2, 1), (2, 2, 1), (3, 2, 1), (4, 2, 4), (4, 2, 4), (5, 2, 4), (6, 0, 6)]
