"""Embedding near-duplicates (operator 5) by a join on subspace bounds.

For unit vectors a cosine of at least c is a squared distance of at most D = 2 - 2c. Vectors
are rotated to their principal axes (a matrix that depends on sums over all vectors), which are split
into low-dimensional blocks. Two exact bounds keep pairs from the full test; neither can lose a link:

* the squared distances within the blocks add up, so two tiles of rows are apart if the gaps between
  their balls, one in each block, add up to more than D;
* a cosine is at most the product within the leading blocks plus the product of the two lengths outside them.
  That is one product of rows a few blocks wide; the few pairs it leaves are verified by their exact cosine
  in double precision.

Every distinct vector is written once, to a file of the shared folder with others of its cell (the nearest of
some pivots, so that near vectors lie in few tiles), and tasks read the files they compare from there: no
vector is copied for the pairs it takes part in, so disk follows the number of vectors. A task
holds the rows of one group of files and one more; each pair of groups is compared once.

No link is emitted as a pair: a task counts the links of each row it has compared and keeps a spanning set of
edges. Equal vectors are one class with a multiplicity, so copies add to counts without any pair. A class
goes by two 64-bit hashes of its vector where its rows look it up.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components, and
rows without a vec_id, link with nothing (component is their own vec_id, if any); vectors of different
lengths do not link, and each length that occurs is joined on its own; repeated rows are other vectors
of the same class, so each counts the others; an empty table gives no rows; only
``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

import uuid
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.llm.common import components, scratch, stored

BLOCK_DIMS = 8
#: Rows of a group of files at most, about: a task holds two groups.
CHUNK = 65536
#: Rows of a group of a small table, and the groups that a table is cut into at least where they would be larger.
SMALL, GROUPS = 2048, 24
TILE = 1024
PIVOTS = 1024
#: Groups that a task compares its own with at most.
SPAN = 16
#: A first single-precision test of bounds (sums of products below 2) passes what lies this close.
SLACK = 1e-5
#: Cosines this close to the bound are recomputed in one fixed order of operations.
CLOSE = 1e-9
#: The bound of two unrelated vectors should lie so many standard deviations below the cosine asked for.
APART = 3.3
#: Pairs whose links are counted at once.
HELD = 1 << 20
LINKS = "rep long, links long, root long"
NAMES = "rep long, copies long, e1 long, e2 long"


def unit(rows: np.ndarray) -> np.ndarray:
    x = rows.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _moments(batches, dims: int):
    total = np.zeros((dims, dims))
    mean, n = np.zeros(dims), 0
    for batch in batches:
        x = unit(_matrix(batch.column("embedding"), dims))
        total += x.T @ x
        mean += x.sum(axis=0)
        n += len(x)
    flat = np.concatenate([total.ravel(), mean, [n]])
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["i", "v"])


def _matrix(column, dims: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, dims)


class Split:
    """The rotation, the blocks, and how many axes (whole blocks) lead."""

    def __init__(self, moments: np.ndarray, dims: int, cosine: float, block_dims: int):
        n = max(1.0, moments[-1])
        values, axes = np.linalg.eigh(moments[:dims * dims].reshape(dims, dims) / n)
        order = np.argsort(-values)
        values, self.axes = np.maximum(values[order], 0), axes[:, order]
        mean = (moments[dims * dims:-1] / n) @ self.axes
        self.edges = [*range(0, dims, block_dims), dims]
        self.cosine, self.most = cosine, 2 - 2 * cosine + 1e-9

        def bound(k: int) -> float:
            return (mean[:k] ** 2).sum() + APART * np.sqrt((values[:k] ** 2).sum()) + values[k:].sum()

        self.lead = next((k for k in self.edges[1:-1] if bound(k) <= cosine), dims)


def _located(batches, pivots: np.ndarray, dims: int):
    """The rows with their cell: the pivot that is nearest."""
    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            part = batch.slice(at, 2048)
            cell = np.zeros(part.num_rows, dtype=np.int32)
            if len(pivots):
                cell = (unit(_matrix(part.column("embedding"), dims)) @ pivots.T).argmax(axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(cell), *part.columns], names=["cell", *part.schema.names])


def _written(batches, folder: str, size: int):
    """Writes the rows of a task to files of about ``size`` rows, in order of their cells; the names of all
    rows with their file and cell."""
    fs, root = pafs.FileSystem.from_uri(folder)
    held: list[pa.RecordBatch] = []

    def write():
        table = pa.Table.from_batches(held).sort_by("cell")
        held.clear()
        name = f"{uuid.uuid4().hex}.arrow"
        rows = table.select(["cell", "rep", "copies", "embedding"])
        with fs.open_output_stream(f"{root}/{name}", compression=None) as out, pa.ipc.new_file(out, rows.schema) as file:
            file.write_table(rows)
        names = table.select(["rep", "copies", "e1", "e2", "cell"])
        return names.append_column("file", pa.array([name] * len(names), pa.string())).to_batches()

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= 2 * size:
            yield from write()
    if held:
        yield from write()


class Labels:
    """Connected sets of rows; the smallest row is the root of its set."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def all(self) -> np.ndarray:
        while True:
            up = self.up[self.up]
            if (up == self.up).all():
                return up
            self.up = up

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            now = self.all()
            x, y = now[a], now[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.up, np.maximum(x, y), np.minimum(x, y))


class Rows:
    """The rows of a group of files, cut into tiles with a ball in each block, and the links found of them."""

    def __init__(self, fs, paths: list[str], split: Split):
        tables = []
        for path in paths:
            with fs.open_input_file(path) as file:
                tables.append(pa.ipc.open_file(file).read_all())
        table = pa.concat_tables(tables)
        dims = len(split.axes)
        cell, self.rep, self.copies = (table[c].to_numpy() for c in ("cell", "rep", "copies"))
        self.raw = _matrix(table["embedding"].combine_chunks(), dims)
        n, k = len(self.rep), split.lead
        self.links, self.near = np.zeros(n, dtype=np.int64), np.full(n, -1)

        cuts, changes = [0], {*np.flatnonzero(np.diff(cell)).tolist()}
        for at in sorted({*(x + 1 for x in changes), n}):  # a tile is of one cell, unless cells are small
            while at - cuts[-1] > TILE:
                cuts.append(cuts[-1] + TILE)
            if at - cuts[-1] >= TILE // 2 or at == n:
                cuts.append(at)
        self.tiles = [slice(a, b) for a, b in zip(cuts, cuts[1:]) if a < b]

        self.bound = np.empty((n, k + (k < dims)), dtype=np.float32)
        self.middle, self.radius = np.empty((len(self.tiles), dims)), np.empty((len(self.tiles), len(split.edges) - 1))
        for t, s in enumerate(self.tiles):
            z = unit(self.raw[s]) @ split.axes
            self.bound[s, :k] = z[:, :k]
            if k < dims:
                self.bound[s, k] = np.sqrt((z[:, k:] ** 2).sum(axis=1))
            self.middle[t] = z.mean(axis=0)
            d = np.add.reduceat((z - self.middle[t]) ** 2, split.edges[:-1], axis=1)
            self.radius[t] = np.sqrt(d.max(axis=0))


def meeting(home: Rows, there: Rows, split: Split) -> np.ndarray:
    """Tiles by tiles: not so far apart, over the blocks, that no pair can link."""
    total = np.zeros((len(home.tiles), len(there.tiles)))
    for j, (a, b) in enumerate(zip(split.edges, split.edges[1:])):
        d = home.middle[:, None, a:b] - there.middle[None, :, a:b]
        gap = np.sqrt((d * d).sum(axis=2)) - home.radius[:, None, j] - there.radius[None, :, j]
        total += np.maximum(gap, 0) ** 2
    return total <= split.most


def places(ok: np.ndarray) -> np.ndarray:
    """Where a flat array of few true values has them: eight are looked at together, and eight of those."""
    if len(ok) < 4096 or len(ok) % 8:
        return np.flatnonzero(ok)
    at = (places(ok.view(np.uint64) != 0)[:, None] * 8 + np.arange(8)).ravel()
    return at[ok[at]]


def compare(home: Rows, there: Rows, split: Split, labels: Labels) -> int:
    """Adds the links between two groups of rows (or within one, if they are the same): copies linked with to both,
    edges between rows of ``home`` to ``labels``, and to each linked row of ``there`` one of ``home``. Pairs of rows tested."""
    same, tested = home is there, 0
    space, within = np.empty(TILE * TILE, dtype=np.float32), np.empty(TILE * TILE + 511, dtype=bool)
    rows_held: list[np.ndarray] = []
    cols_held: list[np.ndarray] = []

    def settle():
        if rows_held:
            rows, cols = np.concatenate(rows_held), np.concatenate(cols_held)
            rows_held.clear()
            cols_held.clear()
            if same:
                labels.join(rows, cols)
                return
            fresh = there.near[cols] < 0
            there.near[cols[fresh]] = rows[fresh]
            labels.join(rows, there.near[cols])

    least = np.float32(split.cosine - SLACK)
    for p, q in np.argwhere(meeting(home, there, split)).tolist():
        if same and q < p:
            continue
        a, b = home.tiles[p], there.tiles[q]
        u, v = home.bound[a], there.bound[b]
        size = len(u) * len(v)
        tested += size
        most = np.dot(u, v.T, out=space[:size].reshape(len(u), len(v)))
        ok = np.greater_equal(most, least, out=within[:size].reshape(most.shape))
        if same and p == q:
            ok &= np.arange(len(u))[:, None] < np.arange(len(v))[None, :]
        n = np.count_nonzero(ok)
        if not n:
            continue
        if n <= size // 50:
            within[size:size + 511] = False
            rows, cols = np.divmod(places(within[:-(-size // 512) * 512]), len(v))
            rows, cols = rows + a.start, cols + b.start
            keep = (unit(home.raw[rows]) * unit(there.raw[cols])).sum(axis=1) >= split.cosine
            keep &= home.rep[rows] != there.rep[cols]
            rows, cols = rows[keep], cols[keep]
            np.add.at(home.links, rows, there.copies[cols])
            np.add.at(there.links, cols, home.copies[rows])
        else:  # a crowded tile: whole products
            x, y = unit(home.raw[a]), unit(there.raw[b])
            cosine = x @ y.T
            i, j = np.nonzero(ok & (np.abs(cosine - split.cosine) < CLOSE))
            ok &= cosine >= split.cosine
            ok[i, j] = (x[i] * y[j]).sum(axis=1) >= split.cosine
            ok &= home.rep[a][:, None] != there.rep[b][None, :]
            home.links[a] += ok @ there.copies[b]
            there.links[b] += home.copies[a] @ ok
            own = Labels(len(x) + len(y))
            j = np.flatnonzero(ok.any(axis=0))
            i = ok[:, j].argmax(axis=0)
            rows, cols = [], []
            while len(i):  # connect each column to a row, then rows to a column of another label each, until none is left
                own.join(i, j + len(x))
                rows.append(i + a.start)
                cols.append(j + b.start)
                now = own.all()
                apart = ok & (now[:len(x)][:, None] != now[len(x):][None, :])
                i = np.flatnonzero(apart.any(axis=1))
                j = apart[i].argmax(axis=1)
            rows, cols = (np.concatenate([np.zeros(0, dtype=np.int64), *x]) for x in (rows, cols))
        rows_held.append(rows)
        cols_held.append(cols)
        if sum(map(len, rows_held)) >= HELD:
            settle()
    settle()
    return tested


def _links(batches, groups: list[list[str]], folder: str, split: Split, span: int):
    """(rep, links, root) of the rows compared by each task: of a group, going round, with the next ones up to half-way."""
    fs, root = pafs.FileSystem.from_uri(folder)
    n = len(groups)
    parts = -(-(n // 2 + 1) // span)

    def read(i: int) -> Rows:
        return Rows(fs, [f"{root}/{x}" for x in groups[i]], split)

    def linked(rows: Rows, near: np.ndarray):
        some = np.flatnonzero(rows.links)
        for k in range(0, len(some), 8192):
            s = some[k:k + 8192]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (rows.rep[s], rows.links[s], near[s])], names=["rep", "links", "root"])

    for batch in batches:
        for i, part in (divmod(x, parts) for x in batch.column(0).to_pylist()):
            home = read(i)
            labels = Labels(len(home.rep))
            for k in range(part * span, min(n // 2 + 1, (part + 1) * span)):
                if k and 2 * k == n and i >= k:
                    continue  # the other of the two compares them
                there = read((i + k) % n) if k else home
                compare(home, there, split, labels)
                if k:
                    yield from linked(there, home.rep[there.near])
            yield from linked(home, home.rep[labels.all()])


def _laid(rows: DataFrame, dims: int, n: int, size: int, folder: str) -> DataFrame:
    """The classes of one length: their vectors are written to ``folder``, their names, files and cells are returned."""
    pivots = np.zeros((0, dims))
    if n > size:
        share = min(PIVOTS, n // min(size, TILE)) / n  # the vectors whose hash is among the least; copies have one hash
        near = rows.filter(F.col("e1") < int((share - 0.5) * 2.0 ** 64)).select("embedding").distinct().collect()  # about PIVOTS rows
        pivots = unit(np.array([r[0] for r in near])) if near else pivots

    classes = rows.groupBy("embedding").agg(F.min("vec_id").cast("long").alias("rep"), F.count(F.lit(1)).alias("copies")).select(
        "rep", "copies", *_hashes(), "embedding")
    kind = dict(rows.dtypes)["embedding"]
    located = classes.mapInArrow(partial(_located, pivots=pivots, dims=dims), f"cell int, {NAMES}, embedding {kind}")
    placed = located.repartitionByRange(-(-n // size), "cell", "e1")
    return stored(placed.mapInArrow(partial(_written, folder=folder, size=size), f"{NAMES}, cell int, file string"), "classes")


def _hashes():
    """Equal vectors have equal ones (negative zero is zero); of n others, two share both with probability below n^2 / 2^128."""
    return F.xxhash64("embedding").alias("e1"), F.xxhash64(F.lit(1), "embedding").alias("e2")


def _found(rows: DataFrame, dims: int, n: int, cosine: float, block_dims: int, chunk: int) -> tuple[DataFrame, DataFrame | None]:
    """The classes of one length, (rep, copies, e1, e2), and their (rep, links, root)."""
    spark = rows.sparkSession
    moments = np.zeros(dims * dims + dims + 1)
    for i, v in rows.select("embedding").mapInArrow(partial(_moments, dims=dims), "i long, v double").groupBy("i").agg(
            F.sum("v")).collect():  # dims x dims sums
        moments[i] = v
    split = Split(moments, dims, cosine, block_dims)

    size = min(chunk, max(SMALL, -(-n // GROUPS)))
    folder = scratch(spark, "vectors")
    fs, root = pafs.FileSystem.from_uri(folder)
    fs.create_dir(root, recursive=True)
    names = _laid(rows, dims, n, size, folder)
    groups, held = [], size
    for r in names.groupBy("file").agg(F.min("cell").alias("cell"), F.count(F.lit(1)).alias("n")).orderBy("cell", "file").collect():  # a row for each file
        if held + r["n"] > size:
            groups.append([])
            held = 0
        groups[-1].append(r["file"])
        held += r["n"]
    names = names.select("rep", "copies", "e1", "e2")
    if len(groups) == 1 and held == 1:  # a length of one vector (a class) has no links but between its copies
        return names, None

    half = len(groups) // 2 + 1
    span = max(1, min(SPAN, len(groups) * half // (8 * spark.sparkContext.defaultParallelism)))
    tasks = len(groups) * -(-half // span)
    return names, spark.range(0, tasks, 1, tasks).mapInArrow(
        partial(_links, groups=groups, folder=folder, split=split, span=span), LINKS)


def near_vectors(vectors: DataFrame, cosine: float = 0.9, block_dims: int = BLOCK_DIMS, chunk: int = CHUNK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding): how many other
    vectors have a cosine of at least ``cosine`` with it, and the smallest vec_id reachable."""
    vectors = vectors.select("vec_id", "embedding")
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    usable = F.coalesce(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & finite
                        & F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = vectors.filter(usable).withColumn("e1", _hashes()[0])
    lengths = rows.groupBy(F.size("embedding").alias("dims")).count().collect()  # a row for each length
    named = vectors.select("vec_id", *[F.when(usable, x).alias(name) for x, name in zip(_hashes(), ("e1", "e2"))])
    if not lengths:
        return _named(named, None)
    done = [_found(rows.filter(F.size("embedding") == r["dims"]), r["dims"], r["count"], cosine, block_dims, chunk) for r in sorted(lengths)]
    none = vectors.sparkSession.createDataFrame([], LINKS)
    found = stored(reduce(DataFrame.union, [x for _, x in done if x is not None], none), "links")
    return _named(named, found, reduce(DataFrame.union, [x for x, _ in done]))


def _named(vectors: DataFrame, found: DataFrame | None, classes: DataFrame | None = None) -> DataFrame:
    out = vectors
    if found is None:
        out = out.withColumn("n_links", F.lit(0).cast("long")).withColumn("component_id", F.col("vec_id"))
    else:
        linked = found.groupBy("rep").agg(F.sum("links").alias("links"))
        parts = components(found.select(F.col("rep").alias("u"), F.col("root").alias("v")), "components")
        named = classes.join(linked, "rep", "left").join(parts.withColumnRenamed("node", "rep"), "rep", "left").select(
            "e1", "e2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
            F.coalesce("component", "rep").alias("component"))
        out = out.join(named, ["e1", "e2"], "left").withColumn(
            "n_links", F.coalesce("links", F.lit(0).cast("long"))).withColumn("component_id", F.coalesce("component", "vec_id"))
    return out.select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
