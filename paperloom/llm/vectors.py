"""Embedding near-dedup by product quantisation: coarse lists, residual codes, table distances, exact rerank."""

import hashlib
import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paperloom.llm.components import components
from paperloom.llm.shared import stored

# The index is fitted on at most SAMPLE vectors, those with the smallest hashes: at most LISTS coarse
# centroids, and CODES codewords in each of about SUBSPACES subspaces of the residuals.
SAMPLE, LISTS, CODES, SUBSPACES, STEPS = 16_384, 1024, 16, 16, 10
# Members of a shelf, on the average; short lists share one, long ones take several. In a tile, up to ASKERS times as
# many vectors ask a shelf, so that its members are sent seldom.
SHELF, ASKERS = 1024, 4


@dataclass(frozen=True)
class Index:
    """Coarse centroids (list, dim), codewords (subspace, code, width); vectors are padded to `dim` zeros."""

    centroids: np.ndarray
    codewords: np.ndarray
    dim: int

    def padded(self, vectors: np.ndarray) -> np.ndarray:
        return np.pad(vectors, ((0, 0), (0, self.dim - vectors.shape[1])))


def squared_distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * x @ centers.T + (centers * centers).sum(1)


def means(x: np.ndarray, k: int) -> np.ndarray:
    """Centres by Lloyd's algorithm, from evenly spread starting rows; an empty one stays where it is."""
    centers = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(STEPS):
        home = squared_distances(x, centers).argmin(1)
        sizes = np.bincount(home, minlength=k)
        sums = np.zeros_like(centers)
        np.add.at(sums, home, x)
        centers[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centers


def chained(centers: np.ndarray) -> np.ndarray:
    """The centres from near to near, each behind its nearest one of those before, so that neighbours share shelves."""
    far = squared_distances(centers, centers)
    order = [0]
    left = np.ones(len(centers), bool)
    left[0] = False
    while left.any():
        order.append(int(np.where(left, far[order[-1]], np.inf).argmin()))
        left[order[-1]] = False
    return centers[order]


def fit(vectors: np.ndarray, n_all: int) -> Index:
    """Index for `n_all` vectors from a sample of unit vectors."""
    subspaces = min(SUBSPACES, vectors.shape[1])
    dim = -(-vectors.shape[1] // subspaces) * subspaces
    x = np.pad(vectors, ((0, 0), (0, dim - vectors.shape[1])))
    centroids = chained(means(x, max(1, min(LISTS, math.isqrt(n_all), len(x)))))
    residuals = x - centroids[squared_distances(x, centroids).argmin(1)]
    parts = residuals.reshape(len(x), subspaces, -1)
    codewords = np.stack([means(parts[:, s], min(CODES, len(x))) for s in range(subspaces)])
    return Index(centroids, codewords, dim)


def unit_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, embedding, label) to (vec_id, label, dim, node, unit); no node for what links with nothing."""
    for batch in batches:
        rows = []
        for vec_id, embedding, label in zip(*[c.to_pylist() for c in batch.columns]):
            node = unit = None
            if label is not None and embedding and None not in embedding:
                x = np.array(embedding, np.float64)
                largest = float(np.abs(x).max()) if np.isfinite(x).all() else 0.0
                if largest > 0:
                    x = x + 0.0  # one zero
                    node = hashlib.blake2b(f"{label}/{len(x)}/".encode() + x.tobytes(), digest_size=16).digest()
                    # By a power of two, which costs no digit: squares of huge and of tiny components stay in range.
                    scaled = np.ldexp(x, -math.frexp(largest)[1])
                    unit = (scaled / np.sqrt((scaled * scaled).sum())).tobytes()
            rows.append((vec_id, label, len(embedding) if unit else None, node, unit))
        kinds = (batch.schema.field(0).type, batch.schema.field(2).type, pa.int32(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 5, kinds)],
            names=["vec_id", "label", "dim", "node", "unit"])


def probes(x: np.ndarray, home: np.ndarray, index: Index, cosine: float, lists: np.ndarray) -> np.ndarray:
    """Which of `lists` each vector probes: all that a vector within reach can be at home in, whatever way it lies.

    That a list is further off than the own one, in squares, changes by at most 2 * between per step.
    """
    reach, centers = math.sqrt(2 - 2 * cosine), index.centroids[lists]
    own = index.centroids[home]
    between = np.sqrt(np.maximum(squared_distances(own, centers), 0))
    return squared_distances(x, centers) - ((x - own) ** 2).sum(1)[:, None] <= 2 * reach * between + 1e-9


def encode_rows(index: Index, cosine: float) -> Callable:
    """(node, copies, label, dim, unit) with `list`, residual codes, their error and the lists to probe added."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        everywhere = np.arange(len(index.centroids))
        for batch in batches:
            if batch.num_rows:
                x = np.stack([np.pad(u, (0, index.dim - len(u)))
                              for u in (np.frombuffer(b, np.float64) for b in batch.column(4).to_pylist())])
                home = squared_distances(x, index.centroids).argmin(1)
                residuals = x - index.centroids[home]
                subspaces = len(index.codewords)
                parts = residuals.reshape(len(x), subspaces, -1)
                codes = np.stack([squared_distances(parts[:, s], index.codewords[s]).argmin(1) for s in range(subspaces)], 1)
                coded = index.codewords[np.arange(subspaces), codes].reshape(len(x), -1)
                error = np.linalg.norm(residuals - coded, axis=1)
                probed = probes(x, home, index, cosine, everywhere)
                probed[np.arange(len(x)), home] = True
                starts = np.concatenate(([0], probed.sum(1).cumsum()))
                asked = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(probed.nonzero()[1], pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(home, pa.int32()),
                     pa.array([c.astype(np.uint8).tobytes() for c in codes], pa.binary()), pa.array(error), asked],
                    names=[*batch.schema.names, "list", "codes", "error", "probes"])

    return run


def tile_links(index: Index, cosine: float) -> Callable:
    """For a tile: (node, n_links, root) of its vectors that have links, `root` the least node they reach in it."""
    reach = math.sqrt(2 - 2 * cosine)

    def vectors(rows: pa.Table) -> dict[str, np.ndarray]:
        unit = np.stack([np.frombuffer(u, np.float64) for u in rows["unit"].to_pylist()])
        return {
            "unit": unit, "x": np.pad(unit, ((0, 0), (0, index.dim - unit.shape[1]))),
            "list": rows["list"].to_numpy(), "error": rows["error"].to_numpy(), "copies": rows["copies"].to_numpy(),
            "codes": np.stack([np.frombuffer(c, np.uint8) for c in rows["codes"].to_pylist()]),
        }

    def links(q: dict, m: dict) -> np.ndarray:
        """Whether query and member are linked."""
        found = np.zeros((len(q["x"]), len(m["x"])), bool)
        words = index.codewords
        subspaces = len(words)
        # Distances to a coded member: |q - c|^2 - 2 (q, r) + (|r|^2 + 2 (c, r)), where (q, r) is looked up.
        tables = np.einsum("qsw,skw->sqk", q["x"].reshape(len(q["x"]), subspaces, -1), words)
        lists, at = np.unique(m["list"], return_inverse=True)
        probed = probes(q["x"], q["list"], index, cosine, lists)
        coded = words[np.arange(subspaces), m["codes"]].reshape(len(m["x"]), -1)
        fixed = (coded * coded).sum(1) + 2 * (coded * index.centroids[m["list"]]).sum(1)
        near = (reach + m["error"]) ** 2
        to_list = squared_distances(q["x"], index.centroids[lists])
        for k in range(len(lists)):
            members, queries = np.flatnonzero(at == k), np.flatnonzero(probed[:, k])
            if not len(queries):
                continue
            inner = np.zeros((len(queries), len(members)))
            for s in range(subspaces):
                inner += tables[s][queries][:, m["codes"][members, s]]
            distance = to_list[queries, k][:, None] - 2 * inner + fixed[members]
            asked = distance <= near[members] + 1e-9
            rows = np.flatnonzero(asked.any(1))
            if len(rows):
                exact = q["unit"][queries[rows]] @ m["unit"][members].T >= cosine
                found[np.ix_(queries[rows], members)] = exact & asked[rows]
        return found

    def run(rows: pa.Table) -> pa.Table:
        role = rows["role"].to_numpy()
        members, queries = rows.filter(pa.array(role != 1)), rows.filter(pa.array(role != 0))
        nodes: list[bytes] = []
        sums = np.zeros(0, np.int64)
        roots: list[bytes] = []
        if members.num_rows and queries.num_rows:
            q, m = vectors(queries), vectors(members)
            found = links(q, m)
            # Those at home here ask each other, so a pair of them counts where the lesser node asks.
            names = [np.array(t["node"].to_pylist(), object) for t in (queries, members)]
            at_home = np.flatnonzero(queries["at_home"].to_numpy())
            found[at_home] &= names[0][at_home, None] < names[1]
            if found.any():
                nodes, sums, roots = gathered(found, q["copies"], m["copies"], *names)
        return pa.table({"node": pa.array(nodes, pa.binary()), "n_links": pa.array(sums, pa.int64()),
                         "root": pa.array(roots, pa.binary())})

    def gathered(found, q_copies, m_copies, q_names, m_names):
        of_q, of_m = found @ m_copies, found.T @ q_copies
        left, right = np.flatnonzero(of_q), np.flatnonzero(of_m)
        names = [*q_names[left], *m_names[right]]
        by_rank = sorted(set(names))
        order = {n: i for i, n in enumerate(by_rank)}
        label = np.array([order[n] for n in names])
        some, root = found[np.ix_(left, right)], np.arange(len(order))
        while True:
            # A vector may stand on both sides.
            a, b = root[label[:len(left)]], root[label[len(left):]]
            new_a = np.minimum(a, np.where(some, b, len(order)).min(1))
            new_b = np.minimum(b, np.where(some, new_a[:, None], len(order)).min(0))
            new = root.copy()
            np.minimum.at(new, label, np.concatenate((new_a, new_b)))
            if (new == root).all():
                break
            root = new
        return names, np.concatenate((of_q[left], of_m[right])), [by_rank[r] for r in root[label].tolist()]

    return run


def tiles_of(encoded: DataFrame, n_lists: int) -> DataFrame:
    """Rows of `encoded` in the tiles where they meet: (label, dim, at, block, shelf), role 0 as a member, 1 as a
    query, 2 as both; `at_home` tells whether they are at home in the part `at` of their label.

    The lists of a label are gathered in parts of SHELF members or one long list. A vector asks its own part and
    those behind it that hold a list it probes. A part's members are dealt over shelves, those who ask it over
    blocks; each pair of shelf and block is a tile. A row is sent as often as there are such tiles, so rows grow with the
    pairs of vectors and lists probed. To the layout go at most `n_lists` numbers per label.
    """
    part = ["label", "dim"]
    order = W.partitionBy(*part).orderBy("list").rowsBetween(W.unboundedPreceding, -1)
    sizes = encoded.groupBy(*part, "list").agg(F.count("*").alias("members"))
    placed = stored(sizes.select(*part, "list", "members", F.floor(
        F.coalesce(F.sum("members").over(order), F.lit(0)) / SHELF).alias("home")), "placed")
    layout = placed.groupBy(*part).agg(F.map_from_entries(F.collect_list(F.struct("list", "home"))).alias("homes"))
    layout = stored(layout.select(*part, F.transform(
        F.sequence(F.lit(0), F.lit(n_lists - 1)), lambda i: F.col("homes")[i]).alias("homes")), "layout")
    home = F.get("homes", F.col("list"))
    asked = F.array_distinct(F.transform("probes", lambda p: F.get(F.col("homes"), p)))
    spread = encoded.join(layout, part).select(
        *[c for c in encoded.columns if c != "probes"], home.alias("home"),
        F.explode(F.filter(asked, lambda u: u >= home)).alias("at"))

    asking = spread.groupBy(*part, "at").agg(F.count("*").alias("asking"))
    members = placed.groupBy(*part, F.col("home").alias("at")).agg(F.sum("members").alias("members"))
    grid = stored(members.join(asking, [*part, "at"]).select(
        *part, "at", F.ceil(F.col("members") / SHELF).alias("shelves"), F.ceil(F.col("asking") / (ASKERS * SHELF)).alias("blocks")), "grid")

    at_home = F.col("home") == F.col("at")
    shelf, block = F.pmod(F.xxhash64("node"), "shelves"), F.pmod(F.xxhash64("node", F.lit("asks")), "blocks")

    def place(b, s, role):
        return F.struct(b.alias("block"), s.alias("shelf"), role.alias("role"))

    zero = F.lit(0).cast("long")
    queries = F.transform(F.sequence(zero, F.col("shelves") - 1), lambda s: place(
        block, s, F.when(at_home & (s == shelf), 2).otherwise(1)))
    elsewhere = F.filter(F.sequence(zero, F.col("blocks") - 1), lambda b: at_home & (b != block))
    as_member = F.transform(elsewhere, lambda b: place(b, shelf, F.lit(0)))
    return spread.join(grid, [*part, "at"]).select(
        *[c for c in spread.columns if c != "home"], at_home.alias("at_home"), F.inline(F.concat(queries, as_member)))


def near_vectors(rows: DataFrame, cosine: float = 0.93) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of `rows` (vec_id, embedding, label).

    Vectors of one label and one length are compared by cosine. Equal vectors of a label are one
    class with a count. Each class has a coarse list, residual codes, and the lists that it may have
    neighbours in; it is sent to the tiles of those lists alone, see `tiles_of`. In a tile, a vector asks the
    lists it probes by table lookups; a member whose coded distance, less its coding error, is within
    reach is checked by exact cosine. A tile hands on sums and one link per linked vector, never pairs.

    Vectors that are null, empty, zero, or hold null or non-finite components, and those without
    label, link with nothing. Equal rows link with each other. A null id counts as no id: it is kept
    only if no linked vector has an id, its component_id is then null. An empty table gives no rows.
    """
    kind = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    units = stored(rows.select("vec_id", F.col("embedding").cast("array<double>"), "label").mapInArrow(
        unit_rows, f"vec_id {kind['vec_id']}, label {kind['label']}, dim int, node binary, unit binary"), "units")
    classes = stored(units.where("node is not null").groupBy("node").agg(
        F.count("*").alias("copies"), F.first("label").alias("label"), F.first("dim").alias("dim"),
        F.first("unit").alias("unit"), F.min("vec_id").alias("least")), "classes")
    n, dim = classes.agg(F.count("*"), F.max("dim")).first()
    if not n:
        return units.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                            F.lit(True).alias("kept"))
    sample = classes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("unit").collect()
    index = fit(np.stack([np.pad(u, (0, dim - len(u))) for u in (np.frombuffer(r[0], np.float64) for r in sample)]), n)

    own = ["node", "copies", "label", "dim", "unit"]
    encoded = stored(classes.select(*own).mapInArrow(
        encode_rows(index, cosine), f"node binary, copies long, label {kind['label']}, dim int, unit binary, "
                                    "list int, codes binary, error double, probes array<int>"), "encoded")
    tiles = tiles_of(encoded, len(index.centroids))
    found = stored(tiles.groupBy("label", "dim", "at", "block", "shelf").applyInArrow(
        tile_links(index, cosine), "node binary, n_links long, root binary"), "links")

    counts = found.groupBy("node").agg(F.sum("n_links").alias("linked"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = classes.select("node", "copies", "least").join(counts, "node", "left").join(roots, "node", "left").select(
        "node", "least", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("root", "node").alias("root"))
    known = stored(known, "known")
    firsts = known.groupBy("root").agg(F.min("least").alias("component_id"))
    results = stored(known.join(firsts, "root").select("node", "n_links", "component_id"), "results")
    joined = units.select("vec_id", "node").join(results, "node", "left")
    first = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), first.alias("component_id"),
        F.col("vec_id").eqNullSafe(first).alias("kept"))
