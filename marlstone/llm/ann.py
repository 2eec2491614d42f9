"""Approximate nearest neighbours by balanced posting lists.

After SPANN (Chen et al. 2021): centroids are fitted on a bounded sample and
overfull clusters split; every vector goes to the list of its nearest centroid
and, if it lies near a boundary, to further ones (distance ratio and relative
neighbourhood rule). Queries rank the centroids, which are held in memory, and
keep the lists within a distance ratio of the nearest, a beam at most. Lists
travel in bundles, so that a query goes to each bundle once with its lists there,
and k rows come back for it, however many of them it meets. How
wide the beam must be depends on the table, so it is measured: some of its queries
are answered exactly, and the beam, then the distance ratio, grow until these find
the share ``recall`` of their true neighbours, and all but a few of them a fair share
each, so that a kind of query that is rare is not given up for the others. At worst all
lists are met. Where the
number of lists has reached its limit, lists grow with the table; one of over twice
``list_rows`` rows is then cut into cells around rows of its own, and a query meets
as many of its nearest cells as keep that recall, measured likewise. Bundles
beyond ``bundle_rows`` are cut into parts, so a task's size
is bounded however many vectors share a spot. Scores are inner products of the
original vectors in double precision, added up in the order of the components.

Inner product becomes Euclidean distance by one more coordinate, sqrt(M^2-|x|^2)
with M the largest norm; queries have 0 there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.common import saved, spread


#: Cells of a list have numbers below this.
UNITS = 1 << 20


@dataclass
class Centroids:
    points: np.ndarray

    @staticmethod
    def fit(sample: np.ndarray, lists: int, seed: int = 1) -> Centroids:
        rng = np.random.default_rng(seed)
        points = sample[rng.permutation(len(sample))[: max(1, lists)]].copy()
        for _ in range(10):
            own = nearest(sample, points)
            sums, n = np.zeros_like(points), np.bincount(own, minlength=len(points))
            np.add.at(sums, own, sample)
            points = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], points)
        for _ in range(4):  # split what holds over twice its share
            own = nearest(sample, points)
            n = np.bincount(own, minlength=len(points))
            more = []
            for c in np.flatnonzero(n > 2 * max(1, len(sample) / max(1, lists))):
                mine = sample[own == c]
                a = mine[rng.integers(len(mine))]
                b = mine[((mine - a) ** 2).sum(1).argmax()]
                side = ((mine - a) ** 2).sum(1) > ((mine - b) ** 2).sum(1)
                if side.any() and not side.all():
                    points[c] = mine[~side].mean(0)
                    more.append(mine[side].mean(0))
            if not more:
                break
            points = np.vstack([points, more])
        points = np.unique(points, axis=0)
        return Centroids(points)

    def search(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and squared distances of the beam nearest centroids of each row of x, nearest first.

        All centroids are ranked, by one matrix product: a walk of a neighbour graph
        would not come to those that lie in groups of their own.
        """
        d = squared(x, self.points)
        if beam < d.shape[1]:
            ids = np.argpartition(d, beam - 1, axis=1)[:, :beam]
            ids.sort(axis=1)
            order = np.argsort(np.take_along_axis(d, ids, 1), axis=1, kind="stable")
            ids = np.take_along_axis(ids, order, 1)
        else:
            ids = np.argsort(d, axis=1, kind="stable")
        return ids, np.take_along_axis(d, ids, 1)


def squared(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    return np.maximum((x**2).sum(1)[:, None] - 2 * x @ points.T + (points**2).sum(1), 0)


def nearest(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    return np.concatenate([squared(x[i : i + 4096], points).argmin(1) for i in range(0, len(x), 4096)]) if len(x) else np.zeros(0, np.int64)


def _lifted(v: pd.Series, top: float) -> np.ndarray:
    x = np.stack(v.to_numpy()).astype(np.float64)
    return np.hstack([x, np.sqrt(np.maximum(top - (x**2).sum(1), 0))[:, None]])


def _first_of_equals(x: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first k+1 rows of each value, in order of ids: no others of equal vectors can be among k neighbours (a query may be one itself)."""
    raw, size = x.tobytes(), x.shape[1] * x.itemsize
    seen: dict[bytes, int] = {}
    count = [seen.__setitem__(v, n := seen.get(v, 0) + 1) or n for v in (raw[i : i + size] for i in range(0, len(raw), size))]
    keep = np.array(count) <= k + 1
    return (x, ids) if keep.all() else (x[keep], ids[keep])


def _nearest(q: np.ndarray, own: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> pd.DataFrame:
    """(query_id, vec_id, score): of rows x, ordered by ids, the k of largest inner product with each query, other than itself.

    A matrix product names the candidates, with a margin for its rounding; their
    scores are then added up component by component, so that a pair has one score
    wherever it is met, equal vectors have equal ones, and ties go to the smaller id.
    """
    s = q @ x.T
    s[own[:, None] == ids[None]] = -np.inf
    if s.shape[1] > k:
        least = np.partition(s, -k, axis=1)[:, -k]
        margin = 1e-13 * x.shape[1] * np.linalg.norm(q, axis=1) * np.linalg.norm(x, axis=1).max()
        r, c = np.nonzero((s >= (least - margin)[:, None]) & (s > -np.inf))
    else:
        r, c = np.nonzero(s > -np.inf)
    exact = np.concatenate([np.cumsum(q[r[i : i + 20_000]] * x[c[i : i + 20_000]], axis=1)[:, -1] for i in range(0, len(r), 20_000)]) if len(r) else np.zeros(0)
    by = np.lexsort((c, -exact, r))
    r, c, exact = r[by], c[by], exact[by]
    first = np.arange(len(r)) - np.searchsorted(r, r, "left") < k
    return pd.DataFrame({"query_id": own[r[first]], "vec_id": ids[c[first]], "score": exact[first]})


def _exact(rows: DataFrame, asked: pd.DataFrame, k: int) -> pd.DataFrame:
    """(query_id, vec_id, score): the k nearest rows of each of a few queries, by one scan that keeps k a query in each task."""
    own, q = asked["vec_id"].to_numpy(), np.stack(asked["v"].to_numpy())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = None
        for b in batches:
            if b.empty:
                continue
            b = b.sort_values("vec_id")
            x, ids = _first_of_equals(np.stack(b["v"].to_numpy()), b["vec_id"].to_numpy(), k)
            new = _nearest(q, own, x, ids, k)
            best = new if best is None else _merged([best, new], k)
        if best is not None:
            yield best

    return _merged([rows.mapInPandas(run, "query_id long, vec_id long, score double").toPandas()], k)


def _merged(parts: list[pd.DataFrame], k: int) -> pd.DataFrame:
    """The k best rows of each query_id in parts, each vec_id once."""
    rows = pd.concat(parts, ignore_index=True).sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
    return rows.drop_duplicates(["query_id", "vec_id"]).groupby("query_id").head(k)


def _by_list(spark, held: np.ndarray, cells: np.ndarray, bundle_rows: int) -> DataFrame:
    """(list, cells, rate, parts) of the lists that are cut into cells; a row a list, at most a few times max_lists."""
    at = np.flatnonzero(cells > 1)
    rows = pd.DataFrame({"list": at, "rate": cells[at] / held[at], "parts": -(-held[at] // bundle_rows)})
    return F.broadcast(spark.createDataFrame(rows, "list int, rate double, parts int"))


def _pivots(posted: DataFrame, held: np.ndarray, cells: np.ndarray, bundle_rows: int) -> DataFrame:
    """(list, cell, p, parts): rows of large lists drawn by hash, about one a cell; a list of which none is drawn stays whole."""
    info = _by_list(posted.sparkSession, held, cells, bundle_rows)
    draw = F.pmod(F.xxhash64("vec_id", "list"), F.lit(1 << 30))
    drawn = posted.join(info, "list").where(draw < F.col("rate") * (1 << 30))
    nth = F.row_number().over(Window.partitionBy("list").orderBy(F.xxhash64("vec_id", "list"), "vec_id"))
    return saved(drawn.select("list", (nth - 1).alias("cell"), F.col("v").alias("p"), "parts"))


def _celled(posted: DataFrame, pivots: DataFrame, held: np.ndarray, cells: np.ndarray, bundle_rows: int) -> DataFrame:
    """posted with cell: the nearest pivot of the row's list, 0 in lists without."""
    cut = pivots.select("list", "parts").distinct()
    mine = posted.join(F.broadcast(cut), "list").withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
    theirs = pivots.select(F.col("list").alias("l"), F.col("cell").alias("cell"), F.col("p").alias("p"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("k"))

    def place(rows: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or near.empty:
            return rows.assign(cell=0)[["vec_id", "v", "list", "cell"]]
        near = near.sort_values("cell")
        cell = nearest(np.stack(rows["v"].to_numpy()), np.stack(near["p"].to_numpy()))
        return rows.assign(cell=near["cell"].to_numpy()[cell])[["vec_id", "v", "list", "cell"]]

    out = mine.groupBy("list", "part").cogroup(theirs.groupBy("l", "k")).applyInPandas(place, "vec_id long, v array<double>, list int, cell int")
    rest = posted.join(F.broadcast(cut.select("list")), "list", "left_anti")
    return saved(rest.select("vec_id", "v", "list", F.lit(0).alias("cell")).union(out))


def _order(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Cells by nearness for each query: by the inner product that they are searched for, less half the square of their centre (the order of Euclidean distance)."""
    return np.argsort(squared(q, p), axis=1, kind="stable")


def _near_cells(asks: DataFrame, pivots: DataFrame, most: int, query_rows: int) -> DataFrame:
    """(query_id, q, unit): of each asked list (query_id, q, list) the most nearest cells."""
    load = asks.groupBy("list").agg(F.ceil(F.count("*") / query_rows).cast("int").alias("blocks"))
    left = asks.join(load, "list").withColumn("block", F.pmod(F.xxhash64("query_id"), F.col("blocks")).cast("int")).select("query_id", "q", "list", "block")
    right = pivots.join(load.select(F.col("list").alias("l"), F.col("blocks").alias("n")), F.col("list") == F.col("l")).select("l", "cell", "p", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("k"))

    def pick(rows: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:
            return pd.DataFrame({"query_id": [], "q": [], "unit": []}).astype({"query_id": "int64", "unit": "int64"})
        at = int(rows["list"].iloc[0]) * UNITS
        if near.empty:
            return rows.assign(unit=at)[["query_id", "q", "unit"]]
        near = near.sort_values("cell")
        order = _order(np.stack(rows["q"].to_numpy()), np.stack(near["p"].to_numpy()))[:, :most]
        who = np.repeat(np.arange(len(rows)), order.shape[1])
        return pd.DataFrame({"query_id": rows["query_id"].to_numpy()[who], "q": rows["q"].to_numpy()[who], "unit": at + near["cell"].to_numpy()[order.ravel()]})

    return left.groupBy("list", "block").cogroup(right.groupBy("l", "k")).applyInPandas(pick, "query_id long, q array<double>, unit long")


def _cells_needed(spark, posted: DataFrame, pivots: DataFrame, asks: list[tuple], met: set, true: pd.DataFrame, cells: np.ndarray, recall: float) -> int:
    """How many nearest cells of each list the pilots must meet to find the share recall of their true neighbours; asks: their (query_id, list, q) of cut lists, met: (query_id, list) of others."""
    known = F.broadcast(spark.createDataFrame(true[["vec_id"]].drop_duplicates(), "vec_id long"))
    homes: dict[int, list[tuple[int, int]]] = {}
    for r in posted.join(known, "vec_id").select("vec_id", "list", "cell").collect():  # pilots times k rows, and their replicas
        homes.setdefault(r["vec_id"], []).append((r["list"], r["cell"]))
    wanted: dict[int, list[int]] = {}
    for q, v in zip(true["query_id"].tolist(), true["vec_id"].tolist(), strict=True):
        wanted.setdefault(q, []).append(v)

    def ranks(rows: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
        out = []
        if not rows.empty and not near.empty:
            near = near.sort_values("cell")
            order = _order(np.stack(rows["q"].to_numpy()), np.stack(near["p"].to_numpy()))
            at, place = int(rows["list"].iloc[0]), np.argsort(order, axis=1)
            row_of = {c: i for i, c in enumerate(near["cell"].tolist())}
            for n, q in enumerate(rows["query_id"].tolist()):
                out += [(q, v, int(place[n, row_of[c]])) for v in wanted[q] for lst, c in homes[v] if lst == at]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "rank"])

    asked = spark.createDataFrame(asks, "query_id long, list int, q array<double>") if asks else None
    found = asked.groupBy("list").cogroup(pivots.groupBy("list")).applyInPandas(ranks, "query_id long, vec_id long, rank int").groupBy("query_id", "vec_id").agg(F.min("rank").alias("rank")).collect() if asks else []
    least = {(r["query_id"], r["vec_id"]): r["rank"] for r in found}
    need = [0 if any((q, lst) in met for lst, _ in homes[v]) else least.get((q, v), np.inf) for q, vs in wanted.items() for v in vs]
    need, whose = np.array(need, float), np.repeat(np.arange(len(wanted)), [len(vs) for vs in wanted.values()])
    ranks_met = np.unique(need[np.isfinite(need)])
    lo, hi = 0, len(ranks_met)
    while lo < hi:  # the fewest cells that serve
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if _served(need <= ranks_met[mid], whose, recall) else (mid + 1, hi)
    return int(ranks_met[lo]) + 1 if lo < len(ranks_met) else int(cells.max()) + 1000


def _served(found: np.ndarray, whose: np.ndarray, recall: float, least: float = 0.75, apart: float = 0.02) -> bool:
    """Whether the share recall of all true neighbours is found, and the share least of each pilot's own, but for the share apart of pilots; whose: the pilot of each."""
    own = np.bincount(whose, found) / np.maximum(np.bincount(whose), 1)
    own = own[np.bincount(whose) > 0]
    return bool(found.mean() >= recall and (own < least).mean() <= apart)


def usable(vectors: DataFrame, vector: str) -> DataFrame:
    ok = F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0), F.lit(False))
    return vectors.where(F.col("vec_id").isNotNull() & ok)


def search(vectors: DataFrame, is_query, k: int = 20, vector: str = "embedding", list_rows: int = 2000, max_lists: int = 4096, sample_rows: int = 60_000, close: float = 1.12, replicas: int = 6, probe: float = 1.8, beam: int = 64, bundle_rows: int = 20_000, query_rows: int = 20_000, recall: float = 0.95, pilots: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of vectors where is_query holds its k nearest found among all other rows.

    Null or zero vectors, those with null or non-finite components or of another
    dimension than most, and rows with a null vec_id take no part. Rows of one
    vec_id count once. Ties go to the smaller vec_id; an empty table gives an
    empty result. Centroids are fitted on at most sample_rows rows, every row is
    indexed. close, probe: distance ratios for replicating and for searching.
    probe and beam are where the search starts; they grow until ``pilots`` queries,
    answered exactly in one scan of the table, find the share recall of their k.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, vector).groupBy("vec_id").agg(F.min(F.col(vector).cast("array<double>")).alias("v"))
    rows = saved(rows)
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("top")).sort(F.desc("n"), "d").limit(1).collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not sizes:
        return spark.createDataFrame([], schema)
    dim, n, top = sizes[0]
    rows = rows.where(F.size("v") == dim)
    lists = max(1, min(max_lists, -(-n * 8 // list_rows)))
    part = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < int(min(1.0, 1.2 * sample_rows / n) * (1 << 30))).limit(sample_rows)
    centroids = Centroids.fit(_lifted(part.toPandas().sort_values("vec_id")["v"], top), lists)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        points = centroids.points
        for b in batches:
            if b.empty:
                continue
            x = _lifted(b["v"], top)
            d = squared(x, points)
            m = min(replicas, len(points))
            order = np.argsort(d, axis=1, kind="stable")[:, :m]
            near = np.sqrt(np.take_along_axis(d, order, 1))
            keep = near <= close * near[:, :1]
            for j in range(1, m):  # relative neighbourhood rule: not beside a chosen centroid that is nearer to this one
                for i in range(j):
                    between = np.sqrt(((points[order[:, j]] - points[order[:, i]]) ** 2).sum(1))
                    keep[:, j] &= ~(keep[:, i] & (between < 0.5 * near[:, j]))
            r, c = np.nonzero(keep)
            yield pd.DataFrame({"vec_id": b["vec_id"].to_numpy()[r], "v": b["v"].to_numpy()[r], "list": order[r, c]})

    posted = saved(rows.mapInPandas(assign, "vec_id long, v array<double>, list int"))
    counts = {r["list"]: r["n"] for r in posted.groupBy("list").agg(F.count("*").alias("n")).collect()}  # at most a few times max_lists rows
    held = np.zeros(len(centroids.points), np.int64)
    for c, size in counts.items():
        held[c] = size
    cells = np.where(held > 2 * list_rows, -(-held // list_rows), 1)
    big = cells > 1
    pivots = _pivots(posted, held, cells, bundle_rows) if big.any() else None
    posted = _celled(posted, pivots, held, cells, bundle_rows) if big.any() else posted.withColumn("cell", F.lit(0))
    lists_recall = recall + (1 - recall) / 2 if big.any() else recall

    pilot = rows.where(is_query).orderBy(F.xxhash64("vec_id"), "vec_id").limit(pilots).toPandas()
    if pilot.empty:
        return spark.createDataFrame([], schema)
    true = _exact(rows, pilot, k)
    homes: dict[int, list[int]] = {}
    for r in posted.join(F.broadcast(spark.createDataFrame(true[["vec_id"]].drop_duplicates(), "vec_id long")), "vec_id").select("vec_id", "list").collect():
        homes.setdefault(r["vec_id"], []).append(r["list"])
    number = {q: i for i, q in enumerate(pilot["vec_id"])}
    whose = true["query_id"].map(number).to_numpy()

    def kept(v: pd.Series, beam: int, probe: float) -> tuple[np.ndarray, np.ndarray]:
        """Lists by nearness for each query, and which of them it meets."""
        x = np.hstack([np.stack(v.to_numpy()).astype(np.float64), np.zeros((len(v), 1))])
        scale = np.sqrt(top) / np.linalg.norm(x, axis=1)  # nearness doesn't depend on the query's length
        ids, d = centroids.search(x * scale[:, None], beam)
        enough = np.cumsum(held[ids], axis=1) - held[ids] < 4 * k
        return ids, ((np.sqrt(d) <= probe * np.sqrt(d[:, :1])) | enough) & np.isfinite(d)

    while len(true):
        ids, keep = kept(pilot["v"], beam, probe)
        met = np.zeros((len(pilot), len(held)), bool)
        r, c = np.nonzero(keep)
        met[r, ids[r, c]] = True
        found = np.array([met[i, homes[v]].any() for i, v in zip(whose, true["vec_id"], strict=True)])
        if _served(found, whose, lists_recall) or (beam >= len(held) and probe == 1e300):
            break
        if beam < len(held) and keep[:, -1].any():
            beam = -(-beam * 5 // 4)
        else:
            probe = probe * 1.25 if probe < 100 else 1e300
            beam = beam if probe < 1e300 else len(held)

    near_cells = 1
    if big.any() and len(true):
        ids, keep = kept(pilot["v"], beam, probe)
        asks = [(int(pilot["vec_id"][r]), int(ids[r, c]), [float(x) for x in pilot["v"][r]]) for r, c in zip(*np.nonzero(keep & big[ids]), strict=True)]
        met = {(int(pilot["vec_id"][r]), int(ids[r, c])) for r, c in zip(*np.nonzero(keep & ~big[ids]), strict=True)}
        near_cells = _cells_needed(spark, posted, pivots, asks, met, true, cells, recall)

    loose = np.where(big, 0, held)
    bundles = max(32, -(-int(loose.sum()) // bundle_rows))
    bundle = np.minimum((np.cumsum(loose) - loose / 2) * bundles // max(1, loose.sum()), bundles - 1).astype(int)  # of about equal rows
    more = max(1, -(-int(held[big].sum()) // bundle_rows))

    def probes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lo in range(0, len(b), 512):
                part = b.iloc[lo : lo + 512]
                ids, keep = kept(part["v"], beam, probe)
                units_of: dict[tuple[int, int, int], list[int]] = {}
                for r, c in zip(*np.nonzero(keep), strict=True):
                    at = int(ids[r, c])
                    key = (r, -1, at) if big[at] else (r, int(bundle[at]), -1)
                    units_of.setdefault(key, []).append(at * UNITS)
                r = [k[0] for k in units_of]
                yield pd.DataFrame({"query_id": part["vec_id"].to_numpy()[r], "q": part["v"].to_numpy()[r], "bundle": [k[1] for k in units_of], "list": [k[2] for k in units_of], "units": list(units_of.values())})

    asked = rows.where(is_query).repartition(spread(vectors)).mapInPandas(probes, "query_id long, q array<double>, bundle int, list int, units array<long>")
    asked = saved(asked)
    unit_bundle = lambda unit: (F.lit(bundles) + F.pmod(F.xxhash64(unit), F.lit(more))).cast("int")
    if big.any():
        cut_units = _near_cells(asked.where("list >= 0"), pivots, near_cells, query_rows).withColumn("bundle", unit_bundle("unit"))
        gathered = cut_units.groupBy("query_id", "bundle").agg(F.first("q").alias("q"), F.collect_list("unit").alias("units"))
        asked = saved(asked.where("list < 0").select("query_id", "q", "bundle", "units").unionByName(gathered))
    cut = lambda id_, per, n: F.pmod(F.xxhash64(id_), F.ceil(n / F.lit(per))).cast("int")
    posted = posted.withColumn("unit", F.col("list").cast("long") * UNITS + F.col("cell"))
    posted = posted.join(F.broadcast(spark.createDataFrame(pd.DataFrame({"list": np.arange(len(bundle)), "of": np.where(big, -1, bundle)}), "list int, of int")), "list")
    posted = posted.withColumn("bundle", F.when(F.col("of") >= 0, F.col("of")).otherwise(unit_bundle("unit")))
    loads = posted.groupBy("bundle").agg(F.count("*").alias("n")).join(asked.groupBy("bundle").agg(F.count("*").alias("m")), "bundle")
    loads = saved(loads)  # a row per bundle
    vs = posted.join(F.broadcast(loads), "bundle").withColumn("part", cut("vec_id", bundle_rows, F.col("n"))).withColumn("block", F.explode(F.sequence(F.lit(0), F.ceil(F.col("m") / query_rows).cast("int") - 1))).select("bundle", "part", "block", "unit", "vec_id", "v")
    qs = asked.join(F.broadcast(loads), "bundle").withColumn("block", cut("query_id", query_rows, F.col("m"))).withColumn("part", F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / bundle_rows).cast("int") - 1))).select("bundle", "part", "block", "query_id", "q", "units")

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
        if not len(left) or not len(right):
            return none
        right = right.sort_values(["unit", "vec_id"])
        ids, x, of = right["vec_id"].to_numpy(), np.stack(right["v"].to_numpy()), right["unit"].to_numpy()
        own, q = left["query_id"].to_numpy(), np.stack(left["q"].to_numpy())
        met = left["units"].to_numpy()
        who, which = np.repeat(np.arange(len(left)), [len(m) for m in met]), np.concatenate(met)
        by = np.argsort(which, kind="stable")
        who, which = who[by], which[by]
        best, new, size = none, [], 0
        for c in np.unique(which):
            at = slice(np.searchsorted(of, c, "left"), np.searchsorted(of, c, "right"))
            mine = who[np.searchsorted(which, c, "left") : np.searchsorted(which, c, "right")]
            if at.stop == at.start:
                continue
            there, there_ids = _first_of_equals(x[at], ids[at], k)
            for lo in range(0, len(mine), 256):
                asks = mine[lo : lo + 256]
                new.append(_nearest(q[asks], own[asks], there, there_ids, k))
                size += len(new[-1])
            if size > 1_000_000:
                best, new, size = _merged([best, *new], k), [], 0
        return _merged([best, *new], k)

    key = ["bundle", "part", "block"]
    scored = qs.groupBy(*key).cogroup(vs.groupBy(*key)).applyInPandas(score, "query_id long, vec_id long, score double")
    unique = scored.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return unique.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
