"""Hard-negative mining with a GNAT-style multiway hyperplane tree.

Scores are inner products; a further component sqrt(M^2 - |x|^2) brings all vectors to the norm M, so that the
distance of an anchor (0 there) to a vector depends on their score alone, and a window of scores is an annulus
around the anchor. The tree's split points come from a bounded sample; every vector goes down to the nearest
split point of each node, and each split point stores the smallest and largest distance to the vectors of
every sibling subtree, over all rows. A sibling goes if, for any split point, that range doesn't meet the
distances that the annulus allows. Leaves are scanned exactly, in blocks of vectors and anchors.

Anchors first search their own leaf, which gives a floor for their positives; then all leaves the floor allows;
then the same for the negatives' windows. Equal vectors of a label are one entry with as many smallest ids as
a result can list, so a vector that a third of all rows share is one entry of its leaf, and anchors with equal
vectors search once.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firesight.llm.common import table, written
from firesight.llm.vectors import by_length, distinct_queries, distinct_vectors, integer_rows, products, sample

#: Vectors that the tree is fitted on, split points of a node, sampled vectors that a leaf may have.
SAMPLE, WAYS, LEAF = 8192, 8, 64
#: Vectors and anchors of a block of a leaf.
VECTORS, ANCHORS = 8192, 1024
POSITIVES = NEGATIVES = 5
SCALE, EVERY = 256, 100
#: The window of a negative's score, in hundredths of the positive's.
LOW, HIGH = 80, 100
#: Slack of distances against rounding, as a share of M.
SLACK = 1e-6


@dataclass
class Node:
    """A split: its points, per way the child (a node's place, or -1 - leaf), and the ranges of distances."""
    points: np.ndarray
    children: list[int] = field(default_factory=list)
    near: np.ndarray | None = None
    far: np.ndarray | None = None


class Tree:
    """Splits for each vector length; ``norm2`` is M^2. Lengths without sampled vectors are one leaf each."""

    def __init__(self, vectors: list[bytes], norm2: float, ways: int = WAYS, leaf: int = LEAF):
        self.norm2, self.ways, self.leaf = float(norm2), ways, leaf
        self.nodes: list[Node] = []
        self.leaves = 0
        self.roots = {}
        for _, x in by_length(pa.array(vectors, pa.binary())):
            self.roots[x.shape[1]] = self._split(np.unique(x, axis=0) if x.shape[1] else x[:1])

    def lengths(self, x: np.ndarray) -> np.ndarray:
        """The added component of each vector."""
        return np.sqrt(np.maximum(self.norm2 - (x.astype("f8") ** 2).sum(1), 0.0))

    def distances(self, points: np.ndarray, x: np.ndarray, anchors: bool = False) -> np.ndarray:
        """From each row of ``x`` to each point; an anchor's added component is 0 and its norm its own."""
        score = products(x, points).astype("f8")
        if anchors:
            square = (x.astype("f8") ** 2).sum(1)[:, None] + self.norm2 - 2 * score
        else:
            square = 2 * self.norm2 - 2 * score - 2 * self.lengths(x)[:, None] * self.lengths(points)[None, :]
        return np.sqrt(np.maximum(square, 0.0))

    def _split(self, x: np.ndarray) -> int:
        """Place of the node (or -1 - leaf) over the sampled vectors ``x``: split points far apart from each other."""
        if len(x) > self.leaf:
            some = x[np.linspace(0, len(x) - 1, min(len(x), 3 * self.ways)).astype(int)]
            chosen, gap = [0], self.distances(some[:1], some)[:, 0]
            while len(chosen) < self.ways and gap.max() > 0:
                chosen.append(int(gap.argmax()))
                gap = np.minimum(gap, self.distances(some[chosen[-1:]], some)[:, 0])
            nearest = self.distances(some[chosen], x).argmin(1)
            if len(chosen) > 1 and np.bincount(nearest).max() < len(x):
                at = len(self.nodes)
                self.nodes.append(node := Node(some[chosen]))
                node.children = [self._split(x[nearest == i]) for i in range(len(chosen))]
                return at
        self.leaves += 1
        return -self.leaves

    def place(self, x: np.ndarray, seen: dict | None = None) -> np.ndarray:
        """The leaf of each vector; ``seen`` collects each node's (near, far) distances by point and child."""
        out = np.full(len(x), -1 - x.shape[1] if x.shape[1] not in self.roots else 0, "i8")
        todo = [(self.roots[x.shape[1]], np.arange(len(x)))] if x.shape[1] in self.roots else []
        while todo:
            at, rows = todo.pop()
            if at < 0:
                out[rows] = -1 - at
                continue
            node = self.nodes[at]
            d = self.distances(node.points, x[rows])
            way = d.argmin(1)
            for j, child in enumerate(node.children):
                mine = way == j
                if not mine.any():
                    continue
                if seen is not None:
                    near, far = seen.setdefault(at, (np.full((len(d[0]),) * 2, np.inf), np.full((len(d[0]),) * 2, -np.inf)))
                    near[:, j] = np.minimum(near[:, j], d[mine].min(0))
                    far[:, j] = np.maximum(far[:, j], d[mine].max(0))
                todo.append((child, rows[mine]))
        return out

    def reach(self, x: np.ndarray, inner: np.ndarray, outer: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """(leaf, anchors) of all leaves that may hold a vector between an anchor's inner and outer distance."""
        if x.shape[1] not in self.roots:
            return [(-1 - x.shape[1], np.arange(len(x)))]
        out, todo, slack = [], [(self.roots[x.shape[1]], np.arange(len(x)))], SLACK * self.norm2 ** 0.5
        while todo:
            at, rows = todo.pop()
            if at < 0:
                out.append((-1 - at, rows))
                continue
            node = self.nodes[at]
            d = self.distances(node.points, x[rows], anchors=True)
            least = np.maximum(d - outer[rows][:, None], inner[rows][:, None] - d) - slack
            most = d + outer[rows][:, None] + slack
            for j, child in enumerate(node.children):
                stays = ((node.far[:, j] >= least) & (node.near[:, j] <= most)).all(1)
                if stays.any():
                    todo.append((child, rows[stays]))
        return out


PLACED = "r long, label long, v binary, ids array<long>, leaf long, node int, near binary, far binary"


def _placing(tree: Tree):
    """Vectors with their leaves, and a task's distance ranges as one row per node that it met."""
    def run(batches):
        seen: dict = {}
        for batch in batches:
            leaf = np.zeros(batch.num_rows, "i8")
            for at, x in by_length(batch.column("v")):
                leaf[at] = tree.place(x, seen)
            n = batch.num_rows
            yield pa.record_batch([*(batch.column(c) for c in ("r", "label", "v", "ids")), pa.array(leaf), pa.nulls(n, pa.int32()),
                                   pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())],
                                  names=["r", "label", "v", "ids", "leaf", "node", "near", "far"])
        n = len(seen)
        yield pa.record_batch([pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()),
                               pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.int64()), pa.array(list(seen), pa.int32()),
                               pa.array([a.tobytes() for a, _ in seen.values()], pa.binary()),
                               pa.array([b.tobytes() for _, b in seen.values()], pa.binary())],
                              names=["r", "label", "v", "ids", "leaf", "node", "near", "far"])
    return run


def _merged(part: pa.Table) -> pa.Table:
    """A node's ranges over all tasks."""
    near = np.min([np.frombuffer(x, "f8") for x in part.column("near").to_pylist()], axis=0)
    far = np.max([np.frombuffer(x, "f8") for x in part.column("far").to_pylist()], axis=0)
    return pa.table([part.column("node").slice(0, 1), pa.array([near.tobytes()], pa.binary()),
                     pa.array([far.tobytes()], pa.binary())], names=["node", "near", "far"])


def build(vectors: DataFrame) -> tuple[Tree, DataFrame]:
    """The tree with its ranges, and all vectors with their leaves (a written table)."""
    norm2 = vectors.select("v").mapInArrow(_norms, "norm2 long").agg(F.max("norm2")).first()[0] or 0
    tree = Tree(sample(vectors, SAMPLE), norm2)
    placed = written(vectors.select("r", "label", "v", "ids").mapInArrow(_placing(tree), PLACED), "negatives-placed")
    # one row per node of the tree, which the sample bounds
    for row in placed.filter("node is not null").groupBy("node").applyInArrow(
            _merged, "node int, near binary, far binary").collect():
        node = tree.nodes[row.node]
        shape = (len(node.points),) * 2
        node.near, node.far = (np.frombuffer(bytes(x), "f8").reshape(shape) for x in (row.near, row.far))
    for node in tree.nodes:  # no vector came here
        if node.near is None:
            node.near, node.far = (np.full((len(node.points),) * 2, x) for x in (np.inf, -np.inf))
    return tree, placed.filter("node is null").select("r", "label", "v", "ids", "leaf")


def _norms(batches):
    for batch in batches:
        yield pa.record_batch([pa.array([int((x ** 2).sum(1).max(initial=0)) for _, x in by_length(batch.column("v"))],
                                        pa.int64())], names=["norm2"])


ROUTED = "leaf long, q long, label long, v binary, lows array<long>, highs array<long>"
#: No bound on a score.
OPEN = 1 << 62


def _routing(tree: Tree, own: bool):
    """Anchors to the leaves that can hold a score in any of their windows, or to their own leaf only."""
    def run(batches):
        for batch in batches:
            lows, highs = batch.column("lows").to_pylist(), batch.column("highs").to_pylist()
            rows, leaves = [], []
            for at, x in by_length(batch.column("v")):
                if own:
                    visits = [(leaf, np.array([i])) for i, leaf in enumerate(tree.place(x).tolist())]
                else:
                    base = (x.astype("f8") ** 2).sum(1) + tree.norm2
                    low = np.array([float(min(lows[i])) for i in at])
                    high = np.array([float(max(highs[i])) for i in at])
                    visits = tree.reach(x, np.sqrt(np.maximum(base - 2 * high, 0)), np.sqrt(np.maximum(base - 2 * low, 0)))
                for leaf, who in visits:
                    rows.extend(at[who].tolist())
                    leaves.extend([leaf] * len(who))
            part = batch.select(["q", "label", "v", "lows", "highs"]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(leaves, pa.int64()), *part.columns],
                                             names=["leaf", "q", "label", "v", "lows", "highs"])
    return run


FOUND = "q long, w int, r long, least long, score long, same boolean"


def _scan(same_label: bool, keep: int):
    """A block of a leaf against a block of anchors: per anchor and window the ``keep`` best vectors."""
    def run(mine: pa.Table, asked: pa.Table) -> pa.Table:
        out = []
        label, r, least = (np.asarray(mine.column(c)) for c in ("label", "r", "least"))
        theirs = np.asarray(asked.column("label"))
        q, lows, highs = asked.column("q").to_pylist(), asked.column("lows").to_pylist(), asked.column("highs").to_pylist()
        by_size = {x.shape[1]: (at, x) for at, x in by_length(mine.column("v"))}
        for at, a in by_length(asked.column("v")):
            if a.shape[1] not in by_size:
                continue
            rows, x = by_size[a.shape[1]]
            score = products(a, x)
            for i, own, line in zip(at.tolist(), a, score):
                fits = (label[rows] == theirs[i]) == same_label
                for w, (low, high) in enumerate(zip(lows[i], highs[i])):
                    hit = np.flatnonzero(fits & (line >= low) & (line <= high))
                    hit = hit[np.lexsort((least[rows[hit]], -line[hit]))[:keep]]
                    out += [(q[i], w, int(r[rows[h]]), int(least[rows[h]]), int(line[h]), bool((x[h] == own).all())) for h in hit]
        cols = list(zip(*out)) if out else [()] * 6
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
        return pa.table([pa.array(c, t) for c, t in zip(cols, kinds)], names=["q", "w", "r", "least", "score", "same"])
    return run


def visit(tree: Tree, placed: DataFrame, anchors: DataFrame, same_label: bool, keep: int, own: bool = False) -> DataFrame:
    """q, w, r, score, same: per anchor and window the ``keep`` best vectors of its own (or another) label, ties to
    the smaller least id. ``anchors``: q, label, v, ``lows`` and ``highs`` (a score window each, ends included)."""
    routed = written(anchors.select("q", "label", "v", "lows", "highs").mapInArrow(_routing(tree, own), ROUTED), "negatives-routed")
    sizes = placed.groupBy("leaf").agg(F.count("*").alias("n")).join(
        routed.groupBy("leaf").agg(F.count("*").alias("m")), "leaf").select(
        "leaf", F.ceil(F.col("n") / VECTORS).cast("int").alias("pieces"), F.ceil(F.col("m") / ANCHORS).cast("int").alias("parts"))

    def one(key: str, count: str) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(1)), F.col(count)).cast("int")

    def each(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    mine = placed.join(sizes, "leaf").select("leaf", one("r", "pieces").alias("piece"), each("parts").alias("part"),
                                             "r", "label", "v", F.col("ids")[0].alias("least"))
    asked = routed.join(sizes, "leaf").select("leaf", each("pieces").alias("piece"), one("q", "parts").alias("part"),
                                              "q", "label", "v", "lows", "highs")
    key = ["leaf", "piece", "part"]
    found = mine.groupBy(*key).cogroup(asked.groupBy(*key)).applyInArrow(_scan(same_label, keep), FOUND)
    place = F.row_number().over(Window.partitionBy("q", "w").orderBy(F.desc("score"), "least", "r"))
    return found.withColumn("_n", place).filter(F.col("_n") <= keep).drop("_n")


def _listed(found: DataFrame, placed: DataFrame, keep: int) -> DataFrame:
    """Per anchor and window the ``keep`` best rows: ``best``, an array of (place, vec_id, score, same)."""
    rows = found.join(placed.select("r", "ids"), "r").select("q", "w", "score", "same", F.explode("ids").alias("vec_id"))
    place = F.row_number().over(Window.partitionBy("q", "w").orderBy(F.desc("score"), "vec_id", "same"))
    return rows.withColumn("_n", place).filter(F.col("_n") <= keep).groupBy("q", "w").agg(
        F.sort_array(F.collect_list(F.struct("_n", "vec_id", "score", "same"))).alias("best"))


def hard_negatives(rows: DataFrame, label: Column | None = None, every: int = EVERY, scale: int = SCALE,
                   positives: int = POSITIVES, negatives: int = NEGATIVES, id_col: str = "vec_id",
                   vector: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors: rows whose id is divisible by ``every``. Positives: an anchor's best ``positives`` other rows of its
    ``label`` (a column). Negatives: per positive the best ``negatives`` rows of other labels with
    80 * positive_score <= 100 * negative_score <= 100 * positive_score; ties go to the smaller id.

    Rows with a null id, label or vector or with a null or non-finite component take no part. Vectors of
    different length have no score and don't meet. Repeated rows count once; rows that share an id but
    not vector and label are rows of their own, and an anchor leaves out its own row only. Anchors without
    positives, and positives without negatives, give no rows; so does an empty table. Other columns aren't read.
    """
    label = F.col("label") if label is None else label
    taking = written(integer_rows(rows, scale, id_col, vector, label), "negatives-rows")
    asking = taking.filter(F.col("vec_id") % every == 0)
    anchors = distinct_queries(asking, "negatives-anchors")
    if anchors.isEmpty():
        return rows.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                                     "positive_score long, negative_score long")
    vectors = distinct_vectors(taking, positives + 1, "negatives-vectors")
    tree, placed = build(vectors)

    # positives: the own leaf's last needed score is a floor for all leaves
    whole = anchors.withColumns({"lows": F.array(F.lit(-OPEN)), "highs": F.array(F.lit(OPEN))})
    seeds = visit(tree, placed, whole, True, positives + 1, own=True)
    floors = seeds.groupBy("q").agg(F.when(F.count("*") == positives + 1, F.min("score")).alias("floor"))
    floored = anchors.join(floors, "q", "left").withColumns({
        "lows": F.array(F.coalesce("floor", F.lit(-OPEN))), "highs": F.array(F.lit(OPEN))})
    near = written(_listed(visit(tree, placed, floored, True, positives + 1), placed, positives + 1)
                   .select("q", F.col("best").alias("near")), "negatives-positives")

    # negatives: one window for each score of a positive
    scores = F.array_sort(F.array_distinct(F.transform("near", lambda p: p["score"])))
    windows = anchors.join(near, "q").select("q", "label", "v", F.filter(scores, lambda s: s >= 0).alias("highs")).filter(
        F.size("highs") > 0)
    low = F.transform("highs", lambda s: -F.floor(-(s * LOW) / F.lit(HIGH)).cast("long"))
    windows = written(windows.withColumn("lows", low), "negatives-windows")
    seeds = visit(tree, placed, windows, False, negatives, own=True)
    floors = seeds.groupBy("q", "w").agg(F.when(F.count("*") == negatives, F.min("score")).alias("floor")).filter(
        "floor is not null").groupBy("q").agg(F.map_from_entries(F.collect_list(F.struct("w", "floor"))).alias("floors"))
    raised = windows.join(floors, "q", "left").withColumn("lows", F.transform(
        "lows", lambda s, i: F.greatest(s, F.try_element_at("floors", i))))
    far = _listed(visit(tree, placed, raised, False, negatives), placed, negatives)
    far = far.join(windows.select("q", "highs"), "q").groupBy("q").agg(
        F.collect_list(F.struct(F.col("highs")[F.col("w")].alias("score"), "best")).alias("far"))

    # anchors of a hot vector are many rows of one key on the left, one row on the right: a join AQE can split
    mined = anchors.join(near, "q").join(far, "q").select("label", "v", "near", "far")
    answered = asking.select(F.col("vec_id").alias("anchor_id"), "label", "v").join(mined, ["label", "v"])
    others = F.slice(F.filter("near", lambda p: ~(p["same"] & (p["vec_id"] == F.col("anchor_id")))), 1, positives)
    pairs = answered.select("anchor_id", "far", F.explode(others).alias("p"))
    mine = F.filter("far", lambda f: f["score"] == F.col("p.score"))
    return pairs.select("anchor_id", F.col("p.vec_id").alias("positive_id"), F.col("p.score").alias("positive_score"),
                        F.posexplode(F.flatten(F.transform(mine, lambda f: f["best"])))).select(
        "anchor_id", "positive_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("col.vec_id").alias("negative_id"),
        "positive_score", F.col("col.score").alias("negative_score"))


def relabelled() -> Column:
    """The label after every seventh row has moved to the next of ten."""
    label = F.col("label").cast("long")
    return F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)


def op13_hard_negatives(spark, sf_dir):
    return hard_negatives(table(spark, sf_dir, "embeddings"), relabelled())


#: DuckDB twin.
ORACLE = f"""
WITH whole AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
    SELECT a.vec_id AS anchor_id, o.vec_id, a.label = o.label AS alike, list_dot_product(a.v::DOUBLE[], o.v::DOUBLE[])::BIGINT AS score
    FROM whole a JOIN whole o ON a.vec_id % {EVERY} = 0 AND a.vec_id <> o.vec_id),
positives AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS n FROM pairs WHERE alike)
    WHERE n <= {POSITIVES}),
negatives AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, o.vec_id AS negative_id, p.score AS positive_score, o.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY o.score DESC, o.vec_id) AS rank
    FROM positives p JOIN pairs o ON o.anchor_id = p.anchor_id AND NOT o.alike
    WHERE {LOW} * p.score <= 100 * o.score AND o.score <= p.score)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= {NEGATIVES}"""
