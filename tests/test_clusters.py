import random
import time
from collections import Counter, defaultdict
from itertools import combinations
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from review_topics import session
from review_topics.operators import components as CC
from review_topics.operators import density, document_neighbours, neighbours, spanning
from review_topics.plans import fit
from review_topics.plans.model import FitParams
from review_topics.queries import common, topic_queries


def find_components(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {x: root(x) for x in parent}


GRAPHS = {
    "random": [(random.Random(1).randrange(60), b) for b in range(60)],
    "chain": [(i, i + 1) for i in range(40)],
    "hub": [(99, i) for i in range(50)] + [(200, 201)],
    "small_hub": [(0, i) for i in range(1, 50)],
    "loops": [(1, 1), (2, 3), (3, 2)],
}


@pytest.mark.parametrize(
    "name, split_hubs", [("random", False), ("chain", False), ("hub", True), ("small_hub", True), ("loops", False)]
)
def test_components_match_union_find(spark, monkeypatch, name, split_hubs):
    if split_hubs:
        monkeypatch.setattr(session, "HOT_SHARE", 4)
    edges = [(a, b) for a, b in GRAPHS[name]]
    out = CC.components(spark.createDataFrame(edges, "u long, v long")).collect()
    got = {r["node"]: r["component"] for r in out}
    assert len(got) == len(out)
    assert got == find_components([(a, b) for a, b in edges if a != b])


def test_hot_lookup_equals_a_plain_join(spark, monkeypatch):
    monkeypatch.setattr(session, "HOT_SHARE", 5)
    left = spark.range(3000).select(F.col("id").alias("row"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 100).alias("k"))
    right = left.groupBy("k").agg(F.count("*").alias("n"), F.max("row").alias("top")).where("k <> 7")
    got = session.hot_lookup(left, right, ["k"], "n")
    want = left.join(right.drop("n"), "k").select("row", "k", "top")
    assert sorted(got.select("row", "k", "top").collect()) == sorted(want.collect())


def random_cells(seed, k=3, n=400, spread=7):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        centre = rng.choice([(0, 0, 0), (20, 0, 0), (0, 25, 3)])
        rows.append((i, *[int(rng.gauss(c, spread / 4 if i % 3 else 0.4)) for c in centre[:k]]))
    return rows


def graph_of(spark, rows, reach2, k=3):
    points = spark.createDataFrame(rows, "doc_id long, " + ", ".join(f"{c} int" for c in neighbours.cell_columns(k)))
    cells = session.cut_lineage(neighbours.grid_cells(points, k))
    edges = session.cut_lineage(neighbours.neighbour_edges(cells, k, reach2))
    return points, cells, edges


def distance2(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def brute_clusters(rows, min_pts, level2, min_size):
    """Flat density clusters over the points themselves."""
    at = {r[0]: r[1:] for r in rows}
    near = {i: [j for j in at if distance2(at[i], at[j]) <= level2] for i in at}
    core = {i for i in at if len(near[i]) >= min_pts}
    found = find_components([(i, i) for i in core] + [(i, j) for i in core for j in near[i] if j in core])
    size = Counter(found.values())
    return {i: found[i] if i in core and size[found[i]] >= min_size else None for i in at}


@pytest.mark.parametrize("reach2", [1, 2, 4])
def test_edges_are_all_pairs_within_reach(spark, reach2):
    _, cells, edges = graph_of(spark, random_cells(3), reach2)
    at = {r["cell_id"]: (r["c0"], r["c1"], r["c2"]) for r in cells.collect()}
    want = {(min(a, b), max(a, b), distance2(at[a], at[b])) for a, b in combinations(at, 2) if distance2(at[a], at[b]) <= reach2}
    rows = edges.collect()
    got = {(min(r["src"], r["dst"]), max(r["src"], r["dst"]), r["d2"]) for r in rows}
    assert got == want and len(rows) == len(want)


def test_half_offsets_hold_one_of_each_pair():
    steps = neighbours.half_offsets(5, 2)
    assert len(steps) == 25 and not {tuple(-x for x in s) for s in steps} & set(steps)


@pytest.mark.parametrize("seed", [1, 2])
def test_density_matches_brute_force_on_points(spark, seed):
    rows = random_cells(seed)
    points, cells, edges = graph_of(spark, rows, 2)
    clustered = density.cluster_density(cells, edges, 8, 2, 20)
    out = density.label_points(points, cells, clustered, 3, 2).collect()
    assert {r["doc_id"]: r["cluster"] for r in out} == brute_clusters(rows, 8, 2, 20)
    assert all(0 <= r["probability"] <= 1 and (r["cluster"] is not None or r["probability"] == 0) for r in out)


def test_everything_is_an_outlier_when_groups_are_small(spark):
    points, cells, edges = graph_of(spark, random_cells(1), 2)
    clustered = density.cluster_density(cells, edges, 8, 2, 10_000)
    assert {r["cluster"] for r in density.label_points(points, cells, clustered, 3, 2).collect()} == {None}


def brute_forest(links):
    """Links in order of weight and ends, each kept if its ends are not joined yet."""
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    kept = set()
    for w, u, v in sorted({(w, min(u, v), max(u, v)) for u, v, w in links if u != v}):
        if root(u) != root(v):
            parent[root(u)] = root(v)
            kept.add((u, v, w))
    return kept


@pytest.mark.parametrize("name, hot, local", [("random", 1000, 0), ("ties", 1000, 30), ("ties", 1000, 10**6), ("hub", 4, 0), ("chain", 1000, 9), ("none", 1000, 10)])
def test_spanning_forest_is_that_of_sorted_links(spark, monkeypatch, name, hot, local):
    monkeypatch.setattr(session, "HOT_SHARE", hot)
    monkeypatch.setattr(spanning, "LOCAL_LINKS", local)
    rng = random.Random(len(name))
    links = {
        "random": [(rng.randrange(60), rng.randrange(60), rng.randrange(30)) for _ in range(240)],
        "ties": [(rng.randrange(25), rng.randrange(25), rng.randrange(2)) for _ in range(120)],
        "hub": [(99, i, i % 3) for i in range(60)] + [(i, i + 1, 1) for i in range(0, 60, 2)] + [(200, 201, 0)],
        "chain": [(i, i + 1, (i * 7) % 5) for i in range(50)] + [(3, 3, 0), (4, 5, 9), (5, 4, 0)],
        "none": [],
    }[name]
    out = spanning.spanning_forest(spark.createDataFrame(links, "u long, v long, w int")).collect()
    assert {tuple(r) for r in out} == brute_forest(links) and len(out) == len(brute_forest(links))


def test_cut_forest_gives_the_flat_clusters_of_every_distance(spark):
    rows = random_cells(4, n=200)
    _, cells, edges = graph_of(spark, rows, 4)
    _, nodes, forest = density.reach_forest(cells, edges, 6, 4)
    for level in (1, 4):
        cut = {r["node"]: r["component"] for r in spanning.cut_forest(nodes, forest, level).collect()}
        flat = density.cluster_density(cells, edges.where(F.col("d2") <= level), 6, level, 1).where("cluster is not null")
        assert cut == {r["cell_id"]: r["cluster"] for r in flat.collect()}


def brute_hierarchy(rows, min_pts, reach2, min_size):
    """Excess of mass over the same levels, cluster by cluster in plain Python."""
    levels = {d: brute_clusters(rows, min_pts, d, min_size) for d in range(reach2 + 1)}
    parts = {d: defaultdict(set) for d in levels}
    for d, labels in levels.items():
        for doc, label in labels.items():
            if label is not None:
                parts[d][label].add(doc)

    def gain(d):
        return 1 / (1 + d**0.5) - (1 / (1 + (d + 1) ** 0.5) if d < reach2 else 0)

    def best(members, d):
        """Best selection within a cluster that is ``members`` at level ``d``: (mass, list of member sets)."""
        own, here, level = 0.0, members, d
        while True:
            own += len(here) * gain(level)
            inside = [m for m in parts[level - 1].values() if m <= here] if level else []
            if len(inside) != 1:
                break
            here, level = inside[0], level - 1
        options = [best(m, level - 1) for m in inside]
        mass = sum(o[0] for o in options)
        return (own, [members]) if own >= mass else (mass, [c for o in options for c in o[1]])

    chosen = [c for root in parts[reach2].values() for c in best(root, reach2)[1]]
    return {frozenset(c) for c in chosen}


@pytest.mark.parametrize("seed", [1, 3])
def test_hierarchy_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = random_cells(seed, n=250)
    rows += [(1000 + i, *[50 + 2 * (i % 2) + rng.choice([0, 0, 1]) if j == 0 else 50 for j in range(3)]) for i in range(60)]
    points, cells, edges = graph_of(spark, rows, 4)
    clustered = density.cluster_hierarchical(cells, edges, 6, 4, 12)
    found = defaultdict(set)
    for r in density.label_points(points, cells, clustered, 3, 4).collect():
        if r["cluster"] is not None:
            found[r["cluster"]].add(r["doc_id"])
    assert {frozenset(m) for m in found.values()} == brute_hierarchy(rows, 6, 4, 12)


def nested_cells(seed):
    """Two dense spots and a wide one, with noise."""
    rng = random.Random(seed)
    rows = []
    for i in range(420):
        x, y, spread = rng.choice([(40, 40, 2), (58, 40, 2), (200, 210, 14), (200, 210, 14)])
        rows.append((i, int(rng.gauss(x, spread)), int(rng.gauss(y, spread))))
    return rows + [(1000 + i, rng.randrange(256), rng.randrange(256)) for i in range(25)]


def brute_pyramid(rows, levels, min_pts, reach2, min_size):
    """Clusters by plain recursion over the levels' parts."""

    def parts_at(level):
        cells = defaultdict(set)
        for doc, x, y in rows:
            cells[x >> level, y >> level].add(doc)
        near = {c: [d for d in cells if distance2(c, d) <= reach2] for c in cells}
        core = {c for c in cells if sum(len(cells[d]) for d in near[c]) >= min_pts}
        edges = [(c, d) for c in core for d in near[c] if d in core and c != d]
        root = find_components([(min(cells[a]), min(cells[b])) for a, b in edges])
        out = defaultdict(set)
        for c in core:
            out[root.get(min(cells[c]), min(cells[c]))] |= cells[c]
        return [m for m in out.values() if len(m) >= min_size]

    layers = [parts_at(level) for level in range(levels)]
    gains = [4.0**-d - (4.0 ** -(d + 1) if d < levels - 1 else 0) for d in range(levels)]

    def best(part, level):
        mass, members, at = 0.0, part, level
        while True:
            mass += len(members) * gains[at]
            inside = [m for m in layers[at - 1] if m <= members] if at else []
            if len(inside) != 1:
                break
            members, at = inside[0], at - 1
        inner = [best(m, at - 1) for m in inside]
        total = sum(m for m, _ in inner)
        sole = level == levels - 1 and len(layers[level]) == 1
        if inner and (total > mass or sole):
            return max(mass, total), [c for _, found in inner for c in found]
        return max(mass, total), [part]

    return {frozenset(c) for part in layers[levels - 1] for c in best(part, levels - 1)[1]}


@pytest.mark.parametrize("seed", [3, 4, 5])
def test_pyramid_matches_brute_force(spark, seed):
    rows, levels = nested_cells(seed), 7
    points = spark.createDataFrame(rows, "doc_id long, c0 int, c1 int")
    cells = session.cut_lineage(neighbours.grid_cells(points, 2))
    found = session.cut_lineage(density.cluster_pyramid(cells, 2, levels, 8, 2, 15))
    got = defaultdict(set)
    for r in density.label_pyramid(points, found, 2, 2).collect():
        if r["cluster"] is not None:
            got[r["cluster"]].add(r["doc_id"])
    want = brute_pyramid(rows, levels, 8, 2, 15)
    assert len(want) >= 2 and {frozenset(m) for m in got.values()} == want


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_default_clusters_are_the_languages_at_any_size(spark, size):
    folder = f"/root/testdata/{size}"
    found = fit.discover_clusters(common.centred_vectors(spark, folder), FitParams(min_topic_size=30), 256)
    languages = common.documents(spark, folder).select("doc_id", "lang")
    counts = found.where("cluster is not null").join(languages, "doc_id").groupBy("cluster", "lang").count().collect()
    clusters = defaultdict(Counter)
    for r in counts:
        clusters[r["cluster"]][r["lang"]] += r["count"]
    large = [c for c in clusters.values() if sum(c.values()) >= 30]
    assert len(large) >= 4 and {c.most_common(1)[0][0] for c in large} == {"en", "fr", "de", "es"}
    assert all(c.most_common(1)[0][1] >= 0.95 * sum(c.values()) for c in large)


def exact_neighbours(rows, k):
    """``{src: [dst, ...]}`` over different vectors, by full comparison."""
    ids, matrix = zip(*sorted(rows.items()))
    matrix = np.array(matrix)
    scores = np.round(matrix @ matrix.T, 9)
    np.fill_diagonal(scores, -np.inf)
    return {i: [ids[j] for j in np.lexsort((ids, -scores[r]))[:k]] for r, i in enumerate(ids)}


@pytest.mark.parametrize("cell_rows", [64, 1024])
def test_document_neighbours_reach_the_recall(spark, cell_rows):
    vecs = common.centred_vectors(spark, "/root/testdata/sf0.01")
    out = document_neighbours.document_neighbours(vecs, 10, cell_rows).collect()
    rows, members = document_neighbours.fold_copies(vecs)
    want = exact_neighbours({r["doc_id"]: r["vec"] for r in rows.collect()}, 10)
    got = defaultdict(list)
    for r in sorted(out, key=lambda r: (r["src"], r["rank"])):
        got[r["src"]].append(r["dst"])
    recall = sum(len({*got[i]} & {*w}) for i, w in want.items()) / sum(map(len, want.values()))
    assert recall >= 0.95 and (cell_rows < 1000 or got == want)
    assert members.groupBy("leader").count().count() == len(want)


def test_copies_are_folded_and_crowded_cells_split(spark):
    rng = np.random.default_rng(2)
    crowd = rng.normal(size=(1, 8)) + 0.05 * rng.normal(size=(900, 8))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(crowd)] + [(5000 + i, [1.0] * 8) for i in range(400)] + [(9000, None)]
    vecs = spark.createDataFrame(rows, "doc_id long, vec array<double>")
    out = document_neighbours.document_neighbours(vecs, 5, cell_rows=32).collect()
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in rows[:901]}
    want = exact_neighbours(unit, 5)
    got = defaultdict(set)
    for r in out:
        got[r["src"]].add(r["dst"])
        assert (r["weight"] == 400) == (r["dst"] == 5000)
    assert got.keys() == want.keys()
    assert sum(len(got[i] & {*w}) for i, w in want.items()) / (5 * len(want)) > 0.5
    assert document_neighbours.document_neighbours(vecs.limit(0), 5).count() == 0


def test_projection_query_has_three_coordinates(spark, sf):
    rows = topic_queries.e3_random_projection(spark, sf).groupBy("doc_id").agg(F.collect_set("component").alias("c")).collect()
    assert rows and all(sorted(row["c"]) == [0, 1, 2] for row in rows)


def test_neighbour_graph_query_compares_three_coordinates(spark, sf):
    found = {(row["src"], row["dst"]): row["d2"] for row in topic_queries.e4_neighbour_graph(spark, sf).collect()}
    cells = {}
    for row in topic_queries.e3_random_projection(spark, sf).collect():
        cells.setdefault(row["doc_id"], [0, 0, 0])[row["component"]] = int(np.floor(row["value"] / topic_queries.GRAPH_WIDTH))
    first = {}
    for doc, cell in sorted(cells.items()):
        first.setdefault(tuple(cell), doc)
    apart = {(a, b): sum((x - y) ** 2 for x, y in zip(c, d)) for c, a in first.items() for d, b in first.items() if a != b}
    near = {pair: d2 for pair, d2 in apart.items() if d2 <= 2}
    assert 2 in found.values() and found.items() <= near.items()
    assert all(sum(pair[0] == a for pair in found) == min(15, sum(pair[0] == a for pair in near)) for a in first.values())


def test_probes_of_neighbours_are_not_broadcast(spark):
    cells = spark.createDataFrame([(0, 0, 1, 1), (0, 1, 2, 1)], "c0 int, c1 int, cell_id long, weight long")
    edges = neighbours.neighbour_edges(cells, 2, 2)
    assert "Broadcast" not in edges._jdf.queryExecution().executedPlan().toString()
    assert [tuple(row) for row in edges.collect()] == [(1, 2, 1)]


def test_sample_for_centres_merges_documents_without_their_vectors(spark, monkeypatch):
    monkeypatch.setattr(document_neighbours, "SAMPLE", 3)
    rows = spark.createDataFrame([(i, [float(i)], 1) for i in range(9)] + [(None, [9.0], 1)], "doc_id long, vec array<double>, weight long")
    order = F.xxhash64("doc_id"), "doc_id"
    sample = document_neighbours.sampled(rows)
    text = sample._jdf.queryExecution().executedPlan().toString()  # the inner one, listed last, has no vectors
    assert text.count("TakeOrderedAndProject(limit=3") == 2 and "BroadcastExchange" in text
    assert sample.collect() == rows.orderBy(*order).limit(3).collect()


def test_the_best_are_those_of_a_full_sort():
    rng = np.random.default_rng(5)
    for n, k in ((1, 3), (3, 3), (40, 5), (40, 60)):
        scores = np.round(rng.normal(size=(30, n)), 1)  # many ties
        want = np.argsort(-scores, axis=1, kind="stable")[:, :k]
        values, columns = document_neighbours._best(scores.copy(), k)
        assert np.array_equal(columns, want) and np.array_equal(values, np.take_along_axis(scores, want, 1))


def test_rounds_hold_all_cells_and_no_more_rows_than_asked():
    sizes = [(c, 10 + c % 7, c % 2) for c in range(50)] + [(50, 400, 1), (51, 3, 0)]
    rounds = document_neighbours._rounds(sizes, 100)
    assert [cell for dealt in rounds for cell in dealt] == [(c, bits) for c, _, bits in sizes]
    sent = {c: n * (1 + (bits > 0)) for c, n, bits in sizes}
    assert len(rounds) > 5 and all(sum(sent[c] for c, _ in dealt) <= 100 or dealt == [(50, 1)] for dealt in rounds)
    assert document_neighbours._rounds([], 100) == [[]]


def test_neighbours_keep_a_vector_once_on_disk(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(1500, 6)))]
    vecs = spark.createDataFrame(rows, "doc_id long, vec array<double>")
    whole = document_neighbours.document_neighbours(vecs, 5, cell_rows=64).collect()
    folder, written = Path(session.shared_folder(spark).removeprefix("file:")), {}
    before = {p.name for p in folder.iterdir()}

    def stages():
        return [p.name.rpartition("-")[0] for p in folder.iterdir() if p.name not in before]

    def stage(df, name):
        written.setdefault(name, []).append(df.count())
        assert sum(held != "lists" for held in stages()) <= 1  # beside the one that is written
        return session.stage(df, name)

    monkeypatch.setattr(document_neighbours, "stage", stage)
    monkeypatch.setattr(document_neighbours, "ROUND_ROWS", 1)
    out = document_neighbours.document_neighbours(vecs, 5, cell_rows=64)
    assert written.pop("folded") == written.pop("in-cells") == [1500]
    assert written.keys() == {"lists"} and len(written["lists"]) > 2  # rounds
    assert set(stages()) == {"lists"} and sorted(out.collect()) == sorted(whole)


def test_shuffle_files_go_with_their_job(spark):
    def files():
        return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    counted = spark.range(1000).groupBy((F.col("id") % 10).alias("n")).count()
    held = files()
    with session.shuffles_dropped(spark):
        session.unstage(session.stage(counted, "counted"))
    for _ in range(50):
        if files() <= held:
            break
        time.sleep(0.2)
    assert files() <= held and spark.conf.get(name) == before
